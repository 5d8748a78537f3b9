"""Fast encoders, prefix counts, token files and packing against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from edge_rows import EDGE_ROWS

from tariff_engine.llm.encoding import ByteEncoder, WordEncoder
from tariff_engine.llm.packing import Packing, _refit, crossover, evolve, mutate, pack_documents
from tariff_engine.llm.prefix_counts import PrefixCounter, prefix_counts, truncation
from tariff_engine.llm.token_files import TokenFiles, write_token_files

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PIECES = ["a", "the", " ", "  ", "\n", "'s", "'re", "'l", "'", "!", "?_", "1", "23", "ing", "é", "ß", "\t", "<|endoftext|>",
          "<|end", "日本", "½", "İ", " \n", "\x85", "x\x1cy", "’", "THE", "ª"]


def _random_texts(n, most, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choices(PIECES, k=rnd.randint(1, most))) for _ in range(n)]


def _ids(encoder, text):
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module", params=[(ByteEncoder, BYTES), (WordEncoder, WORDS)])
def encoder(request):
    return request.param[0](request.param[1])


def test_encoders_equal_the_library(encoder, documents):
    texts = [r.text for r in documents.collect()] + _random_texts(1500, 12, 1) + [t for _, t in EDGE_ROWS]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, dtype="<u4").tolist() == _ids(encoder, text), repr(text)[:80]


def test_words_are_encoded_once(monkeypatch):
    monkeypatch.setattr("tariff_engine.llm.encoding.BATCH_TEXTS", 3)
    encoder, seen = WordEncoder(WORDS), []
    engine = encoder._ids
    encoder._ids = lambda text: (seen.append(text), engine(text))[1]
    texts = ["One two, TWO one's", None, "two three " * 50, "", "three four\n", "½ one", " \t", "five"] * 4
    found = encoder.encode(texts)
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in found] == [_ids(encoder, t) for t in texts]
    words = [w for text in seen for w in text.split("\x01")[:-1]]
    assert sorted(words) == sorted({"one", "two", ",", "'s", "three", "four", "five"})
    monkeypatch.setattr("tariff_engine.llm.encoding.MEMO_WORDS", 2)  # kept words are dropped and encoded again
    assert encoder.encode(texts) == found


def test_every_prefix_is_counted_as_the_library_counts_it(documents):
    counter = PrefixCounter(BYTES)
    texts = _random_texts(1500, 8, 2) + ["'sthe", "1abc", ""] + [r.text[:150] for r in documents.limit(10).collect()]
    for text in texts:
        counts = np.cumsum(counter.steps(text), dtype=int).tolist()
        assert counts == [len(_ids(counter, text[:n])) for n in range(1, len(text) + 1)], repr(text)


def test_prefix_counts_operator(edge, nothing):
    counter = ByteEncoder(BYTES)
    found = prefix_counts(edge, BYTES, budgets=(3, 512)).collect()
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in found), key=str)
    assert got == sorted(((i, len((t or "").encode()), len(_ids(counter, t))) for i, t in EDGE_ROWS), key=str)
    for r in found:
        assert len(r.steps) == r.n_chars and sum(np.frombuffer(r.steps, dtype=np.int8).tolist()) == r.n_tokens
        assert truncation(bytes(r.steps), 512) == r.fits_512 and truncation(bytes(r.steps), 3) == r.fits_3
    for i, text in EDGE_ROWS:
        if text and i != 6:
            r = next(r for r in found if r.doc_id == i and r.n_bytes == len(text.encode()))
            fits = [n for n in range(len(text) + 1) if len(_ids(counter, text[:n])) <= 3]
            assert r.fits_3 == fits[-1]
    assert prefix_counts(nothing, BYTES).count() == 0


def test_token_files_round_trip(spark, edge, nothing):
    encoder = WordEncoder(WORDS)
    files = write_token_files(edge, WORDS)
    rows = files.documents(spark).collect()
    expected = sorted(((i, tuple(_ids(encoder, t) + [1])) for i, t in EDGE_ROWS), key=str)
    assert sorted(((r.doc_id, tuple(r.ids)) for r in rows), key=str) == expected
    rows.sort(key=lambda r: r.start)
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows[:-1]]).tolist()
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))  # null ids first, then ascending
    reopened = TokenFiles.open(files.folder)
    assert reopened == files and reopened.id_type == "<u2"
    assert sum(len(reopened.maps(p["part"])[0]) for p in reopened.parts) == sum(len(t) for _, t in expected)
    empty = write_token_files(nothing, WORDS)
    assert empty.parts == () and empty.documents(spark).count() == 0


def test_token_files_of_many_parts(spark, documents):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = write_token_files(documents, WORDS)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(files.parts) > 3
    encoder, at = WordEncoder(WORDS), 0
    found = {r.doc_id: r for r in files.documents(spark).collect()}
    for r in sorted(documents.collect()):
        ids = _ids(encoder, r.text) + [1]
        assert (found[r.doc_id].start, found[r.doc_id].ids) == (at, ids)
        at += len(ids)


def _check_packing(rows, texts, capacity=2048):
    encoder = ByteEncoder(BYTES)
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc_id, pieces in by_doc.items():
        candidates = [_ids(encoder, t) + [0] for i, t in texts if i == doc_id]
        pieces.sort(key=lambda r: (r.piece, r.start))
        covered = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in pieces)
        expected = []
        for ids in candidates:
            first = len(ids) if len(ids) <= capacity else len(ids) % capacity or capacity
            cuts = [0, *range(first, len(ids) + 1, capacity)]
            expected += [
                (k, a, b - a, zlib.crc32(np.asarray(ids[a:b], dtype="<u4").tobytes()))
                for k, (a, b) in enumerate(zip(cuts, cuts[1:]))
            ]
        assert covered == sorted(expected)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        places.sort()
        assert [o for o, _ in places] == np.cumsum([0] + [n for _, n in places[:-1]]).tolist()
        assert sum(n for _, n in places) <= capacity
    return len(sequences)


def test_packing_of_edge_rows(edge, nothing):
    rows = pack_documents(edge, BYTES).collect()
    _check_packing(rows, EDGE_ROWS)
    assert pack_documents(nothing, BYTES).count() == 0


def test_packing_is_near_the_least_number(documents):
    rows = pack_documents(documents, BYTES, cell_docs=64).collect()
    n = _check_packing(rows, [(r.doc_id, r.text) for r in documents.collect()])
    least = -(-sum(r.length for r in rows) // 2048)
    assert n <= 1.02 * least + 4  # each of the four cells may leave one sequence open


def test_genetic_operators_keep_packings_valid():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 900, 400)
    nowhere = np.full(400, -1)
    people = [_refit(nowhere, np.arange(400), lengths, 1000, rng, noise) for noise in (0.0, 2.0)]
    for child in (crossover(*people, lengths, 1000, rng), mutate(people[0], lengths, 1000, rng)):
        assert len(child.of) == 400 and child.fill.max() <= 1000 and child.fill.sum() == lengths.sum()
        assert (np.bincount(child.of, weights=lengths) == child.fill).all()
    least = -(-lengths.sum() // 1000)
    assert least <= Packing(evolve(lengths, 1000, [], rng), lengths, 1000).fill.size <= least + 3
