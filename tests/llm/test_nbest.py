"""N-best segmentation against enumeration, decoding against the library."""

import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from edge_rows import EDGE_ROWS

from tariff_engine.llm.nbest import PieceDecoder, PieceLattice, decode_pieces, encode_n_best
from tariff_engine.llm.queries import QUERIES

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return PieceLattice(MODEL)


def _all_segmentations(pieces, text):
    normalised = pieces.model.normalize(text)
    after = {}
    for edge in pieces.edges(normalised):
        after.setdefault(edge[0], []).append(edge)
    out = []

    def extend(at, score, ids):
        if at == len(normalised):
            out.append((score, ids))
        for _, end, more, own in after.get(at, []):
            extend(end, score + own, ids + more)

    extend(0, 0.0, ())
    return sorted(out, key=lambda x: -x[0])


def test_n_best_are_the_best_of_all(pieces):
    rnd = random.Random(1)
    parts = ["a", "the", "ing", " ", "  ", "é", "日", "\n", "tion", "x", "▁", "\x00", "𝔘", ".", "\x85"]
    texts = [t for t in ("".join(rnd.choices(parts, k=rnd.randint(0, 6))) for _ in range(400)) if len(t) <= 12]
    decoder = PieceDecoder(MODEL)
    for text, found in zip(texts, pieces.n_best(texts, 4)):
        every = _all_segmentations(pieces, text)
        got = [tuple(np.frombuffer(i, dtype="<u4").tolist()) for i in found.all_ids()]
        scores = [s for s, _ in found.ranked]
        assert scores == [s for s, _ in every[:4]] and len(set(got)) == len(got)
        assert all(dict((i, s) for s, i in every)[g] == s for g, s in zip(got, scores))
        assert found.all_ids()[0] == found.ids and found.score == scores[0]
        for g, ids in zip(got, found.all_ids()):
            assert decoder.decode(ids) == pieces.model.decode(list(g))


def test_new_words_cost_less_than_a_look_at_each_edge(pieces):
    rnd = random.Random(2)
    syllables = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "nt", "ea", "ti", "tion", "ing"]
    words = list({"▁" + "".join(rnd.choices(syllables, k=rnd.randint(2, 6))) + rnd.choice(["", "", ",", "."]) for _ in range(60_000)})

    def seconds(work):
        began = time.process_time()
        work()
        return time.process_time() - began

    plain = sorted(seconds(lambda: [edge for word in words for edge in pieces.entries_by_end.iter(word)]) for _ in range(3))
    solved = sorted(seconds(lambda: pieces.solved(words)) for _ in range(3))
    assert solved[1] < plain[1]


@pytest.mark.parametrize("cells", [2**25, 0])
def test_long_and_short_words_are_solved_alike(monkeypatch, cells):
    monkeypatch.setattr("tariff_engine.llm.nbest.TABLE_CELLS", cells)
    pieces = PieceLattice(MODEL)
    rnd = random.Random(3)
    parts = ["a", "the", "ing", "é", "日", "x", "\x00", "𝔘", ".", "tion", "aa", "12"]
    texts = ["▁" + "".join(rnd.choices(parts, k=k)) for k in (1, 2, 5, 9, 20, 30, 40, 80, 200) for _ in range(12)]
    together, low = pieces.solved(texts), 0
    for k, text in enumerate(texts):
        alone, high = pieces.solved([text]), low + together.counts[k]
        edge_by_edge = pieces._solved_alone(text)
        found = together.ids[low:high].tolist(), together.scores[k], together.losses[k]
        assert found == (alone.ids.tolist(), alone.scores[0], alone.losses[0])
        assert found == (edge_by_edge.ids.tolist(), edge_by_edge.scores[0], edge_by_edge.losses[0])
        if len(text) < 40:
            (score, ids), *other = pieces.search(text, 2)
            assert found == (list(ids), score, score - other[0][0] if other else float("inf"))
        low = high


def test_a_full_memo_and_other_n_change_nothing(monkeypatch):
    rnd = random.Random(4)
    texts = [" ".join("".join(rnd.choices(["re", "in", "tion", "es", ","], k=3)) for _ in range(9)) for _ in range(60)]
    expected = [(f.all_ids(), f.ranked) for f in PieceLattice(MODEL).n_best(texts, 4)]
    monkeypatch.setattr("tariff_engine.llm.nbest.MEMO_WORDS", 40)
    full = PieceLattice(MODEL)
    for n in (2, 3):
        full.n_best(texts, n)
    found = [f for low in range(0, len(texts), 7) for f in full.n_best(texts[low:low + 7], 4)]
    assert [(f.all_ids(), f.ranked) for f in found] == expected and len(full.words) == 40


def test_search_orders_equal_scores(pieces):
    found = pieces.search("▁▁▁▁a", 6)
    assert [s for s, _ in found] == sorted((s for s, _ in found), reverse=True)
    assert found == pieces.search("▁▁▁▁a", 6)


def test_decoding_of_nulls_and_of_ids_that_spell_no_text(spark, pieces):
    half = pieces.model.encode("日")  # spelled by bytes or one piece; cut bytes below spell nothing
    cut = [pieces.byte_ids[0xE6], pieces.byte_ids[0x97]]
    pack = lambda ids: np.asarray(ids, dtype="<u4").tobytes()
    rows = [(1, None), (2, b""), (3, pack(cut)), (4, pack([pieces.byte_ids[0xA5]])), (5, pack(half))]
    df = spark.createDataFrame(rows, "doc_id long, ids binary").coalesce(1)
    found = {r.doc_id: r.text for r in decode_pieces(df, MODEL).collect()}
    assert found == {1: None, 2: "", 3: "\ufffd", 4: "\ufffd", 5: "日"}


def test_operator_and_decoding(edge, nothing, pieces):
    found = encode_n_best(edge, MODEL, n=3).collect()
    assert len(found) == len(EDGE_ROWS)
    expected = sorted(((i, pieces.model.decode(pieces.model.encode(t or ""))) for i, t in EDGE_ROWS), key=str)
    decoded = decode_pieces(encode_n_best(edge, MODEL, n=3).select("doc_id", "ids", "score"), MODEL).collect()
    assert sorted(((r.doc_id, r.text) for r in decoded), key=str) == expected
    for r in found:
        assert len(r.scores) == 1 + len(r.alternatives) <= 3 and r.scores[0] == r.score
        assert sorted(r.scores, reverse=True) == r.scores
    assert encode_n_best(nothing, MODEL).count() == 0 and decode_pieces(encode_n_best(nothing, MODEL), MODEL).count() == 0


def test_query_returns_every_segmentation(spark, documents, pieces):
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    found = {r.doc_id: r for r in QUERIES["op4_nbest"](spark, "/root/testdata/sf0.001").collect()}
    assert found.keys() == texts.keys() and any(r.n_found == 4 for r in found.values())
    for doc_id, expected in zip(texts, pieces.n_best(list(texts.values()), 4)):
        r = found[doc_id]
        assert r.scores == [s for s, _ in expected.ranked] and r.n_found == len(r.scores)
        assert [tuple(x) for x in r.segmentations] == [(len(i) // 4, zlib.crc32(i)) for i in expected.all_ids()]
