"""N-gram Jaccard join against Python sets, and its parts against brute force."""

import random
import re
import string

import numpy as np
import pytest
from edge_rows import EDGE_ROWS

from tariff_engine.llm import shingle_join as module
from tariff_engine.llm.components import connected_components
from tariff_engine.llm.count_rtree import CountTree, count_vector, points_of
from tariff_engine.llm.shingle_join import candidates, link_counts, shingle_join
from tariff_engine.llm.shingles import shingle_sets

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile("[^\x20\x09-\x0D]+")


def _set(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) >= 5:
        return frozenset(" ".join(words[k:k + 5]) for k in range(len(words) - 4))
    return frozenset([" ".join(words)] if words else [])


def _linked(a, b):
    both = len(a & b)
    return 100 * both >= 75 * (len(a) + len(b) - both)


def _components(labels, linked):
    parent = {x: x for x in labels}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        parent[find(a)] = find(b)
    return find


def _expected(rows):
    sets = {}
    for doc_id, text in rows:
        sets.setdefault(_set(text), []).append(doc_id)
    real = [s for s in sets if s]
    find = _components(range(len(real)), [(i, j) for i in range(len(real)) for j in range(i) if _linked(real[i], real[j])])
    least = {}
    for k, s in enumerate(real):
        ids = [i for i in sets[s] if i is not None]
        least[find(k)] = min([*ids, *([least[find(k)]] if least.get(find(k)) is not None else [])], default=None)
    out = [(i, len(s), least[find(k)]) for k, s in enumerate(real) for i in sets[s]]
    return sorted(out + [(i, 0, i) for i in sets.get(frozenset(), [])], key=str)


def _near_copies(seed, groups=12, copies=25):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    passage = rnd.choices(words, k=60)
    rows = []
    for _ in range(groups):
        base = rnd.choices(words, k=rnd.choice([4, 8, 30, 80, 200]))
        for _ in range(copies):
            text = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 3, 6])):
                text[rnd.randrange(len(text))] = rnd.choice(words)
            if rnd.random() < 0.3:
                text = text + passage
            rows.append((len(rows), " ".join(text)))
    return rows


def _joined(df):
    return sorted((tuple(r) for r in shingle_join(df).documents.collect()), key=str)


@pytest.mark.parametrize("seed, tile, rounds", [(1, 512, 2), (2, 7, 1), (3, 3, 0)])
def test_components_of_near_copies(spark, monkeypatch, seed, tile, rounds):
    """Also with tiny tiles and batches, and without the rounds that come before the whole join."""
    monkeypatch.setattr(module, "ROUNDS", rounds)
    monkeypatch.setattr(candidates, "__defaults__", (tile,))
    monkeypatch.setattr(module, "BATCH_TOKENS", 3000)
    monkeypatch.setattr(module, "WIDE", 4)
    rows = _near_copies(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert _joined(df) == _expected(rows)


def test_documents(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert _joined(documents) == _expected(rows)


def test_edge_rows(edge, nothing):
    assert _joined(edge) == _expected(EDGE_ROWS)
    assert shingle_join(nothing).documents.count() == 0


def test_links_are_exact_pairs_of_classes(spark):
    rows = _near_copies(5, groups=4, copies=10)
    joined = shingle_join(spark.createDataFrame(rows, "doc_id long, text string"))
    texts = dict(rows)
    of = {bytes(r["class"]): _set(texts[r.doc_id]) for r in joined.classes.collect() if r["class"] is not None}
    links = joined.links.collect()
    assert links and all(_linked(of[bytes(r.a)], of[bytes(r.b)]) for r in links)


def test_shingle_sets_count_like_sets_of_strings(documents):
    texts = [r.text for r in documents.collect()] + [t for _, t in EDGE_ROWS]
    assert [len(s) for s in shingle_sets(texts)] == [len(_set(t)) for t in texts]
    a, b = shingle_sets(["One two three four five six", "\none  TWO three\tfour five SIX "])
    assert (a == b).all()


def test_rtree_rules_out_nothing_that_matches():
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(60):
        base = rng.integers(0, 1 << 40, rng.integers(3, 300), dtype=np.uint64)
        for _ in range(5):
            kept = base[rng.random(len(base)) < rng.uniform(0.6, 1)]
            sets.append(np.unique(np.concatenate([kept, rng.integers(0, 1 << 40, 3, dtype=np.uint64)])))
    points, sizes = points_of([count_vector(s) for s in sets]), np.asarray([len(s) for s in sets])
    q, r, bound = CountTree(points, sizes).matches(points, sizes, 75, 100)
    found = set(zip(q.tolist(), r.tolist()))
    overlap = {(i, j): len(np.intersect1d(a, b)) for i, a in enumerate(sets) for j, b in enumerate(sets)}
    matching = {p for p, o in overlap.items() if 100 * o >= 75 * (sizes[p[0]] + sizes[p[1]] - o)}
    assert matching <= found and len(found) < 3 * len(matching)
    assert all(b >= overlap[p] for p, b in zip(zip(q.tolist(), r.tolist()), bound.tolist()))


def test_full_counters_never_lower_a_bound():
    crowded = np.zeros(700, dtype=np.uint64)
    points = points_of([count_vector(crowded)])
    assert points.max() == 65535


def test_connected_components(spark):
    rnd = random.Random(6)
    edges = [(f"{rnd.randrange(80):03}", f"{rnd.randrange(80):03}") for _ in range(60)] + [(f"{k:03}", f"{k + 1:03}") for k in range(100, 140)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a string, b string")).collect()}
    nodes = sorted({x for e in edges if e[0] != e[1] for x in e})
    find = _components(nodes, [e for e in edges if e[0] != e[1]])
    assert found == {x: min(y for y in nodes if find(y) == find(x)) for x in nodes}
    assert connected_components(spark.createDataFrame([], "a string, b string")).count() == 0


@pytest.mark.parametrize("tile", [1024, 4])
def test_number_of_links_counts_every_similar_pair(spark, monkeypatch, tile):
    monkeypatch.setattr(link_counts, "__defaults__", (tile,))
    monkeypatch.setattr(module, "COUNT_CELLS", 1 << 10)
    rows = _near_copies(7, groups=5, copies=16) + EDGE_ROWS
    sets = [_set(t) for _, t in rows]
    expected = [
        (i, len(s), sum(k != j and bool(s and o) and _linked(s, o) for j, o in enumerate(sets))) for k, ((i, _), s) in enumerate(zip(rows, sets))
    ]
    found = shingle_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).counted.collect()
    assert sorted(((r.doc_id, r.n_shingles, r.n_links) for r in found), key=str) == sorted(expected, key=str)
    assert max(n for *_, n in expected) > 8


def test_batches_keep_their_own_rows_apart(spark):
    texts = spark.createDataFrame([(" ".join(f"w{k}x{j}" for j in range(20)),) for k in range(24)], "text string").repartition(6)
    dealt = texts.mapInArrow(module._deal(8), module._DEALT).where("kind = 2").select("key", "batch").collect()
    assert len(dealt) > 1 and len({r.key for r in dealt}) == len({r.batch for r in dealt}) == len(dealt)


def _thue_morse(n, letters):
    return "".join(letters[k.bit_count() % 2] for k in range(n))


@pytest.mark.parametrize("n", [512, 1024, 2048, 4096])
def test_regular_words_do_not_collide(n):
    """A polynomial modulo 2**64 gives these words one hash."""
    a, b = shingle_sets([_thue_morse(n, "ab"), _thue_morse(n, "ba")])
    assert a != b


def test_words_that_differ_in_one_piece_or_its_place():
    word = "abcdefgh" * 4
    words = [word, word[8:] + "abcdefgx", "abcdefgx" + word[8:], word[:8] + "abcdefgx" + word[16:], word + "a", word[:-1], word + "\0", "abcdefgh"]
    assert len({int(s[0]) for s in shingle_sets(words)}) == len(words)


def test_texts_of_long_regular_words_are_not_linked(spark):
    rows = [(k, _thue_morse(2048, letters)) for k, letters in enumerate(("ab", "ba", "AB"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _joined(df) == _expected(rows) == [(0, 1, 0), (1, 1, 1), (2, 1, 0)]


def test_buckets_follow_the_tokens(spark, monkeypatch):
    """With a few tokens a bucket there are thousands of them, and the same result."""
    rows = _near_copies(11, groups=4, copies=8)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(module, "BUCKET_TOKENS", 4)
    assert _joined(df) == _expected(rows)
