"""SimHash groups against a brute-force version."""

import random
import re
import string

import numpy as np
import pytest
import xxhash
from edge_rows import EDGE_ROWS
from pyspark.sql import functions as F

from tariff_engine.llm.simhash import fingerprint, links, simhash_groups

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile("[^\x20\x09-\x0D]+")


def _fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    runs = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))]
    values = [xxhash.xxh64(r.encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def _groups(points):
    """The least of each point's component, where points within two bits are linked."""
    points = np.array(sorted(set(points)), dtype=np.uint64)
    label = np.arange(len(points))
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= 2
    while True:
        least = np.where(near, label[None, :], len(points)).min(axis=1)
        if (least == label).all():
            return dict(zip(points.tolist(), label.tolist()))
        label = least


def _expected(rows):
    prints = [_fingerprint(t) for _, t in rows]
    group = _groups(prints)
    least = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            least[group[p]] = min(i, least.get(group[p], i))
    return sorted(((i, f"{p:016x}", least.get(group[p])) for (i, _), p in zip(rows, prints)), key=str)


def _found(df, **settings):
    return sorted((tuple(r) for r in simhash_groups(df, **settings).select("doc_id", "fingerprint", "component_id").collect()), key=str)


def _near_copies(seed, groups=8, copies=30):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    rows = []
    for _ in range(groups):
        base = rnd.choices(words, k=rnd.choice([2, 40, 150, 300]))
        for _ in range(copies):
            text = list(base)
            for _ in range(rnd.choice([0, 1, 2])):
                text[rnd.randrange(len(text))] = rnd.choice(words)
            rows.append((len(rows), " ".join(text)))
    return rows


@pytest.mark.parametrize("hot", [64, 3, 0])
def test_groups_match_brute_force(spark, hot):
    rows = _near_copies(5)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    expected = _expected(rows)
    assert len({c for _, _, c in expected}) < len({p for _, p, _ in expected}) < len(rows)
    assert _found(df, hot=hot) == expected


def test_edge_rows(edge):
    assert _found(edge) == _expected(EDGE_ROWS)


def test_a_fingerprint_of_many_documents_comes_back_by_broadcast(edge):
    assert _found(edge, hot_share=0.1) == _found(edge, hot_share=1.0) == _expected(EDGE_ROWS)


def test_null_ids_alone(spark):
    df = spark.createDataFrame([(None, "one two three four"), (None, None)], "doc_id long, text string")
    assert [c for _, _, c in _found(df)] == [None, None]


def test_empty_table(nothing):
    assert _found(nothing) == []


def test_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert _found(documents) == _expected(rows)


def test_long_text_in_passes(monkeypatch):
    text = " ".join(f"w{k * k % 977}" for k in range(5000))
    monkeypatch.setattr("tariff_engine.llm.simhash._PASS", 700)
    assert fingerprint(text.encode()) == _fingerprint(text)


def test_spark_and_python_hash_alike(spark):
    text = "größe öl straße"
    signed = spark.range(1).select(F.xxhash64(F.lit(text))).first()[0]
    assert fingerprint(text.encode()) == signed % (1 << 64) == _fingerprint(text)


@pytest.mark.parametrize("hot", [1 << 40, 0])
def test_links_reach_every_bit_pair(spark, hot):
    """All values within two bits of one, also across the segments' border, are linked; none three bits away is."""
    base = 0x0123456789ABCDEF
    near = {base} | {base ^ (1 << a) ^ (1 << b) for a in range(0, 64, 7) for b in range(64) if a != b}
    far = {base ^ (0b111 << 20) ^ (1 << k) ^ (1 << 50) ^ (1 << 63) for k in (3, 40)}
    signed = [(v - (1 << 64) * (v >> 63),) for v in near | far]
    found = links(spark.createDataFrame(signed, "fp long"), hot).collect()
    pairs = {tuple(sorted((r.a % (1 << 64), r.b % (1 << 64)))) for r in found}
    assert all((a ^ b).bit_count() <= 2 for a, b in pairs)
    expected = _groups(near | far)
    parent = {v: v for v in near | far}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[find(a)] = find(b)
    together = {}
    for v, g in expected.items():
        together.setdefault(g, set()).add(find(v))
    assert all(len(roots) == 1 for roots in together.values())


def test_hot_groups_hold_at_most_65(spark):
    """All near values of a crowded segment: no group by a near value can be larger than the ball of radius one."""
    prints = [(v,) for v in range(1 << 11)]
    found = links(spark.createDataFrame(prints, "fp long"), hot=16)
    assert found.count() < 65 * len(prints)
    assert found.where("bit_count(a ^ b) > 2").count() == 0
