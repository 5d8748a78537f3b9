"""Importance resampling against a plain version, its SQL, and the distributed places against a sort."""

import hashlib
import math
import re
import string
import zlib

import duckdb
import pytest
from edge_rows import EDGE_ROWS
from pyspark.sql import functions as F

from tariff_engine.llm import queries
from tariff_engine.llm.importance import NgramBuckets, importance_resample, with_places

SF_DIR = "/root/testdata/sf0.001"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
COLUMNS = ["doc_id", "n_features", "weight", "score", "rank"]


def _features(text, longest=1, buckets=10_000):
    words = WORD.findall((text or "").translate(LOWER))
    grams = [" ".join(words[k:k + n]) for n in range(1, longest + 1) for k in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(g.encode()) % buckets for g in grams]


def _expected(source, target, longest=1, buckets=10_000, per_hundred=10, least_words=20):
    found = [_features(t, longest, buckets) for _, t in source]
    s, t = [0] * buckets, [0] * buckets
    for _, f in found:
        for b in f:
            s[b] += 1
    for text in target:
        for b in _features(text, longest, buckets)[1]:
            t[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    rows = []
    for (i, _), (n, f) in zip(source, found):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    fit = sorted((r for r in rows if r[5] >= least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(fit[: per_hundred * len(fit) // 100], 1):
        r[4] = place
    return sorted((tuple(r[:5]) for r in rows), key=str)


def _found(source, target, **settings):
    found = importance_resample(source, target, **settings).select(*COLUMNS)
    assert [t for _, t in found.dtypes][1:] == ["bigint"] * 4
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(1, "The quick brown fox, and the lazy dog."), (2, None), (3, ""), (4, "Ärger über Öl")],
                                 "item_id long, text string")


TARGET = ["The quick brown fox, and the lazy dog.", None, "", "Ärger über Öl"]


@pytest.mark.parametrize("longest, buckets, least", [(1, 10_000, 20), (3, 512, 1), (2, 100_000, 0)])
def test_edge_rows(edge, target, longest, buckets, least):
    found = _found(edge, target, longest=longest, buckets=buckets, least_words=least, per_hundred=60)
    assert found == _expected(EDGE_ROWS, TARGET, longest, buckets, 60, least)


def test_empty_tables(edge, nothing, target):
    assert _found(nothing, target) == []
    assert _found(edge, target.where("false")) == _expected(EDGE_ROWS, [])


def test_documents_match_plain_version_and_sql(spark, documents):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    rel = con.sql(queries.ORACLE_SQL["op13_importance"]).select(", ".join(COLUMNS))
    found = sorted((tuple(r) for r in queries.op13_importance(spark, SF_DIR).select(*COLUMNS).collect()), key=str)
    assert found == sorted(rel.fetchall(), key=str)
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert found == _expected(rows, [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()])
    assert sum(r[4] is not None for r in found) > 5


@pytest.mark.parametrize("text", [
    "", "   ", "a", "one two three", "It's 3.14 -- été/ÉTÉ_x y\tz", "x" * 3000, "\x00\x7f", "日本語 テキスト, mixed Words", "a b c d " * 500])
def test_overlapped_scan_finds_every_run(text):
    for longest in (1, 2, 3):
        n, found = NgramBuckets(longest, 10_000).of(text.encode())
        assert (n, found.tolist()) == _features(text, longest)


def test_bucket_memory_is_bounded(monkeypatch):
    monkeypatch.setattr("tariff_engine.llm.importance._MEMO", 4)
    ngrams = NgramBuckets(1, 10_000)
    text = " ".join(f"w{k % 37}" for k in range(500))
    assert ngrams.of(text.encode())[1].tolist() == _features(text)[1]
    assert len(ngrams._memo) <= 4


def test_places_over_many_partitions(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 13).alias("score"), F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id")).alias("doc_id"))
    placed = with_places(df, F.desc("score"), F.asc("doc_id")).collect()
    assert sorted(r.place for r in placed) == list(range(1, 5001))
    ordered = sorted(placed, key=lambda r: r.place)
    assert [(r.score, r.doc_id) for r in ordered] == sorted(((r.score, r.doc_id) for r in placed), key=lambda r: (-r[0], r[1]))
