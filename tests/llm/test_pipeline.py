"""The pipeline's stages against plain Python, and the registered queries against their SQL."""

import duckdb
import pytest
from test_exact_dedup import LOWER
from test_shingle_join import _expected as near_components

import __spark_entry__ as entry_module
import corpus_pipeline
from tariff_engine.llm import queries

SF_DIR = "/root/testdata/sf0.001"


def test_stages_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    rows = [tuple(r) for r in docs.collect()]
    first = corpus_pipeline.known_language(spark, docs, SF_DIR)
    assert first.columns == columns
    left = [tuple(r) for r in first.collect()]
    assert set(left) <= set(rows) and len(left) >= 0.97 * len(rows)  # clean documents stay

    second = corpus_pipeline.exact_copies(spark, first, SF_DIR)
    keep = {}
    for r in left:
        key = r[1].translate(LOWER)
        keep[key] = max(keep.get(key, r), r)
    assert sorted(tuple(r) for r in second.collect()) == sorted(keep.values())

    third = corpus_pipeline.near_copies(spark, second, SF_DIR)
    least = {i: c for i, _, c in near_components([(r[0], r[1]) for r in keep.values()])}
    assert third.columns == columns
    assert sorted(r.doc_id for r in third.collect()) == sorted(i for i, c in least.items() if i == c)

    packed = corpus_pipeline.packed(spark, third, SF_DIR)
    assert {r.doc_id for r in packed.collect()} == {i for i, c in least.items() if i == c}


def test_run_applies_every_stage(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "exact dedup", "n-gram Jaccard join", "best-fit packing"]
    ids = {r.doc_id for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert 0 < len(ids) <= spark.read.parquet(f"{SF_DIR}/documents.parquet").count()


def test_stages_take_edge_rows(spark, edge, nothing):
    docs = edge.selectExpr("*", "CASE WHEN doc_id % 2 = 0 THEN 'en' ELSE 'de' END AS lang")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == [*edge.columns, "lang"]
    ids = [r.doc_id for r in docs.collect()]
    assert 3 not in ids and 4 not in ids and 5 not in ids and 9 not in ids  # no letters
    assert ids.count(8) == 1 and (1 in ids) + (2 in ids) == 1 and ids.count(None) == 1
    assert corpus_pipeline.packed(spark, docs, "").count() > 0
    empty = nothing.selectExpr("*", "'en' AS lang")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0


def test_near_copies_are_decided_row_by_row(spark):
    """One id on several texts, repeated rows, null ids, and columns named like the stage's own."""
    near = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen"
    rows = [
        (1, near, "a", 0), (5, near + " nineteen", "b", 1), (5, "an unrelated text with words of its own, and some more", "c", 2),
        (7, "yet another one that nothing else here is like at all", "d", 3), (None, near + " twenty", "e", 4),
        (9, "said twice by the same id and kept but once in the end", "f", 5), (9, "said twice by the same id and kept but once in the end", "f", 6),
        (None, "only null ids have this text, which is long enough", "g", 7), (None, "only null ids have this text, which is long enough", "g", 8),
        (11, "", "h", 9), (11, None, "i", 10),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, gone long").repartition(3)
    kept = corpus_pipeline.near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    left = sorted((r.doc_id or 0, r.row) for r in kept.collect())
    assert left == [(0, "g"), (1, "a"), (5, "c"), (7, "d"), (9, "f"), (11, "h"), (11, "i")]


def test_least_score_follows_chance():
    assert corpus_pipeline.least_score(1) < 1.0
    assert abs(corpus_pipeline.least_score(4) - 0.3) < 1e-6
    assert 0.01 < corpus_pipeline.least_score(100) < 0.08


def test_one_query_of_each_operator_is_registered():
    names = entry_module.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)}
    assert "pipeline" in names and set(queries.ORACLE_SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    rel = con.sql(queries.ORACLE_SQL[name])
    df = queries.QUERIES[name](spark, SF_DIR)
    assert sorted(map(tuple, df.select(*rel.columns).collect()), key=str) == sorted(rel.fetchall(), key=str)
