"""Exact dedup against grouping in plain Python."""

import hashlib
import string

import pytest

from tariff_engine.llm.exact_dedup import exact_dedup

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def _expected(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault((text or "").translate(LOWER), []).append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


@pytest.mark.parametrize("hot_share", [1e-4, 0.05, 0.5])
def test_groups_with_and_without_salts(spark, hot_share):
    rows = [(k, f"Copy {k % 3}" if k % 2 else f"text {k}") for k in range(300)] + [(300 + k, "hot É") for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = exact_dedup(df, hot_share=hot_share).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=str) == _expected(rows)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in found)


def test_edge_rows(edge, nothing):
    from edge_rows import EDGE_ROWS

    found = exact_dedup(edge, carry=True).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=str) == _expected(EDGE_ROWS)
    kept = {}
    for r in found:
        kept[r.text_sha256] = kept.get(r.text_sha256, 0) + r.kept
    assert set(kept.values()) == {1}  # of a repeated row, too, exactly one stays
    assert all(r.row.keep_id == "x" and r.row.row == "x" for r in found)
    assert exact_dedup(nothing).count() == 0


def test_no_python_in_the_plan(spark, documents):
    plan = exact_dedup(documents)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
