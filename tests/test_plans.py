"""Plan properties that matter at scale, checked on the executed (adaptive) plans, with few and with many splits."""

import os
import re

import pytest
from pyspark.sql import functions as F

from tariff_engine.operators.ceiling_match import ceiling_match
from tariff_engine.plans import catalog
from tariff_engine.session import ENGINE_DEFAULTS

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables not present")

#: Settings under which a small input behaves like a large one: many splits, no broadcasts, low skew thresholds.
MANY_SPLITS = {
    "spark.sql.files.maxPartitionBytes": "8k",
    "spark.sql.files.openCostInBytes": "0",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


def _final_plan(spark, df):
    """The executed plan with its details, without the plan that adaptive execution started from."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def _query_plan(spark, name):
    return _final_plan(spark, catalog.CATALOG[name].run(spark, SF_DIR))


def _read_schemas(plan, table):
    """ReadSchema of every scan of a table."""
    return [
        re.search(r"ReadSchema: struct<(.*)>", line).group(1)
        for line in plan.splitlines() if "FileScan" in line and f"{table}.parquet" in line
    ]


@pytest.mark.parametrize("name", ["price_list", "market_analysis", "performance_summary"])
def test_no_nested_loop_or_cartesian_joins(spark, name):
    plan = _query_plan(spark, name)
    assert "BroadcastNestedLoopJoin" not in plan
    assert "CartesianProduct" not in plan
    assert "InMemoryTableScan" not in plan


def test_building_a_query_runs_no_job(spark):
    # a job would fail: there is no such group's job afterwards
    spark.sparkContext.setJobGroup("build", "build")
    for name in ("price_list", "market_analysis", "performance_summary", "dq_not_null"):
        catalog.CATALOG[name].run(spark, SF_DIR)
    tracked = spark.sparkContext.statusTracker().getJobIdsForGroup("build")
    spark.sparkContext.setJobGroup("rest", "rest")
    listing = [j for j in tracked if spark.sparkContext.statusTracker().getJobInfo(j) is not None]
    # parquet schema reads are the only jobs: one task each
    for job in listing:
        for stage in spark.sparkContext.statusTracker().getJobInfo(job).stageIds:
            info = spark.sparkContext.statusTracker().getStageInfo(stage)
            assert info is None or info.numTasks <= 1


def test_scans_read_only_used_columns(spark):
    plan = _query_plan(spark, "market_analysis")
    assert _read_schemas(plan, "customer") and all(s == "c_custkey:bigint" for s in _read_schemas(plan, "customer"))
    schemas = _read_schemas(plan, "lineitem")
    assert schemas
    for schema in schemas:
        for unused in ("l_shipdate", "l_returnflag", "l_linestatus", "l_linenumber"):
            assert unused not in schema
    # the scan for the quoted levels is narrow
    assert any("l_extendedprice" not in s for s in schemas)


def test_price_list_expands_one_scenario(spark):
    plan = _query_plan(spark, "price_list")
    assert "standard" in plan and "aggressive" not in plan


def test_catalogue_is_broadcast_not_the_bands(spark):
    plan = _query_plan(spark, "price_list")
    assert "BroadcastHashJoin" in plan
    below = [plan.splitlines()[k + 1:k + 4] for k, line in enumerate(plan.splitlines()) if "BroadcastExchange" in line]
    assert below and all("LocalTableScan" in "".join(lines) for lines in below)


def test_same_operators_with_many_splits(spark, settings):
    """One plan at every scale: what differs is the join strategy that Spark picks by size, and no result."""
    few = sorted(map(tuple, catalog.CATALOG["market_analysis"].run(spark, SF_DIR).collect()), key=str)
    settings(MANY_SPLITS)
    plan = _query_plan(spark, "market_analysis")
    assert len(_read_schemas(plan, "lineitem")) == 2  # the quotes, and the narrow scan for their levels
    assert "BroadcastHashJoin" not in plan and "BroadcastNestedLoopJoin" not in plan
    many = sorted(map(tuple, catalog.CATALOG["market_analysis"].run(spark, SF_DIR).collect()), key=str)
    assert few == many


def test_hot_key_is_split_in_the_join_back(spark, settings):
    """Two thirds of all quotes have one key: adaptive execution splits its partition, as the join stands on a scan."""
    settings(MANY_SPLITS | {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": ENGINE_DEFAULTS["spark.sql.adaptive.forceOptimizeSkewedJoin"],
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    })
    hot = F.col("id") % 3 != 0
    quotes = spark.range(0, 60_000, 1, 16).select(
        F.when(hot, F.lit("hot")).otherwise((F.col("id") % 997).cast("string")).alias("k"),
        F.concat(F.lit("p"), (F.col("id") % 2).cast("string")).alias("provider"),
        F.when(F.col("id") % 5 == 0, 2500).otherwise(2000).alias("q"),
        F.sha2(F.col("id").cast("string"), 256).alias("note"))
    points = quotes.select("k").distinct().withColumn("level", F.lit(1500))
    matched = ceiling_match(quotes, points, ["k"], ["provider"], "q", "level")
    plan = _final_plan(spark, matched)
    assert "skew=true" in plan
    assert matched.where("k = 'hot'").count() == sum(1 for k in range(60_000) if k % 3 and k % 5)


def test_generated_code_of_the_market_is_small_enough_to_be_compiled(spark):
    """The virtual machine interprets methods of more than 8,000 bytes, at several times the cost a row."""
    df = catalog.CATALOG["market_by_sql"].run(spark, SF_DIR)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # an adaptive plan shows no code before it ran
    try:
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        code = df._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert len(sizes) > 10 and max(sizes) < 8000
