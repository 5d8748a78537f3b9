"""Quarantined lines, ordered marts, switched views, bucketed quotes and the checks of the write pass."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from frames import rows
from tariff_engine import schemas, sinks
from tariff_engine.operators.band_join import band_join
from tariff_engine.operators.quality import WriteChecks
from tariff_engine.plans import market, through_files
from tariff_engine.plans.market import ANALYSIS_ORDER
from tariff_engine.plans.marts import build_marts
from tariff_engine.plans.model import PricingModel
from tariff_engine.shared import shared_folder
from tariff_engine.sources.driver_tables import load_inputs
from tariff_engine.sources.files import read_price_list_export, read_with_quarantine

SF_DIR = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables not present")


# ---- quarantine ------------------------------------------------------------------------------

def test_bad_lines_are_set_aside_with_their_text(spark, tmp_path):
    good = ["GAS,01067,Town,200,1000,0.04,31.0", 'GAS,99999,"Two, Towns",0,9,0.05,30.0', "GAS,1,,,,,"]
    bad = ["GAS,1,Town,200,many,0.04,31.0", "GAS,2,Town,200", "GAS,3,Town,1,2,0.1,0.2,extra"]
    (tmp_path / "bands.csv").write_text("\n".join([",".join(schemas.RAW_COST_BANDS.names), good[0], bad[0], good[1], *bad[1:], good[2]]) + "\n")
    kept, lines = read_with_quarantine(spark, str(tmp_path / "bands.csv"), schemas.RAW_COST_BANDS)
    assert kept.schema == schemas.RAW_COST_BANDS
    assert rows(kept.select("postcode", "town", "consumption_to")) == [("01067", "Town", 1000), ("1", None, None), ("99999", "Two, Towns", 9)]
    assert sorted(r.raw_line for r in lines.collect()) == sorted(bad)
    assert all(r.source_file.endswith("bands.csv") for r in lines.collect())


def test_quarantine_of_a_clean_and_an_empty_file(spark, tmp_path):
    header = ",".join(schemas.RAW_PRODUCTS.names)
    (tmp_path / "p.csv").write_text(header + "\nP1,Volt,GAS,3.0,50,0.19,9.5,12,12\n")
    (tmp_path / "e.csv").write_text(header + "\n")
    for name, n in (("p.csv", 1), ("e.csv", 0)):
        kept, lines = read_with_quarantine(spark, str(tmp_path / name), schemas.RAW_PRODUCTS)
        assert (kept.count(), lines.count()) == (n, 0)


# ---- marts -----------------------------------------------------------------------------------

@tables
def test_marts_are_in_the_models_order_and_prunable(spark, tmp_path, settings):
    settings({"spark.sql.adaptive.coalescePartitions.enabled": "false"})  # several files from so few rows
    paths = build_marts(spark, load_inputs(spark, SF_DIR), str(tmp_path), export_csv=False)
    files = sorted(glob.glob(os.path.join(paths["market_analysis"], "part-*.parquet")))
    keys = [tuple(r.values()) for f in files for r in pq.read_table(f, columns=ANALYSIS_ORDER).to_pylist()]
    assert len(files) > 2 and keys == sorted(keys)
    # the statistics of few row groups admit a given energy type and postcode
    groups = [pq.ParquetFile(f).metadata.row_group(k) for f in files for k in range(pq.ParquetFile(f).metadata.num_row_groups)]

    def spans(name):
        columns = [next(g.column(c) for c in range(g.num_columns) if g.column(c).path_in_schema == name) for g in groups]
        return [(c.statistics.min, c.statistics.max) for c in columns]

    wanted = keys[len(keys) // 3][:2]
    admitted = [e[0] <= wanted[0] <= e[1] and (e[0] != e[1] or p[0] <= wanted[1] <= p[1]) for e, p in zip(spans("energy_type"), spans("postcode"))]
    assert 1 <= sum(admitted) <= len(groups) // 2


def test_a_failing_write_leaves_the_views(spark, tmp_path):
    def run(df):
        root = sinks.new_version(str(tmp_path))
        path = sinks.write_mart(df, f"{root}/numbers", ["id"])
        sinks.publish(spark, {"test_numbers": path})

    run(spark.range(5))
    assert spark.table("test_numbers").count() == 5
    with pytest.raises(Exception, match="broken"):
        run(spark.range(9).select(F.when(F.col("id") == 7, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")).alias("id")))
    assert [r.id for r in spark.table("test_numbers").orderBy("id").collect()] == list(range(5))
    run(spark.range(2))
    assert spark.table("test_numbers").count() == 2


@tables
def test_a_failing_build_leaves_the_views(spark, tmp_path):
    inputs = load_inputs(spark, SF_DIR)
    build_marts(spark, inputs, str(tmp_path), export_csv=False, view_prefix="live_")
    before = spark.table("live_price_list").count()
    broken = type(inputs)(inputs.cost_bands, inputs.products, inputs.quotes.withColumn(
        "contract_length_months", F.raise_error(F.lit("broken")).cast("string")))
    with pytest.raises(Exception, match="broken"):
        build_marts(spark, broken, str(tmp_path), export_csv=False, view_prefix="live_")
    assert spark.table("live_price_list").count() == before > 0


@tables
def test_exports_keep_leading_zeros(spark, tmp_path):
    paths = build_marts(spark, load_inputs(spark, SF_DIR), str(tmp_path))
    back = read_price_list_export(spark, paths["exports/price_lists"])
    assert back.where("postcode LIKE '0%'").count() > 0
    assert back.where("length(postcode) <> 5").count() == 0


# ---- stored quotes ---------------------------------------------------------------------------

@tables
def test_stored_quotes_join_without_an_exchange(spark, tmp_path, settings):
    model = PricingModel.from_tables(spark, SF_DIR)
    stored = through_files.store_quotes(model, "test_stored_quotes", str(tmp_path / "quotes"))
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
              "spark.sql.maxMetadataStringLength": "1000"})
    matched = through_files.competitors_from_stored(model, stored)
    matched.collect()
    plan = matched._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    lines = plan.splitlines()
    scans = [k for k, line in enumerate(lines) if "FileScan" in line and "test_stored_quotes" in line]
    assert len(scans) == 2 and all("Bucketed: true" in lines[k] for k in scans)
    # the scan with the prices reaches its join before any exchange
    wide = next(k for k in scans if "unit_rate_ct_per_kwh" in lines[k].split("ReadSchema")[1])
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    above = []
    level = depth(lines[wide])
    for line in reversed(lines[:wide]):
        if depth(line) < level:
            above.append(line)
            level = depth(line)
    first_join = next(k for k, line in enumerate(above) if "Join" in line and "LeftSemi" not in line)
    assert not any("Exchange" in line for line in above[:first_join])
    expected = market.competitors_at_levels(model.market_quotes, model.points)
    assert rows(matched.select(expected.columns)) == rows(expected)


# ---- checks of the write pass -----------------------------------------------------------------

def test_write_checks_count_in_the_write(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, "z"), (4, None), (None, "z")], "n int, c string").repartition(3)
    checks = WriteChecks({"m": ["n", "c"]}, {"m": [("c", ["a", "b"])]})
    sinks.write_mart(df, str(tmp_path / "m"), ["n"], lambda out: checks.watch(out, "m"))
    assert checks.models == ["m"]
    assert checks.nulls("m") == [("n", 2), ("c", 1)]
    assert checks.unaccepted("m") == [("c", 2)]
    assert checks.watch(df, "other") is df


# ---- band join in bins ------------------------------------------------------------------------

def test_band_join_matches_brute_force(spark):
    import random
    rnd = random.Random(4)
    bands, points = [], []
    for k in range(400):
        lo = rnd.choice([rnd.randint(-200, 5000), rnd.randint(0, 2_000_000_000), -2_000_000_000])
        width = rnd.choice([0, 1, 63, 64, 65, 4095, 4096, 4097, 262_143, 262_144, rnd.randint(0, 4_000_000_000)])
        bands.append((rnd.choice("AB"), lo, min(2_147_483_647, lo + width), k))
    bands += [("A", 9, 3, 1000), ("A", None, 10, 1001), ("B", 10, None, 1002), (None, 0, 10, 1003)]
    points += [(rnd.choice("AB"), rnd.choice([b[1] or 0, b[2] or 0, (b[2] or 0) + 1, rnd.randint(-300, 6000)])) for b in bands for _ in range(2)]
    points = [(k, min(p, 2_147_483_647)) for k, p in points] + [("A", None), (None, 5)]
    df = band_join(spark.createDataFrame(points, "k string, p int"), spark.createDataFrame(bands, "k string, lo int, hi int, band int"),
                   ["k"], "p", "lo", "hi")
    assert df.columns == ["k", "p", "lo", "hi", "band"]
    expected = [(k, p, lo, hi, n) for k, p in points for b, lo, hi, n in bands
                if k is not None and k == b and None not in (p, lo, hi) and lo <= p <= hi]
    assert rows(df) == sorted(expected)


def test_band_join_spreads_a_hot_key(spark, settings):
    """One key holds all bands and points: they meet in many partitions."""
    settings({"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
              "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    bands = spark.range(2000).select(F.lit("hot").alias("k"), (F.col("id") * 100).alias("lo"), (F.col("id") * 100 + 99).alias("hi"))
    points = spark.range(20000).select(F.lit("hot").alias("k"), (F.col("id") * 10).alias("p"))
    joined = band_join(points, bands, ["k"], "p", "lo", "hi")
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("part")).count().collect()]
    assert sum(sizes) == 20000 and len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(sizes) < 20000 / 3


# ---- shared folder ----------------------------------------------------------------------------

class _Settings:
    def __init__(self, values):
        self.conf = self
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


def test_a_cluster_needs_a_named_folder():
    with pytest.raises(ValueError, match="share"):
        shared_folder(_Settings({"spark.master": "spark://host:7077"}))
    assert shared_folder(_Settings({"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///x/"})) == "hdfs:///x"
    local = _Settings({"spark.master": "local[4]"})
    assert shared_folder(local) == shared_folder(local)
