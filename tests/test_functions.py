"""Column functions: rounding (T1), duration text (D1, T5), postcode (P5), pricing formulas."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frames import rows
from tariff_engine.functions import pricing as P
from tariff_engine.functions.numeric import exact_average, round_half_away
from tariff_engine.functions.text import contract_months, norm_postcode


def _one_col(spark, values, dtype):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("x", dtype)]))


def test_round_half_away_known_cases(spark):
    df = _one_col(spark, [1.005, 0.285, 2.675, -2.5, 2.5, None], T.DoubleType())
    got = [r[0] for r in df.select(round_half_away(F.col("x"), 2)).collect()]
    assert got == [1.0, 0.28, 2.68, -2.5, 2.5, None]
    got0 = [r[0] for r in df.select(round_half_away(F.col("x"), 0)).collect()]
    assert got0[3:5] == [-3.0, 3.0]


@pytest.mark.parametrize("digits", [0, 1, 2, 4])
def test_round_half_away_matches_duckdb(spark, digits):
    rnd = random.Random(7 + digits)
    values = [round(rnd.uniform(-5000, 5000), rnd.choice([2, 3, 4, 5, 6])) for _ in range(3000)]
    values += [k / 1000 for k in range(0, 3000, 5)]
    got = [r[0] for r in _one_col(spark, values, T.DoubleType()).select(round_half_away(F.col("x"), digits)).collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE v(i INTEGER, x DOUBLE)")
    con.executemany("INSERT INTO v VALUES (?, ?)", list(enumerate(values)))
    expected = [r[0] for r in con.execute(f"SELECT ROUND(x, {digits}) FROM v ORDER BY i").fetchall()]
    assert got == expected


def test_exact_average_does_not_depend_on_order(spark):
    values = [27.1, 27.2, 27.3, 27.1, 27.2, 27.1, 27.15, 27.2, 27.2, 27.2]
    found = set()
    for seed in range(20):
        shuffled = random.Random(seed).sample(values, len(values))
        df = _one_col(spark, shuffled + [None], T.DoubleType()).repartition(seed % 5 + 1)
        found.add(df.select(exact_average(F.col("x"))).first()[0])
    assert found == {27.175}
    assert _one_col(spark, [None], T.DoubleType()).select(exact_average(F.col("x"))).first()[0] is None


def test_contract_months_cases(spark):
    texts = ["1 Woche", "2 Wochen", "3 Wochen", "1 Jahr", "2 JAHRE", "1 Monat", "12 Monate", "24", "unbefristet", None]
    df = _one_col(spark, texts, T.StringType())
    got = [r[0] for r in df.select(contract_months(F.col("x"))).collect()]
    assert got == [0, 0, 1, 12, 24, 1, 12, 24, None, None]


def test_norm_postcode(spark):
    df = _one_col(spark, ["1067", "01067", "123456", None], T.StringType())
    assert [r[0] for r in df.select(norm_postcode(F.col("x"))).collect()] == ["01067", "01067", "12345", None]
    ints = _one_col(spark, [1067, 81671], T.IntegerType())
    assert [r[0] for r in ints.select(norm_postcode(F.col("x"))).collect()] == ["01067", "81671"]


def test_margin_floor_and_display(spark):
    df = spark.createDataFrame([("ELECTRICITY", -1.0, 0.5), ("GAS", 1.5, -0.3), ("HEAT", 1.5, 0.7)],
                               "energy_type string, e double, g double")
    out = df.select(P.effective_margin(F.col("energy_type"), F.col("e"), F.col("g")).alias("m"),
                    P.scenario_margin_ct(F.col("energy_type"), F.col("e"), F.col("g")).alias("shown"))
    assert rows(out, order=True) == [(0.0, -1.0), (0.0, -0.3), (0.7 / 100.0, 0.7)]


def test_bonus_cap_and_zero_lifetime(spark):
    df = spark.createDataFrame([(100.0, 94.9, 0.05, 3.0), (100.0, 1000.0, 0.05, 0.0)],
                               "target double, at_from double, margin double, life double")
    out = df.select(
        P.capped_bonus(F.col("target"), F.col("at_from"), 0.15).alias("bonus"),
        P.annual_margin(F.col("margin"), F.lit(1000), F.lit(10.0), F.lit(14.0), F.lit(55.0), F.col("life")).alias("am"),
    ).collect()
    assert abs(out[0]["bonus"] - 14.235) < 1e-12 and out[1]["bonus"] == 100.0
    assert out[0]["am"] == pytest.approx(0.05 * 1000 + 10.0 - (14.0 + 55.0) / 3.0)
    assert out[1]["am"] is None


def test_percentile_rank_lone_offer(spark):
    df = spark.createDataFrame([(1, 1), (2, 3), (3, 3)], "r long, n long")
    got = [r[0] for r in df.select(P.percentile_rank(F.col("r"), F.col("n"))).collect()]
    assert got == [None, 50.0, 100.0]


def test_quote_annual_cost_null_bonus(spark):
    df = spark.createDataFrame([(30.0, 60.0, None), (30.0, 60.0, 50.0)], "ur double, sc double, b double")
    got = [r[0] for r in df.select(P.quote_annual_cost(F.col("ur"), F.lit(2000), F.col("sc"), F.col("b"))).collect()]
    assert got == [None, 30.0 / 100.0 * 2000 + 60.0 - 50.0]
