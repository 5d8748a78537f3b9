"""Ranking between own costs: brute force on odd costs, and a hot segment that spreads over tasks."""

import math
import random
import statistics
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tariff_engine.functions.numeric import exact_average
from tariff_engine.operators.ranking import SALTS, competitor_buckets, rank_own_offers

OWN = "scenario string, seg int, product string, cost double"
COMP = "seg int, cost double, rate double"


def _ranked(spark, own, comp):
    return rank_own_offers(spark.createDataFrame(own, OWN), spark.createDataFrame(comp, COMP), ["seg"], "scenario", "cost", "rate")


@pytest.mark.parametrize("seed", range(4))
def test_ranks_match_brute_force(spark, seed):
    """Costs close to each other, equal, negative, far apart and NULL; own offers with and without competitors."""
    rnd = random.Random(seed)

    def cost():
        kind = rnd.random()
        if kind < 0.1:
            return None
        if kind < 0.4:
            return float(rnd.randint(-3, 3))
        return rnd.choice([1000 + rnd.random() / 50, rnd.uniform(-5000, 5000), 10 ** rnd.uniform(-3, 7), 777.25])

    own = [(s, seg, p, cost()) for seg in range(12) for s in ("s1", "s2") for p in ("a", "b", "c")]
    comp = [(rnd.randint(0, 9), cost(), rnd.choice([None, 27.175, rnd.uniform(1, 40)])) for _ in range(400)]
    got = {(r.scenario, r.seg, r["product"]): r for r in _ranked(spark, own, comp).collect()}
    assert len(got) == len(own)
    big = lambda c: math.inf if c is None else c
    for s, seg, p, c in own:
        rivals = [x for x in comp if x[0] == seg]
        offers = [x[3] for x in own if x[:2] == (s, seg)] + [x[1] for x in rivals]
        r = got[s, seg, p]
        assert r.offer_rank == 1 + sum(big(o) < big(c) for o in offers)
        assert r.offers_in_segment == len(offers)
        priced = [x[1] for x in rivals if x[1] is not None]
        assert r.min_competitor_cost == min(priced, default=None)
        exact = float(sum(map(Fraction, priced))) / len(priced) if priced else None
        assert r.avg_competitor_cost == exact
        rates = [x[2] for x in rivals if x[2] is not None]
        assert r.avg_competitor_rate == (float(sum(map(Fraction, rates))) / len(rates) if rates else None)


def test_hot_segment_spreads_over_tasks(spark, settings):
    """One segment with half of all quotes, each with its own cost: its parts are even, and few rows meet per segment."""
    n = 40_000
    comp = spark.range(n).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise((F.col("id") % 500) + 1).cast("int").alias("seg"),
        (F.lit(500.0) + F.col("id") * 0.0625).alias("cost"), F.lit(30.0).alias("rate"))
    own = spark.createDataFrame([("s", k, p, c) for k in range(501) for p, c in (("a", 700.0), ("b", 2999.0))], OWN)
    settings({"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "64",
              "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    # the parts in which competitors join their segment's edges
    salt = F.pmod(F.xxhash64(*comp.columns), F.lit(SALTS))
    parts = [r["count"] for r in comp.where("seg = 0").groupBy(salt.alias("s")).count().collect()]
    assert len(parts) == SALTS and max(parts) < 1.1 * n / 2 / SALTS
    # what meets in one task afterwards: a row per bucket
    buckets = competitor_buckets(comp, own, ["seg"], "cost", "rate")
    assert buckets.groupBy("seg").count().agg(F.max("count")).first()[0] <= 3
    plan = buckets._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    ranked = rank_own_offers(own, comp, ["seg"], "scenario", "cost", "rate")
    got = {(r.seg, r["product"]): r.offer_rank for r in ranked.collect()}
    cost = lambda i: 500 + i * 0.0625
    assert got[0, "a"] == 1 + sum(cost(i) < 700 for i in range(0, n, 2))
    assert got[0, "b"] == 2 + sum(cost(i) < 2999 for i in range(0, n, 2))


def test_exact_average_is_that_of_the_true_doubles(spark):
    rnd = random.Random(7)
    for values in ([27.175] * 10, [0.1] * 7, [1e15, 0.3, -1e15], [rnd.uniform(-1, 1) * 10 ** rnd.randint(-2, 12) for _ in range(300)]):
        df = spark.createDataFrame([(v,) for v in values + [None]], "x double").repartition(5)
        got = df.agg(exact_average(F.col("x")).alias("m")).first().m
        assert got == float(sum(map(Fraction, values))) / len(values)
    assert spark.createDataFrame([(None,)], "x double").agg(exact_average(F.col("x")).alias("m")).first().m is None
    ints = spark.createDataFrame([(k,) for k in (1, 2, 4)], "x long").agg(exact_average(F.col("x")).alias("m")).first().m
    assert ints == statistics.fmean([1, 2, 4])
