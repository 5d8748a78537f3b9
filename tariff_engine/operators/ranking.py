"""Ranking of own offers inside a market segment (W4-W7) without a task that holds a segment's competitors.

The reference ranks every offer of a segment with ``RANK() OVER (PARTITION BY segment ORDER BY cost)``. A window over
all offers puts a whole segment into one task, and one segment may hold half of all competitor quotes, each with a cost
of its own. Only own offers leave the analysis, and competitors are the same in every scenario, so it is enough to
know how many competitors lie between any two neighbouring own costs:

* a segment's own costs are its *range buckets*: the edges of a bucket are two neighbouring ones. There are at most as many
  as the segment has own offers, and they are exact, so no bucket has to be sorted within;
* each competitor joins its segment's edges and falls into the bucket below the first dearer own cost. The join key has a
  salt, so a hot segment spreads over `SALTS` parts, which adaptive execution may split further;
* buckets are counted with a map-side part: a task sends at most one row per bucket, however many competitors it has seen;
* these few rows and the own offers meet per segment. A prefix sum over the buckets up to an own cost gives the cheaper
  competitors; the sums over all buckets give the segment's context;
* own offers of the same scenario are ranked among themselves.

The rank is 1 + the cheaper ones of both kinds, as in RANK; NULL costs sort last. Sums are exact (``numeric.exact_parts``),
so the context does not depend on the order in which buckets are added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tariff_engine.functions.numeric import exact_parts, exact_total, safe_div

#: Parts over which the competitors of one segment are dealt.
SALTS = 8

_SUMS = ["_n", "_n_rate", "_rate_whole", "_rate_fraction", "_n_cost", "_cost_whole", "_cost_fraction"]


def competitor_buckets(competitors: DataFrame, own: DataFrame, segment: Sequence[str], cost: str, rate: str) -> DataFrame:
    """Competitors per segment and ``_edge``, the lowest own cost above theirs (NULL if there is none, or they have no cost).

    One row holds how many there are, how many with a rate and a cost, the exact sums of these, and the least cost.
    Segments without own offers are left out.
    """
    segment = list(segment)
    edges = own.groupBy(*segment).agg(F.collect_set(cost).alias("_edges")).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    salt = F.pmod(F.xxhash64(*competitors.columns), F.lit(SALTS))
    dealt = competitors.select(*segment, cost, rate, salt.alias("_salt"))
    edge = F.array_min(F.filter("_edges", lambda x: x > F.col(cost)))
    placed = dealt.join(edges, [*segment, "_salt"]).select(*segment, cost, rate, edge.alias("_edge"))
    rate_whole, rate_fraction = exact_parts(F.col(rate))
    cost_whole, cost_fraction = exact_parts(F.col(cost))
    return placed.groupBy(*segment, "_edge").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count(rate).alias("_n_rate"), F.sum(rate_whole).alias("_rate_whole"), F.sum(rate_fraction).alias("_rate_fraction"),
        F.count(cost).alias("_n_cost"), F.sum(cost_whole).alias("_cost_whole"), F.sum(cost_fraction).alias("_cost_fraction"),
        F.min(cost).alias("_least"),
    )


def rank_own_offers(own: DataFrame, competitors: DataFrame, segment: Sequence[str], scenario: str, cost: str, rate: str) -> DataFrame:
    """Own offers with ``offer_rank`` (RANK, cost ascending, NULLs last), ``offers_in_segment`` and the context.

    The context (``avg_competitor_rate``, ``avg_competitor_cost``, ``min_competitor_cost``) is NULL where a segment has
    no competitor. ``competitors`` have the columns of ``segment``, ``cost`` and ``rate``, and any others.
    """
    segment = list(segment)
    buckets = competitor_buckets(competitors, own, segment, cost, rate)
    together = own.withColumn("_edge", F.col(cost)).withColumn("_own", F.lit(True)).unionByName(buckets, allowMissingColumns=True)

    per_segment = Window.partitionBy(*segment)
    # with all rows of the same edge: competitors below an edge are cheaper than the own offers at it
    up_to = per_segment.orderBy(F.asc_nulls_last("_edge")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    whole = {c: F.sum(c).over(per_segment) for c in _SUMS}
    cheaper = F.when(F.col(cost).isNull(), whole["_n_cost"]).otherwise(F.sum("_n").over(up_to))
    counted = together.select(
        *own.columns, "_own",
        F.coalesce(cheaper, F.lit(0)).alias("_cheaper"),
        F.coalesce(whole["_n"], F.lit(0)).alias("_competitors"),
        safe_div(exact_total(whole["_rate_whole"], whole["_rate_fraction"]), whole["_n_rate"]).alias("avg_competitor_rate"),
        safe_div(exact_total(whole["_cost_whole"], whole["_cost_fraction"]), whole["_n_cost"]).alias("avg_competitor_cost"),
        F.min("_least").over(per_segment).alias("min_competitor_cost"),
    ).where("_own")
    by_scenario = Window.partitionBy(*segment, scenario)
    return counted.select(
        *own.columns, "avg_competitor_rate", "avg_competitor_cost", "min_competitor_cost",
        (F.rank().over(by_scenario.orderBy(F.asc_nulls_last(cost))) + F.col("_cheaper")).cast("long").alias("offer_rank"),
        (F.count(F.lit(1)).over(by_scenario) + F.col("_competitors")).cast("long").alias("offers_in_segment"),
    )
