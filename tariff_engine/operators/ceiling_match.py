"""Ceiling match (J4 + J5): a forward as-of join on a consumption level.

For every point and every entity (provider + product) quoting under the same keys, pick the smallest quoted level
that is >= the point's level, and keep *all* quotes made at that level (ties survive, as with an equality join back).

Plan, Spark-first:

1. the distinct quoted levels of each (keys, entity), as a hash aggregate with a map-side part, so that an entity
   holding a third of all quotes reaches the shuffle as a few rows per task;
2. a window over these few rows gives each level the next lower one of its entity. A level serves the points
   between the two, so the join to the points needs no aggregate per point;
3. the raw quotes join the served levels by equality, straight from their scan. The planner broadcasts the levels if
   they are small; otherwise it is a sort-merge join on a bare scan, the one shuffle of all quotes;
4. only then are copies removed: dropping copies and filtering on their own columns commute, so the dedupe sees the
   matching quotes alone, and after a sort-merge join it needs no shuffle of its own. Where a key is hot, adaptive
   execution splits its partition and adds that shuffle (``forceOptimizeSkewedJoin`` in the engine's defaults).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MATCHED_LEVEL = "matched_consumption_level_kwh"


def _matchable(quotes: DataFrame, columns: list[str]) -> DataFrame:
    """Quotes that can match at all: equality never matches a NULL key, entity or level."""
    return quotes.where(reduce(and_, [F.col(c).isNotNull() for c in columns]))


def ceiling_levels(quotes: DataFrame, points: DataFrame, keys: Sequence[str], entity: Sequence[str],
                   quote_level: str, point_level: str) -> DataFrame:
    """One row per (point, entity): the smallest quoted level >= the point level.

    Output: the keys, the entity columns, every other point column and ``matched_consumption_level_kwh``. Points with
    no quoted level at or above them produce no row. ``quotes`` may hold copies; ``points`` may share only the keys.
    """
    keys, entity = list(keys), list(entity)
    by_entity = Window.partitionBy(*keys, *entity).orderBy(MATCHED_LEVEL)
    levels = (
        _matchable(quotes, keys + entity + [quote_level])
        .select(*keys, *entity, F.col(quote_level).alias(MATCHED_LEVEL)).distinct()
        .withColumn("_below", F.lag(MATCHED_LEVEL).over(by_entity))
    )
    level = F.col(point_level)
    serves = (level <= F.col(MATCHED_LEVEL)) & (F.col("_below").isNull() | (level > F.col("_below")))
    return levels.join(points, keys).where(serves).select(
        *keys, *entity, *[c for c in points.columns if c not in keys], MATCHED_LEVEL)


def ceiling_match(quotes: DataFrame, points: DataFrame, keys: Sequence[str], entity: Sequence[str],
                  quote_level: str, point_level: str, copies: bool = True) -> DataFrame:
    """All distinct quotes at each (point, entity)'s ceiling level, with the point's columns.

    ``quotes`` and ``points`` may share only the ``keys`` column names. ``copies`` says whether ``quotes`` may hold copies;
    without them no dedupe is planned. Quotes stored in buckets of the keys, the entity and the level
    (``sinks.write_bucketed``) join in place, without an exchange.
    """
    keys, entity = list(keys), list(entity)
    served = ceiling_levels(quotes, points, keys, entity, quote_level, point_level)
    own = [c for c in points.columns if c not in keys]
    joined = _matchable(quotes, keys + entity + [quote_level]).join(
        served.withColumnRenamed(MATCHED_LEVEL, quote_level), keys + entity + [quote_level])
    matched = joined.select(*quotes.columns, *own, F.col(quote_level).alias(MATCHED_LEVEL))
    return matched.dropDuplicates() if copies else matched
