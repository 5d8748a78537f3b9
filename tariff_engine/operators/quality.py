"""Data-quality checks as Spark jobs that return the failing rows (Q1-Q5).

Each check is one aggregate pass per model; an empty result (or zero
counts for ``not_null``) means the check passes.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def check_not_null(df: DataFrame, columns: Sequence[str], model: str) -> DataFrame:
    """(model, column_name, failing_rows): NULL count of every column, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return (
        counts.unpivot([], list(columns), "column_name", "failing_rows")
        .select(F.lit(model).alias("model"), "column_name", F.col("failing_rows").cast("long").alias("failing_rows"))
    )


class WriteChecks:
    """Not-null and accepted-value counts that are collected while models are written, in the write's own pass.

    Wrap each model in :meth:`watch` right before it is written: the counts are metrics of the write, without a scan of
    their own. NULLs and unaccepted rows are counted exactly. How many *different* unaccepted values there are is not
    a bounded metric, so :meth:`unaccepted` says which columns have any; only these need :func:`check_accepted_values`.
    """

    def __init__(self, not_null: Mapping[str, Sequence[str]], accepted: Mapping[str, Sequence[tuple[str, Sequence]]]) -> None:
        self._not_null, self._accepted = not_null, accepted
        self._seen: dict[str, Observation] = {}

    def watch(self, df: DataFrame, model: str) -> DataFrame:
        metrics = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in self._not_null.get(model, ())]
        metrics += [F.count_if(~F.col(c).isin(list(values))).alias(f"bad_{c}") for c, values in self._accepted.get(model, ())]
        if not metrics:
            return df
        self._seen[model] = Observation()
        return df.observe(self._seen[model], *metrics)

    @property
    def models(self) -> list[str]:
        """The models that were written."""
        return list(self._seen)

    def nulls(self, model: str) -> list[tuple[str, int]]:
        """(column, NULL rows) of a written model."""
        found = self._seen[model].get
        return [(c, found[f"null_{c}"]) for c in self._not_null.get(model, ())]

    def unaccepted(self, model: str) -> list[tuple[str, int]]:
        """(column, rows outside the accepted set) of a written model."""
        found = self._seen[model].get
        return [(c, found[f"bad_{c}"]) for c, _ in self._accepted.get(model, ())]


def check_unique(df: DataFrame, column: str, model: str) -> DataFrame:
    """(model, column_name, value, occurrences) for non-NULL values seen more than once."""
    return (
        df.where(F.col(column).isNotNull()).groupBy(column).count().where(F.col("count") > 1)
        .select(F.lit(model).alias("model"), F.lit(column).alias("column_name"),
                F.col(column).cast("string").alias("value"), F.col("count").alias("occurrences"))
    )


def check_accepted_values(df: DataFrame, column: str, values: Iterable, model: str) -> DataFrame:
    """(model, column_name, value, failing_rows) for values outside the accepted set (NULLs pass)."""
    return (
        df.where(~F.col(column).isin(list(values))).groupBy(column).count()
        .select(F.lit(model).alias("model"), F.lit(column).alias("column_name"),
                F.col(column).cast("string").alias("value"), F.col("count").alias("failing_rows"))
    )


def check_unique_combo(df: DataFrame, columns: Sequence[str], model: str) -> DataFrame:
    """(model, key, occurrences) for column combinations seen more than once."""
    return (
        df.groupBy(*columns).count().where(F.col("count") > 1)
        .select(F.lit(model).alias("model"),
                F.concat_ws("|", *[F.col(c).cast("string") for c in columns]).alias("key"),
                F.col("count").alias("occurrences"))
    )


MARGIN_FLOOR_COLUMNS = [
    "product_code", "product_name", "energy_type", "postcode", "consumption_from", "consumption_to",
    "net_unit_rate_eur_per_kwh", "margin_eur_per_kwh",
]


def check_margin_floor(components: DataFrame) -> DataFrame:
    """Price components priced below cost (negative net rate or margin)."""
    return components.where(
        (F.col("net_unit_rate_eur_per_kwh") < 0) | (F.col("margin_eur_per_kwh") < 0)
    ).select(*MARGIN_FLOOR_COLUMNS)


def run_suite(check, models: Mapping[str, DataFrame], spec: Mapping[str, Sequence]) -> DataFrame:
    """Apply ``check(df, arg, model)`` for every (model, arg) of ``spec`` and union the results."""
    parts = []
    for model, args in spec.items():
        for arg in args:
            parts.append(check(models[model], arg, model))
    return reduce(DataFrame.unionByName, parts)
