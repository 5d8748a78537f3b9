"""Band join (J3): a point falls into every band whose inclusive range holds it.

Two forms with the same result:

* :func:`band_join` joins two DataFrames on equality keys plus the range condition, by range bins, so that one
  key with most of the bands and points is spread over as many tasks as its range has bins.
* :func:`expand_levels` handles the common case where the points are the
  handful of configured reference levels: each band filters the level array
  of its energy type and explodes it. No join and no shuffle at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariff_engine.params import DEFAULT_PARAMS, PricingParams


#: Width of the narrowest bins, and by how much the bins of a level are wider than those of the level before.
BIN_WIDTH = 64
BIN_FACTOR = 64
#: Levels of bins: bins of the last one are wider than the range of an int.
BIN_LEVELS = 6


def _bin(value: Column, level: Column) -> Column:
    return F.floor(value / F.pow(F.lit(float(BIN_FACTOR)), level) / F.lit(float(BIN_WIDTH)))


def band_join(points: DataFrame, bands: DataFrame, keys: Sequence[str], point: str, lo: str, hi: str) -> DataFrame:
    """Inner join of points to bands on ``keys`` with ``lo <= point <= hi`` (whole numbers).

    A point in a gap is dropped; a point in two overlapping bands yields two rows. NULL keys, points and edges match nothing.

    A band is repeated for each bin that it meets, on the level whose bins are at least a 64th of its width, so some 66
    times at most; a point has one bin on each level. A band is on one level, so a point and a band meet at most once.
    """
    width = F.col(hi).cast("long") - F.col(lo).cast("long") + 1
    exponent = F.ceil(F.log(width / F.lit(float(BIN_WIDTH))) / F.log(F.lit(float(BIN_FACTOR)))) - 1
    level = F.least(F.greatest(F.lit(0), exponent), F.lit(BIN_LEVELS - 1)).cast("int")
    binned_bands = (
        bands.where(F.col(lo) <= F.col(hi)).withColumn("_level", level)
        .withColumn("_bin", F.explode(F.sequence(_bin(F.col(lo), F.col("_level")), _bin(F.col(hi), F.col("_level")))))
    )
    binned_points = points.where(F.col(point).isNotNull()).withColumn(
        "_level", F.explode(F.sequence(F.lit(0), F.lit(BIN_LEVELS - 1)))).withColumn("_bin", _bin(F.col(point), F.col("_level")))
    cond = [F.col(f"p.{k}") == F.col(f"b.{k}") for k in keys]
    cond += [F.col(f"p.{c}") == F.col(f"b.{c}") for c in ("_level", "_bin")]
    cond.append(F.col(f"p.{point}").between(F.col(f"b.{lo}"), F.col(f"b.{hi}")))
    out = [F.col(f"p.{c}") for c in points.columns]
    out += [F.col(f"b.{c}") for c in bands.columns if c not in keys]
    return binned_points.alias("p").join(binned_bands.alias("b"), cond, "inner").select(*out)


def _levels_by_energy(params: PricingParams) -> Column:
    """Map energy type -> array<struct<consumption_level_kwh, consumption_label>>."""
    grouped: dict[str, list[tuple[int, str]]] = {}
    for energy, kwh, label in params.levels():
        grouped.setdefault(energy, []).append((kwh, label))
    entries = []
    for energy, levels in grouped.items():
        entries.append(F.lit(energy))
        entries.append(F.array(*[
            F.struct(F.lit(kwh).cast("int").alias("consumption_level_kwh"),
                     F.lit(label).alias("consumption_label"))
            for kwh, label in levels
        ]))
    return F.create_map(*entries)


def expand_levels(bands: DataFrame, params: PricingParams = DEFAULT_PARAMS, lo: str = "consumption_from",
                  hi: str = "consumption_to") -> DataFrame:
    """Attach every configured reference level of the band's energy type that lies in [lo, hi]."""
    matching = F.filter(
        F.try_element_at(_levels_by_energy(params), F.col("energy_type")),
        lambda lvl: lvl["consumption_level_kwh"].between(F.col(lo), F.col(hi)),
    )
    return (
        bands.withColumn("_level", F.explode(matching))
        .select("*", F.col("_level.consumption_level_kwh").alias("consumption_level_kwh"),
                F.col("_level.consumption_label").alias("consumption_label"))
        .drop("_level")
    )
