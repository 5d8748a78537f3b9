"""Roll-ups of the market analysis: performance summary (E4) and heatmap matrix (E5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariff_engine.functions.numeric import exact_average
from tariff_engine.functions.numeric import round_half_away as rnd
from tariff_engine.params import LEVEL_LABELS

SUMMARY_KEYS = ["scenario", "energy_type", "product", "consumption_label", "consumption_level_kwh",
                "contract_length_months", "margin_ct_per_kwh"]
SUMMARY_ORDER = ["energy_type", "product", "consumption_level_kwh", "contract_length_months", "scenario"]
HEATMAP_KEYS = ["energy_type", "scenario", "postcode"]


def performance_summary(analysis: DataFrame) -> DataFrame:
    """Win rates and averages per scenario, energy type, product, level and contract.

    A plain grouped aggregate: partial aggregation per task, one small shuffle.
    """
    cheapest = F.count_if(F.col("is_cheapest"))
    top = F.count_if(F.col("is_top_3"))
    segments = F.count(F.lit(1))
    pct = F.lit(100.0)
    return analysis.groupBy(*SUMMARY_KEYS).agg(
        segments.alias("total_market_segments"),
        cheapest.alias("segments_where_cheapest"),
        top.alias("segments_where_top_3"),
        rnd(pct * cheapest / segments, 1).alias("pct_cheapest"),
        rnd(pct * top / segments, 1).alias("pct_top_3"),
        rnd(exact_average(F.col("our_rank")), 1).alias("avg_rank"),
        rnd(exact_average(F.col("percentile_rank")), 1).alias("avg_percentile"),
        rnd(exact_average(F.col("delta_vs_cheapest_competitor_eur")), 2).alias("avg_delta_vs_cheapest_eur"),
        rnd(exact_average(F.col("our_annual_cost_after_bonus_eur")), 2).alias("avg_our_annual_cost_eur"),
        rnd(exact_average(F.col("avg_competitor_annual_cost_eur")), 2).alias("avg_market_annual_cost_eur"),
    )


def heatmap_matrix(analysis: DataFrame, labels=LEVEL_LABELS) -> DataFrame:
    """Mean percentile rank per (energy type, scenario, postcode) x level label (E5).

    One long pivot covering every energy type and scenario; the caller filters
    to one (energy type, scenario) pair for a single heatmap. Rows without a
    percentile are left out, as the plotting pivot drops empty cells; the four
    label columns are always present (NULL where empty). Cells are averages
    over exact sums, rounded to 2 dp.
    """
    return (
        analysis.where(F.col("percentile_rank").isNotNull())
        .groupBy(*HEATMAP_KEYS)
        .pivot("consumption_label", list(labels))
        .agg(rnd(exact_average(F.col("percentile_rank")), 2))
    )


def heatmap_for(matrix: DataFrame, energy_type: str, scenario: str) -> DataFrame:
    """One heatmap: postcode rows x label columns for one energy type and scenario."""
    return (matrix.where((F.col("energy_type") == energy_type) & (F.col("scenario") == scenario))
            .drop("energy_type", "scenario"))
