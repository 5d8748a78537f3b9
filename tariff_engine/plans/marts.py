"""Run the whole model: staging -> components -> marts -> exports -> data-quality report.

Every run writes to a folder of its own: the staged inputs and the components first, then the marts, each read
back by the steps after it, so that lineage starts at files in the shared output folder (nothing is kept on one machine,
and a lost executor only costs the tasks of the current stage). The not-null and accepted-values checks
are metrics of these writes. When all is written, the marts' views are switched to the new folder; a run that
fails leaves them where they were.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tariff_engine import sinks
from tariff_engine.operators.quality import WriteChecks
from tariff_engine.params import DEFAULT_PARAMS, PricingParams
from tariff_engine.plans import quality_suite as QS
from tariff_engine.plans.market import ANALYSIS_ORDER
from tariff_engine.plans.model import PricingModel
from tariff_engine.plans.price_list import PRICE_LIST_ORDER
from tariff_engine.plans.summary import HEATMAP_KEYS, SUMMARY_ORDER
from tariff_engine.sources.driver_tables import PricingInputs

MARTS = ["price_list", "market_analysis", "performance_summary", "heatmap_matrix", "quality_report"]


def build_marts(spark: SparkSession, inputs: PricingInputs, out_dir: str, params: PricingParams = DEFAULT_PARAMS,
                export_csv: bool = True, view_prefix: str | None = None) -> dict[str, str]:
    """Build every mart in a new version under ``out_dir`` (a shared, cluster-visible path) and return their paths.

    With a ``view_prefix`` (which may be empty), the views of the marts, named so, then read the new version.
    """
    root = sinks.new_version(out_dir)
    checks = WriteChecks(QS.NOT_NULL, QS.ACCEPTED)
    path: dict[str, str] = {}

    def write(name: str, df: DataFrame, order_by: list[str] | None = None) -> DataFrame:
        path[name] = sinks.write_mart(df, f"{root}/{name}", order_by or [], lambda out: checks.watch(out, name))
        return spark.read.schema(df.schema).parquet(path[name])

    raw = PricingModel(inputs, params)
    staged = {name: write(name, getattr(raw, name)) for name in ("cost_bands", "products", "quotes")}
    model = PricingModel(inputs, params, staged)

    price_list = write("price_list", model.price_list, PRICE_LIST_ORDER)
    analysis = write("market_analysis", model.market_analysis, ANALYSIS_ORDER)
    summary = write("performance_summary", model.performance_summary(analysis), SUMMARY_ORDER)
    write("heatmap_matrix", model.heatmap_matrix(analysis), HEATMAP_KEYS)
    components = write("price_components", model.components)

    frames = QS.model_frames(model, components, analysis)
    frames |= {"price_list": price_list, "performance_summary": summary}
    report: DataFrame = reduce(DataFrame.unionByName, [
        QS.write_pass_report(spark, checks, frames), QS.unique_report(frames), QS.unique_combo_report(frames),
        QS.margin_floor_report({"price_components": components}),
    ])
    write("quality_report", report)

    if export_csv:
        path["exports/price_lists"] = sinks.export_price_list(price_list, f"{root}/exports/price_lists")
        path["exports/market_analysis_scenarios"] = sinks.export_market_analysis(
            analysis, f"{root}/exports/market_analysis_scenarios")
        path["exports/market_performance_summary"] = sinks.export_summary(
            summary, f"{root}/exports/market_performance_summary")

    if view_prefix is not None:
        sinks.publish(spark, {view_prefix + name: path[name] for name in MARTS})
    return path
