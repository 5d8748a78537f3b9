"""Query catalog: one entry per operator family, each with its DuckDB oracle.

Every query reads the benchmark tables (customer, lineitem) through
the full model, so its work grows with them. Keys name the operator the
query isolates; ``oracle_sql(name)`` is the matching independent SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariff_engine import oracle
from tariff_engine.functions.pricing import break_even_kwh
from tariff_engine.functions.text import contract_months, norm_postcode
from tariff_engine.operators.band_join import band_join, expand_levels
from tariff_engine.params import DEFAULT_PARAMS, GAS, PricingParams
from tariff_engine.plans import market, through_files
from tariff_engine.plans import quality_suite as QS
from tariff_engine.plans.model import PricingModel
from tariff_engine.plans.price_list import price_list_export
from tariff_engine.plans.summary import heatmap_for

# Parameter sets used by the catalog (besides the defaults).
OVERRIDE_PARAMS = DEFAULT_PARAMS.replace(
    electricity_margin_ct_per_kwh=2.0,
    gas_standing_charge_margin_eur_per_year=7.5,
    consumption_level_low_kwh=800,
    gas_consumption_level_high_kwh=25000,
    gas_signup_bonus_eur=50.0,
)
NEGATIVE_MARGIN_PARAMS = DEFAULT_PARAMS.replace(
    electricity_margin_aggressive_ct_per_kwh=-1.0,
    gas_margin_aggressive_ct_per_kwh=-0.3,
)

COMPONENT_KEY = ["scenario", "product_code", "postcode", "consumption_from", "consumption_level_kwh"]
PRICE_LIST_KEY = ["energy_type", "product_name", "postcode", "consumption_level_kwh"]
OWN_KEY = ["scenario", "energy_type", "product", "postcode", "consumption_level_kwh", "contract_length_months"]


@dataclass(frozen=True)
class CatalogQuery:
    name: str
    build: Callable[[PricingModel], DataFrame]
    sql: str | None
    params: PricingParams = DEFAULT_PARAMS
    dirty: bool = False
    #: A second set of parameters for whose model `sql_too` is added to the rows.
    params_too: PricingParams | None = None
    sql_too: str = ""

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(PricingModel.from_tables(spark, sf_dir, self.params, self.dirty))

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        first = oracle.with_model(self.sql, self.params, self.dirty)
        if self.params_too is None:
            return first
        return f"SELECT * FROM ({first}) UNION ALL SELECT * FROM ({oracle.with_model(self.sql_too, self.params_too, self.dirty)})"


def _cols(cols):
    return ", ".join(cols)


def _components_cols(*cols):
    def build(m: PricingModel) -> DataFrame:
        return m.components.select(*COMPONENT_KEY, *cols)
    return build, f"SELECT {_cols(COMPONENT_KEY + list(cols))} FROM components"


def _contract_months(m: PricingModel) -> DataFrame:
    raw = m.inputs.quotes
    return (raw.groupBy(F.col("contract_length_months").alias("contract_text"))
            .agg(F.count(F.lit(1)).alias("n_quotes"))
            .withColumn("contract_length_months", contract_months(F.col("contract_text"), m.params)))


def _postcode_norm(m: PricingModel) -> DataFrame:
    raw = m.inputs.cost_bands
    return (raw.groupBy(F.col("postcode").alias("raw_postcode")).agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumn("postcode", norm_postcode(F.col("raw_postcode"), m.params.postcode_width)))


def _product_band_join(m: PricingModel) -> DataFrame:
    return m.cost_bands.join(m.products.select("energy_type", "product_code", "product_name"), "energy_type")


def _scenario_fanout(m: PricingModel) -> DataFrame:
    return m.components.select("scenario", "elec_margin_ct", "gas_margin_ct", "product_code", "postcode",
                               "consumption_from", "consumption_level_kwh")


def _band_join_levels(m: PricingModel) -> DataFrame:
    return expand_levels(m.cost_bands, m.params)


def _band_join_quotes(m: PricingModel) -> DataFrame:
    """The general band join: every quoted level falls into the cost bands of its postcode."""
    points = m.quotes.select("energy_type", "postcode", F.col("consumption_level_kwh").alias("quoted_level_kwh")).distinct()
    bands = m.cost_bands.select("energy_type", "postcode", "consumption_from", "consumption_to",
                                "basecost_net_unit_rate_eur_per_kwh")
    return band_join(points, bands, ["energy_type", "postcode"], "quoted_level_kwh", "consumption_from", "consumption_to")


def _ranked(m: PricingModel) -> DataFrame:
    return market.ranked_own_offers(m.components, m.market_quotes, m.points, m.params)


def _offer_rank(m: PricingModel) -> DataFrame:
    return _ranked(m).select(*OWN_KEY, "annual_cost_after_bonus_eur", F.col("offer_rank").alias("our_rank"),
                             F.col("offers_in_segment").alias("total_offers"))


def _rank_metrics(m: PricingModel) -> DataFrame:
    return market.with_rank_metrics(_ranked(m), m.params).select(
        *OWN_KEY, F.col("offer_rank").alias("our_rank"), "cheaper_offers_count", "percentile_rank", "is_cheapest",
        "is_top_3")


def _market_context(m: PricingModel) -> DataFrame:
    return market.with_market_context(_ranked(m)).select(
        *OWN_KEY, "avg_competitor_unit_rate_ct", "avg_competitor_annual_cost_eur", "min_competitor_annual_cost_eur",
        "delta_vs_cheapest_competitor_eur")


def _delta_vs_baseline(m: PricingModel) -> DataFrame:
    return market.with_delta_vs_baseline(_ranked(m), m.params).select(
        *OWN_KEY, F.col("offer_rank").alias("our_rank"), "delta_rank_vs_standard")


def _quote_annual_cost(m: PricingModel) -> DataFrame:
    return market.competitors_at_levels(m.market_quotes, m.points).select(*QUOTE_COST_COLUMNS)


def _stored_quote_costs(m: PricingModel) -> DataFrame:
    return through_files.stored_quote_costs(m).select(*QUOTE_COST_COLUMNS)


def _standard_offers(m: PricingModel) -> DataFrame:
    return market.own_offers(m.components, m.params, m.params.baseline_scenario)


def _one_heatmap(m: PricingModel) -> DataFrame:
    return heatmap_for(m.heatmap_matrix(), GAS, m.params.baseline_scenario)


def _break_even(m: PricingModel) -> DataFrame:
    """Every two own products of a postcode and level: the consumption at which they cost the same."""
    offer = lambda side: m.components.select(
        *BREAK_EVEN_KEY, F.col("product_code").alias(f"product_{side}"),
        (F.col("gross_standing_charge_eur_per_month") * F.lit(12.0)).alias(f"standing_{side}"),
        F.col("signup_bonus_eur").alias(f"bonus_{side}"), (F.col("gross_unit_rate_eur_per_kwh") * F.lit(100.0)).alias(f"rate_{side}"))
    pairs = offer("a").join(offer("b"), BREAK_EVEN_KEY).where("product_a < product_b")
    even = break_even_kwh(*[F.col(f"{c}_{side}") for side in "ab" for c in ("standing", "bonus", "rate")])
    return pairs.select(*BREAK_EVEN_KEY, "product_a", "product_b", even.alias("break_even_kwh"))


def _dq_margin_floor(m: PricingModel) -> DataFrame:
    """The report over two sets of components: the default margins, and margins below cost."""
    negative = PricingModel(m.inputs, NEGATIVE_MARGIN_PARAMS)
    return QS.margin_floor_report({
        "price_components": m.components, "price_components.negative_margin": negative.components})


def _all_offers(m: PricingModel) -> DataFrame:
    return market.all_offers(m.components, m.market_quotes, m.points, m.params)


BREAK_EVEN_KEY = ["scenario", "energy_type", "postcode", "consumption_level_kwh", "consumption_label"]
QUOTE_COST_COLUMNS = [
    "energy_type", "postcode", "consumption_level_kwh", "consumption_label", "contract_length_months", "provider",
    "product_name", "location_name", "quoted_level_kwh", "unit_rate_ct_per_kwh", "standing_charge_eur_per_year",
    "standing_charge_eur_per_month", "signup_bonus_eur", "price_guarantee_months", "annual_cost_after_bonus_eur",
]
OWN_RANK_SQL = f"SELECT {_cols(OWN_KEY)}, our_annual_cost_after_bonus_eur AS annual_cost_after_bonus_eur, " \
               "our_rank, total_offers FROM market_analysis"


def _not_null_sql() -> str:
    frames = {
        "cost_bands": "bands", "products": "products", "quotes": "quotes", "consumption_levels": "levels",
        "margin_scenarios": "scenarios", "price_components": "components", "price_list": "price_list",
        "performance_summary": "performance_summary", "market_analysis": "market_analysis",
    }
    parts = []
    for model, cols in QS.NOT_NULL.items():
        for c in cols:
            parts.append(f"SELECT '{model}' AS model, 'not_null' AS test, '{c}' AS column_name, "
                         f"COUNT(*) FILTER (WHERE {c} IS NULL) AS failing_rows FROM {frames[model]}")
    return "\nUNION ALL\n".join(parts)


def _sql_frames() -> dict[str, str]:
    dims = ", ".join(QS.PRODUCT_DIMENSION)
    return {
        "cost_bands": "bands", "products": "products", "quotes": "quotes", "consumption_levels": "levels",
        "margin_scenarios": "scenarios", "price_components": "components", "price_list": "price_list",
        "performance_summary": "performance_summary", "market_analysis": "market_analysis",
        "price_components.products": f"(SELECT DISTINCT {dims} FROM components)",
        "price_components.scenarios": "(SELECT DISTINCT scenario, elec_margin_ct, gas_margin_ct FROM components)",
    }


def _unique_sql() -> str:
    f = _sql_frames()
    return "\nUNION ALL\n".join(
        f"SELECT '{m}' AS model, 'unique' AS test, '{c}' AS column_name, COUNT(*) AS failing_rows FROM "
        f"(SELECT {c} FROM {f[m]} WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1)"
        for m, cols in QS.UNIQUE.items() for c in cols)


def _unique_combo_sql() -> str:
    f = _sql_frames()
    return "\nUNION ALL\n".join(
        f"SELECT '{m}' AS model, 'unique_combination' AS test, '{','.join(cols)}' AS column_name, "
        f"COUNT(*) AS failing_rows FROM (SELECT {_cols(cols)} FROM {f[m]} GROUP BY {_cols(cols)} HAVING COUNT(*) > 1)"
        for m, combos in QS.UNIQUE_COMBO.items() for cols in combos)


def _accepted_sql() -> str:
    f = _sql_frames()
    parts = []
    for m, tests in QS.ACCEPTED.items():
        for c, vals in tests:
            listed = ", ".join(f"'{v}'" for v in vals)
            parts.append(f"SELECT '{m}' AS model, 'accepted_values' AS test, '{c}' AS column_name, "
                         f"COUNT(*) AS failing_rows FROM (SELECT {c} FROM {f[m]} WHERE {c} NOT IN ({listed}) "
                         f"GROUP BY {c})")
    return "\nUNION ALL\n".join(parts)


def _margin_floor_sql(model: str) -> str:
    return (f"SELECT '{model}' AS model, 'margin_floor' AS test, "
            "'net_unit_rate_eur_per_kwh,margin_eur_per_kwh' AS column_name, COUNT(*) AS failing_rows "
            "FROM components WHERE net_unit_rate_eur_per_kwh < 0 OR margin_eur_per_kwh < 0")


def _build_catalog() -> dict[str, CatalogQuery]:
    q: dict[str, CatalogQuery] = {}

    def add(name, build, sql, params=DEFAULT_PARAMS, dirty=False, **too):
        q[name] = CatalogQuery(name, build, sql, params, dirty, **too)

    add("cost_band_collapse", lambda m: m.cost_bands, "SELECT * FROM bands")
    add("quote_staging", lambda m: m.quotes, "SELECT * FROM quotes")
    add("contract_months", _contract_months,
        "SELECT contract_length_months AS contract_text, COUNT(*) AS n_quotes, "
        f"{oracle._months('contract_length_months', DEFAULT_PARAMS)} AS contract_length_months "
        "FROM raw_quotes GROUP BY contract_length_months")
    add("postcode_norm", _postcode_norm,
        f"SELECT postcode AS raw_postcode, COUNT(*) AS n_rows, lpad(postcode, {DEFAULT_PARAMS.postcode_width}, '0') "
        "AS postcode FROM raw_bands GROUP BY postcode")
    add("product_band_join", _product_band_join,
        "SELECT b.*, p.product_code, p.product_name FROM bands b JOIN products p ON p.energy_type = b.energy_type")
    add("scenario_cross_join", _scenario_fanout,
        "SELECT scenario, elec_margin_ct, gas_margin_ct, product_code, postcode, consumption_from, "
        "consumption_level_kwh FROM components")
    add("band_join_levels", _band_join_levels,
        "SELECT b.*, l.consumption_level_kwh, l.consumption_label FROM bands b JOIN levels l "
        "ON l.energy_type = b.energy_type AND l.consumption_level_kwh BETWEEN b.consumption_from AND b.consumption_to")
    add("band_join", _band_join_quotes,
        "SELECT q.energy_type, q.postcode, q.quoted_level_kwh, b.consumption_from, b.consumption_to, "
        "b.basecost_net_unit_rate_eur_per_kwh FROM (SELECT DISTINCT energy_type, postcode, consumption_level_kwh AS "
        "quoted_level_kwh FROM quotes) q JOIN bands b USING (energy_type, postcode) "
        "WHERE q.quoted_level_kwh BETWEEN b.consumption_from AND b.consumption_to")
    build, sql = _components_cols("energy_type", "margin_eur_per_kwh", "elec_margin_ct", "gas_margin_ct")
    add("margin_floor", build, sql, NEGATIVE_MARGIN_PARAMS)
    add("unit_rates", *_components_cols("net_unit_rate_eur_per_kwh", "gross_unit_rate_eur_per_kwh"))
    add("standing_charge", *_components_cols("gross_standing_charge_eur_per_month", "target_signup_bonus_eur"))
    add("band_lower_bound", *_components_cols("consumption_to", "pcw_consumption_from"))
    add("capped_bonus", *_components_cols("annual_gross_eur", "annual_gross_at_from_eur", "signup_bonus_eur",
                                          "annual_cost_after_bonus_eur"))
    add("price_components", lambda m: m.components, "SELECT * FROM components")
    add("band_upper_bound", lambda m: m.price_list.select(*PRICE_LIST_KEY, "consumption_from", "consumption_to"),
        f"SELECT {_cols(PRICE_LIST_KEY)}, consumption_from, consumption_to FROM price_list")
    add("annual_margin", lambda m: m.price_list.select(*PRICE_LIST_KEY, "annual_margin_eur"),
        f"SELECT {_cols(PRICE_LIST_KEY)}, annual_margin_eur FROM price_list")
    add("price_list", lambda m: m.price_list, "SELECT * FROM price_list")
    add("price_list_export", lambda m: price_list_export(m.price_list),
        "SELECT energy_type, product_name, postcode, town, consumption_from, consumption_to, "
        "unit_rate_gross_ct_per_kwh, standing_charge_gross_eur_per_month, signup_bonus, contract_length, "
        "price_guarantee FROM price_list ORDER BY energy_type, product_name, postcode, consumption_from")
    add("params_override", lambda m: m.price_list, "SELECT * FROM price_list", OVERRIDE_PARAMS)
    add("segment_points", lambda m: market.segment_points(m.components),
        "SELECT DISTINCT scenario, energy_type, postcode, consumption_level_kwh, contract_length_months, "
        "consumption_label FROM components")
    add("ceiling_match", lambda m: market.ceiling_matches(m.market_quotes, m.points), "SELECT * FROM ceiling")
    add("quote_annual_cost", _quote_annual_cost, f"SELECT {_cols(QUOTE_COST_COLUMNS)} FROM rivals")
    add("all_offers", _all_offers, "SELECT * FROM offers")
    add("offer_rank", _offer_rank, OWN_RANK_SQL)
    add("rank_metrics", _rank_metrics,
        f"SELECT {_cols(OWN_KEY)}, our_rank, cheaper_offers_count, percentile_rank, is_cheapest, is_top_3 "
        "FROM market_analysis")
    add("market_context", _market_context,
        f"SELECT {_cols(OWN_KEY)}, avg_competitor_unit_rate_ct, avg_competitor_annual_cost_eur, "
        "min_competitor_annual_cost_eur, delta_vs_cheapest_competitor_eur FROM market_analysis")
    add("delta_vs_baseline", _delta_vs_baseline,
        f"SELECT {_cols(OWN_KEY)}, our_rank, delta_rank_vs_standard FROM market_analysis")
    add("market_analysis", lambda m: m.market_analysis, "SELECT * FROM market_analysis")
    add("performance_summary", lambda m: m.performance_summary(), "SELECT * FROM performance_summary")
    add("heatmap_matrix", lambda m: m.heatmap_matrix(),
        "SELECT energy_type, scenario, postcode, "
        + ", ".join("ROUND(" + oracle._mean(f"CASE consumption_label WHEN '{lab}' THEN percentile_rank END") + f", 2) AS \"{lab}\""
                    for lab in ("low", "medium", "high", "max"))
        + " FROM market_analysis WHERE percentile_rank IS NOT NULL GROUP BY energy_type, scenario, postcode")
    add("dq_not_null", lambda m: QS.not_null_report(QS.model_frames(m)), _not_null_sql(), dirty=True)
    add("dq_unique", lambda m: QS.unique_report(QS.model_frames(m)), _unique_sql(), dirty=True)
    add("dq_unique_combo", lambda m: QS.unique_combo_report(QS.model_frames(m)), _unique_combo_sql(), dirty=True)
    add("dq_accepted_values", lambda m: QS.accepted_values_report(QS.model_frames(m)), _accepted_sql(), dirty=True)
    add("dq_margin_floor", _dq_margin_floor, _margin_floor_sql("price_components"), dirty=True,
        params_too=NEGATIVE_MARGIN_PARAMS, sql_too=_margin_floor_sql("price_components.negative_margin"))
    add("dq_write_pass", through_files.write_pass_quality,
        f"SELECT * FROM ({_not_null_sql()}) UNION ALL SELECT * FROM ({_accepted_sql()})", dirty=True)
    add("standard_offers", _standard_offers,
        f"SELECT {_cols(market.OFFER_COLUMNS)} FROM offers WHERE is_own AND scenario = '{DEFAULT_PARAMS.baseline_scenario}'")
    add("one_heatmap", _one_heatmap,
        f"SELECT * EXCLUDE (energy_type, scenario) FROM ({q['heatmap_matrix'].sql}) "
        f"WHERE energy_type = '{GAS}' AND scenario = '{DEFAULT_PARAMS.baseline_scenario}'")
    add("break_even", _break_even,
        f"SELECT {_cols(f'a.{c}' for c in BREAK_EVEN_KEY)}, a.product_code AS product_a, b.product_code AS product_b, "
        "(a.gross_standing_charge_eur_per_month * 12 - b.gross_standing_charge_eur_per_month * 12 + b.signup_bonus_eur "
        "- a.signup_bonus_eur) / NULLIF((b.gross_unit_rate_eur_per_kwh * 100 - a.gross_unit_rate_eur_per_kwh * 100) / 100, 0) "
        f"AS break_even_kwh FROM components a JOIN components b USING ({_cols(BREAK_EVEN_KEY)}) WHERE a.product_code < b.product_code")
    add("market_by_sql", through_files.market_by_sql, through_files.MARKET_BY_SQL)
    add("analysis_from_csv", through_files.analysis_from_csv, "SELECT * FROM market_analysis")
    add("quote_quarantine", through_files.quarantine_counts, through_files.QUARANTINE_SQL)
    add("stored_quote_costs", _stored_quote_costs, f"SELECT {_cols(QUOTE_COST_COLUMNS)} FROM rivals")
    add("price_list_file", through_files.price_list_file, q["price_list_export"].sql)
    add("analysis_file", through_files.analysis_file, "SELECT * FROM market_analysis")
    add("summary_file", through_files.summary_file, "SELECT * FROM performance_summary")
    add("summary_from_views", through_files.summary_from_views, "SELECT * FROM performance_summary")
    return q


CATALOG = _build_catalog()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: cq.run for name, cq in CATALOG.items()}


def oracle_sql() -> dict[str, str]:
    return {name: cq.oracle() for name, cq in CATALOG.items() if cq.sql is not None}
