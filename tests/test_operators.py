"""Operators on small in-memory frames: band collapse, band join, ceiling match, ranking, quality."""

import random

import pandas as pd
from pyspark.sql import functions as F

from frames import rows
from tariff_engine.operators import quality as Q
from tariff_engine.operators.band_join import band_join, expand_levels
from tariff_engine.operators.ceiling_match import ceiling_levels, ceiling_match
from tariff_engine.operators.ranking import rank_own_offers
from tariff_engine.operators.staging import stage_cost_bands, stage_quotes
from tariff_engine.params import PricingParams
from tariff_engine.schemas import RAW_COST_BANDS, RAW_QUOTES


def _bands(spark, data):
    return spark.createDataFrame(data, RAW_COST_BANDS)


def test_band_collapse_keeps_returning_rate(spark):
    raw = _bands(spark, [
        ("GAS", "1067", "T", 0, 9, 0.05, 30.0),
        ("GAS", "1067", "T", 10, 19, 0.04, 30.0),
        ("GAS", "1067", "T", 20, 29, 0.05, 30.0),
    ])
    got = rows(stage_cost_bands(raw).select("postcode", "consumption_from", "consumption_to",
                                           "basecost_net_unit_rate_eur_per_kwh"))
    assert got == [("01067", 0, 29, 0.05), ("01067", 10, 19, 0.04)]


def test_band_collapse_many_narrow_bands(spark):
    data = [("GAS", "71691", "T", lo, lo + 999, 0.046, 30.9) for lo in range(1000, 10000, 1000)]
    data += [("GAS", "71691", "T", 200, 999, 0.046, 30.9), ("GAS", "71691", "T", 10000, 43999, 0.0459, 30.9)]
    got = rows(stage_cost_bands(_bands(spark, data)).select("consumption_from", "consumption_to"))
    assert got == [(200, 9999), (10000, 43999)]


def test_band_join_gap_and_edges(spark):
    bands = spark.createDataFrame([("E", 100, 999, "b1"), ("E", 1100, 2000, "b2")], "k string, lo int, hi int, band string")
    points = spark.createDataFrame([("E", 1050), ("E", 999), ("E", 1100), ("X", 1100)], "k string, level int")
    got = rows(band_join(points, bands, ["k"], "level", "lo", "hi").select("level", "band"))
    assert got == [(999, "b1"), (1100, "b2")]


def test_expand_levels_matches_band_join(spark):
    params = PricingParams()
    bands = stage_cost_bands(_bands(spark, [
        ("ELECTRICITY", "30159", "T", 100, 1999, 0.14, 40.0),
        ("ELECTRICITY", "30159", "T", 2001, 20000, 0.13, 40.0),
        ("GAS", "30159", "T", 200, 1000, 0.04, 30.0),
        ("GAS", "30159", "T", 1001, 6000, 0.03, 35.0),
        ("HEAT", "30159", "T", 0, 99999, 0.01, 1.0),
    ]))
    levels = spark.createDataFrame(params.levels(), "energy_type string, consumption_level_kwh int, consumption_label string")
    joined = band_join(levels, bands, ["energy_type"], "consumption_level_kwh", "consumption_from", "consumption_to")
    cols = ["energy_type", "consumption_level_kwh", "consumption_label", "consumption_from"]
    assert rows(expand_levels(bands, params).select(*cols)) == rows(joined.select(*cols))
    # 2000 kWh sits in the gap between the electricity bands: dropped.
    assert 2000 not in [r[1] for r in rows(joined.select(*cols)) if r[0] == "ELECTRICITY"]


def _quotes(spark, data):
    return spark.createDataFrame(data, "k string, provider string, product string, q int, bonus double")


def test_ceiling_match_levels(spark):
    quotes = _quotes(spark, [("A", "p", "t", 2000, 1.0), ("A", "p", "t", 4500, 2.0)])
    points = spark.createDataFrame([("A", lv) for lv in (1000, 2000, 3000, 5000)], "k string, level int")
    got = rows(ceiling_levels(quotes, points, ["k"], ["provider", "product"], "q", "level")
               .select("level", "matched_consumption_level_kwh"))
    assert got == [(1000, 2000), (2000, 2000), (3000, 4500)]


def test_ceiling_match_keeps_ties_and_drops_null_keys(spark):
    quotes = _quotes(spark, [
        ("A", "p", "t", 2000, 1.0), ("A", "p", "t", 2000, 5.0), ("A", "p", "t", 3000, 9.0),
        ("A", None, "t", 1000, 0.0), ("A", "p", "t", None, 0.0),
    ])
    points = spark.createDataFrame([("A", 1500)], "k string, level int")
    got = rows(ceiling_match(quotes, points, ["k"], ["provider", "product"], "q", "level").select("q", "bonus"))
    assert got == [(2000, 1.0), (2000, 5.0)]


def _brute_force_ranks(own: pd.DataFrame, comp: pd.DataFrame) -> pd.DataFrame:
    """RANK() with NULLs last over own offers of a scenario plus all competitors of the segment."""
    out = []
    for scen in own.scenario.unique():
        c = comp.assign(scenario=scen, is_own=False, product=None)
        allo = pd.concat([own[own.scenario == scen].assign(is_own=True), c], ignore_index=True)
        allo["rank"] = allo.groupby("seg")["cost"].rank(method="min", na_option="bottom").astype("int64")
        allo["n"] = allo.groupby("seg")["cost"].transform("size")
        out.append(allo[allo.is_own])
    return pd.concat(out)[["scenario", "seg", "product", "rank", "n"]]


def test_rank_own_offers_matches_window_rank(spark):
    rnd = random.Random(3)
    own, comp = [], []
    for seg in range(40):
        for scen in ("s1", "s2"):
            for prod in ("a", "b"):
                cost = None if rnd.random() < 0.05 else float(rnd.randint(90, 110))
                own.append((scen, seg, "L", prod, cost))
        for _ in range(rnd.randint(0, 12)):
            cost = None if rnd.random() < 0.1 else float(rnd.randint(85, 115))
            comp.append((seg, "L", cost, float(rnd.randint(20, 30))))
    own_df = spark.createDataFrame(own, "scenario string, seg int, label string, product string, cost double")
    comp_df = spark.createDataFrame(comp, "seg int, label string, cost double, rate double")
    ranked = rank_own_offers(own_df, comp_df, ["seg"], "scenario", "cost", "rate")
    got = sorted(tuple(r) for r in ranked.select("scenario", "seg", "product", "offer_rank", "offers_in_segment").collect())
    exp = _brute_force_ranks(pd.DataFrame(own, columns=["scenario", "seg", "label", "product", "cost"]),
                             pd.DataFrame(comp, columns=["seg", "label", "cost", "rate"]))
    expected = sorted((r.scenario, int(r.seg), r.product, int(r.rank), int(r.n)) for r in exp.itertuples())
    assert got == expected


def test_lone_own_offer_profile_is_null(spark):
    own_df = spark.createDataFrame([("s", 1, "L", "a", 100.0)], "scenario string, seg int, label string, product string, cost double")
    comp_df = spark.createDataFrame([], "seg int, cost double, rate double")
    r = rank_own_offers(own_df, comp_df, ["seg"], "scenario", "cost", "rate").collect()[0]
    assert (r.offer_rank, r.offers_in_segment, r.avg_competitor_cost, r.min_competitor_cost) == (1, 1, None, None)


def test_rank_with_a_thousand_products_in_one_segment(spark):
    own = [("s", 1, f"p{k}", float(k)) for k in range(1000)]
    comp = [(1, float(k) + 0.5, 1.0) for k in range(0, 1000, 2) for _ in range(3)]
    ranked = rank_own_offers(
        spark.createDataFrame(own, "scenario string, seg int, product string, cost double"),
        spark.createDataFrame(comp, "seg int, cost double, rate double"), ["seg"], "scenario", "cost", "rate")
    got = {r["product"]: r.offer_rank for r in ranked.collect()}
    assert got == {f"p{k}": 1 + k + 3 * ((k + 1) // 2) for k in range(1000)}


def test_break_even_kwh(spark):
    from tariff_engine.functions import break_even_kwh

    got = spark.range(1).select(
        break_even_kwh(F.lit(100.0), F.lit(20.0), F.lit(30.0), F.lit(60.0), F.lit(10.0), F.lit(35.0)).alias("x")).first().x
    assert got == 600.0  # 100 - 20 + 0.30 x = 60 - 10 + 0.35 x


def test_quote_dedupe_and_contract_parse(spark):
    raw = spark.createDataFrame([
        ("GAS", "1067", "T", 5000, "P", "X", 8.0, 60.0, 10.0, 12, "12 Monate"),
        ("GAS", "01067", "T", 5000, "P", "X", 8.0, 60.0, 10.0, 12, "1 Jahr"),
        ("GAS", "1067", "T", 5000, "P", "X", 8.0, 60.0, 11.0, 12, "12 Monate"),
    ], RAW_QUOTES)
    got = rows(stage_quotes(raw).select("postcode", "signup_bonus_eur", "contract_length_months",
                                         "standing_charge_eur_per_month"))
    assert got == [("01067", 10.0, 12, 5.0), ("01067", 11.0, 12, 5.0)]


def test_quality_checks(spark):
    df = spark.createDataFrame([("a", "GAS", 1), ("a", "WATER", None), (None, "GAS", 2)], "code string, e string, v int")
    nn = {r.column_name: r.failing_rows for r in Q.check_not_null(df, ["code", "e", "v"], "m").collect()}
    assert nn == {"code": 1, "e": 0, "v": 1}
    assert rows(Q.check_unique(df, "code", "m").select("value", "occurrences")) == [("a", 2)]
    assert rows(Q.check_accepted_values(df, "e", ["GAS", "ELECTRICITY"], "m").select("value")) == [("WATER",)]
    assert rows(Q.check_unique_combo(df, ["code", "e"], "m").select("occurrences")) == []
    comps = spark.createDataFrame([("p", "n", "GAS", "1", 1, 2, -0.01, 0.0), ("p", "n", "GAS", "1", 1, 2, 0.05, 0.01)],
                                  ", ".join(f"{c} {t}" for c, t in zip(Q.MARGIN_FLOOR_COLUMNS, [
                                      "string", "string", "string", "string", "int", "int", "double", "double"])))
    assert Q.check_margin_floor(comps).count() == 1
