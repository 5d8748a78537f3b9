"""Golden cases: published price-list rows and summary averages of the modelled application.

Inputs are a handful of the application's own cost bands and the numeric
values of its two products (names and towns replaced by our own labels).
"""

import pytest

from tariff_engine.operators.staging import stage_cost_bands, stage_products, stage_quotes
from tariff_engine.params import PricingParams
from tariff_engine.plans.components import price_components_with_bands
from tariff_engine.plans.market import POINT, market_analysis
from tariff_engine.plans.price_list import price_list
from tariff_engine.plans.summary import performance_summary
from tariff_engine.schemas import RAW_COST_BANDS, RAW_PRODUCTS, RAW_QUOTES

# Electricity cost bands (postcode, net rate EUR/kWh, net standing EUR/year), all 100-20000 kWh.
ELECTRICITY_BANDS = [
    ("10405", 0.1485, 43.31), ("26676", 0.0952, 108.44), ("37586", 0.118, 113.29), ("38106", 0.1274, 69.02),
    ("46325", 0.1571, 94.71), ("47574", 0.165, 88.87), ("57413", 0.1546, 88.44), ("71691", 0.1389, 94.67),
    ("81671", 0.1386, 73.27), ("86470", 0.1041, 84.36),
]
# Gas bands of one postcode (from, to, rate, standing).
GAS_BANDS_10405 = [(200, 1000, 0.0429, 31.39), (1001, 6000, 0.0348, 39.49), (6001, 25000, 0.0342, 43.07),
                   (25001, 50000, 0.0325, 85.31)]
# Product figures (lifetime years, lead cost, VAT, procurement ct/kWh, guarantee, contract).
PRODUCTS = [
    ("G12", "Gas Twelve", "GAS", 3.03, 75.0, 0.19, 3.788, 12, 12),
    ("E12", "Power Twelve", "ELECTRICITY", 3.21, 55.0, 0.19, 10.084, 12, 12),
]


def _narrow_gas_bands():
    """A postcode whose gas bands come as many narrow rows at three rates."""
    edges = [(200, 999)] + [(lo, lo + 999) for lo in range(1000, 26000, 1000)]
    edges += [(lo, lo + 1999) for lo in range(26000, 50000, 2000)] + [(50000, 50000)]

    def rate(lo):
        return 0.046 if lo < 10000 else (0.0459 if lo < 44000 else 0.0458)
    return [("GAS", "71691", "T", lo, hi, rate(lo), 30.9) for lo, hi in edges]


@pytest.fixture(scope="module")
def model(spark):
    raw = [("ELECTRICITY", pc, "T", 100, 20000, r, s) for pc, r, s in ELECTRICITY_BANDS]
    raw += [("GAS", "10405", "T", lo, hi, r, s) for lo, hi, r, s in GAS_BANDS_10405]
    raw += _narrow_gas_bands()
    bands = stage_cost_bands(spark.createDataFrame(raw, RAW_COST_BANDS))
    products = stage_products(spark.createDataFrame(PRODUCTS, RAW_PRODUCTS))
    comps = price_components_with_bands(bands, products, PricingParams()).cache()
    return comps


def _price_rows(spark, comps, energy, postcode):
    pl = price_list(comps).where(f"energy_type = '{energy}' AND postcode = '{postcode}'")
    return [tuple(r) for r in pl.select("consumption_from", "consumption_to", "unit_rate_gross_ct_per_kwh",
                                        "standing_charge_gross_eur_per_month", "signup_bonus")
            .orderBy("consumption_from").collect()]


def test_electricity_price_list(spark, model):
    assert _price_rows(spark, model, "ELECTRICITY", "10405") == [
        (100, 1999, 31.4565, 5.29, 14.23), (2000, 4499, 31.4565, 5.29, 100.0),
        (4500, 11999, 31.4565, 5.29, 100.0), (12000, 20000, 31.4565, 5.29, 100.0)]
    assert _price_rows(spark, model, "ELECTRICITY", "26676") == [
        (100, 1999, 25.1138, 11.75, 24.91), (2000, 4499, 25.1138, 11.75, 96.48),
        (4500, 11999, 25.1138, 11.75, 100.0), (12000, 20000, 25.1138, 11.75, 100.0)]


def test_gas_price_list_band_edges(spark, model):
    got = _price_rows(spark, model, "GAS", "10405")
    assert got[0] == (1001, 11999, 9.2439, 4.41, 21.82)
    assert [r[:2] for r in got] == [(1001, 11999), (12000, 21999), (22000, 39999), (40000, 50000)]
    # Collapsed narrow bands: the top tier ends where the last band holding a level ends.
    assert _price_rows(spark, model, "GAS", "71691")[-1][:2] == (40000, 43999)


def test_price_list_invariants(spark, model):
    pl = price_list(model).collect()
    for r in pl:
        assert r.signup_bonus <= round(r.annual_gross_at_from_eur * 0.15, 2) + 0.01
        assert r.margin_ct_per_kwh >= 0
    by_key = {}
    for r in pl:
        by_key.setdefault((r.energy_type, r.postcode), []).append((r.consumption_from, r.consumption_to))
    for spans in by_key.values():
        spans.sort()
        for (_, hi), (lo, _) in zip(spans, spans[1:]):
            assert hi + 1 == lo


def test_summary_own_costs_without_quotes(spark, model):
    quotes = stage_quotes(spark.createDataFrame([], RAW_QUOTES))
    comps = model.drop("pcw_consumption_to")
    summary = performance_summary(market_analysis(comps, quotes, comps.select(*POINT).distinct())).where("energy_type = 'ELECTRICITY'")
    got = {(r.scenario, r.consumption_level_kwh): (r.avg_our_annual_cost_eur, r.total_market_segments,
                                                   r.pct_cheapest, r.avg_rank, r.avg_percentile)
           for r in summary.collect()}
    expected_costs = {
        ("aggressive", 1000): 382.45, ("conservative", 1000): 402.38, ("standard", 1000): 390.66,
        ("aggressive", 2000): 595.24, ("conservative", 2000): 634.33, ("standard", 2000): 611.24,
        ("aggressive", 4500): 1318.42, ("conservative", 4500): 1409.45, ("standard", 4500): 1355.9,
        ("aggressive", 12000): 3492.37, ("conservative", 12000): 3735.13, ("standard", 12000): 3592.33,
    }
    assert {k: v[0] for k, v in got.items()} == expected_costs
    # No competitor anywhere: every segment is the own offer alone.
    assert {v[1:] for v in got.values()} == {(10, 100.0, 1.0, None)}
