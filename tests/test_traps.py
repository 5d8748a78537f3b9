"""Semantic traps: repeated product names, duplicated level labels, invariants, and a hot postcode."""

import math
import os
import tempfile

import duckdb
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry_module
from tariff_engine.operators import quality as Q
from tariff_engine.operators.staging import project_quotes, stage_cost_bands, stage_products
from tariff_engine.params import PricingParams
from tariff_engine.plans.components import price_components
from tariff_engine.plans.market import POINT, market_analysis
from tariff_engine.schemas import RAW_COST_BANDS, RAW_PRODUCTS, RAW_QUOTES

SF_DIR = "/root/testdata/sf0.001"


def _model(spark, products, params=PricingParams(), quotes=()):
    bands = stage_cost_bands(spark.createDataFrame(
        [("ELECTRICITY", "30159", "T", 100, 20000, 0.15, 40.0),
         ("ELECTRICITY", "50667", "T", 100, 20000, 0.11, 95.0)], RAW_COST_BANDS))
    comps = price_components(bands, stage_products(spark.createDataFrame(products, RAW_PRODUCTS)), params)
    q = project_quotes(spark.createDataFrame(list(quotes), RAW_QUOTES), params)
    points = comps.select(*POINT).distinct()
    return comps, market_analysis(comps, q, points, params)


def test_repeated_product_name_fans_out_like_a_join(spark):
    products = [("A", "Same", "ELECTRICITY", 3.0, 50.0, 0.19, 10.0, 12, 12),
                ("B", "Same", "ELECTRICITY", 3.0, 60.0, 0.19, 11.0, 12, 12)]
    comps, ma = _model(spark, products)
    # 2 postcodes x 4 levels x 3 scenarios x 2 products, each joined to 2 baseline rows.
    assert ma.count() == 2 * 4 * 3 * 2 * 2
    deltas = {r.delta_rank_vs_standard for r in ma.where("scenario = 'standard'").collect()}
    assert deltas == {-1, 0, 1}
    assert Q.check_unique_combo(ma, ["scenario", "energy_type", "product", "postcode", "consumption_level_kwh",
                                     "contract_length_months"], "m").count() > 0


def test_two_labels_on_one_level_double_the_offers(spark):
    products = [("A", "One", "ELECTRICITY", 3.0, 50.0, 0.19, 10.0, 12, 12)]
    params = PricingParams(consumption_level_medium_kwh=1000)
    quote = ("ELECTRICITY", "30159", "T", 1000, "P", "X", 30.0, 60.0, 10.0, 12, "12 Monate")
    comps, ma = _model(spark, products, params, [quote])
    at_1000 = ma.where("postcode = '30159' AND consumption_level_kwh = 1000 AND scenario = 'standard'").collect()
    # Ranking ignores the label: both own copies and both competitor copies share one segment,
    # and each own copy meets both baseline copies in the baseline join (2 x 2 rows).
    assert len(at_1000) == 4 and {r.total_offers for r in at_1000} == {4}
    assert {r.consumption_label for r in at_1000} == {"low", "medium"}
    levels = spark.createDataFrame(params.levels(), "energy_type string, consumption_level_kwh int, label string")
    assert Q.check_unique_combo(levels, ["energy_type", "consumption_level_kwh"], "levels").count() == 1


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables not present")
def test_market_invariants(spark):
    ma = entry_module.entry(spark)
    assert ma.where("our_rank > total_offers OR our_rank < 1").count() == 0
    costs = {}
    for r in ma.select("scenario", "energy_type", "product", "postcode", "consumption_level_kwh",
                       "our_annual_cost_after_bonus_eur").collect():
        costs.setdefault(r[1:5], {})[r[0]] = r[5]
    for c in costs.values():
        assert c["aggressive"] <= c["standard"] <= c["conservative"]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables not present")
def test_hot_postcode_matches_oracle(spark):
    """Half of all quotes land in one postcode; results still equal the SQL oracle."""
    skew_dir = tempfile.mkdtemp(prefix="tariff-skew-")
    for name in ("customer",):
        pq.write_table(pq.read_table(f"{SF_DIR}/{name}.parquet"), f"{skew_dir}/{name}.parquet")
    li = pq.read_table(f"{SF_DIR}/lineitem.parquet")
    keys = li.column("l_orderkey")
    hot = pc.equal(pc.bit_wise_and(li.column("l_linenumber"), 1), 1)
    li = li.set_column(li.schema.get_field_index("l_orderkey"), "l_orderkey",
                       pc.if_else(hot, pc.cast(5, keys.type), keys))
    pq.write_table(li, f"{skew_dir}/lineitem.parquet")

    con = duckdb.connect()
    for name in ("customer", "lineitem"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{skew_dir}/{name}.parquet')")
    for name in ("market_analysis", "performance_summary"):
        df = entry_module.queries()[name](spark, skew_dir)
        rel = con.sql(entry_module.oracle_sql()[name])
        order = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
        exp = sorted((tuple(r[i] for i in order) for r in rel.fetchall()), key=str)
        s_cols = df.columns
        s_order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        got = sorted((tuple(r[i] for i in s_order) for r in df.collect()), key=str)
        assert len(got) == len(exp)
        assert got == exp, name
    hot_segments = entry_module.queries()["market_analysis"](spark, skew_dir) \
        .where("postcode = '01562'").agg({"total_offers": "max"}).collect()[0][0]
    assert hot_segments is not None and not math.isnan(hot_segments) and hot_segments > 50


def test_bad_csv_numbers_become_null(spark, tmp_path):
    from tariff_engine.sources.files import read_cost_bands

    path = tmp_path / "bands.csv"
    path.write_text("energy_type,postcode,town,consumption_from,consumption_to,"
                    "basecost_net_unit_rate_eur_per_kwh,basecost_net_standing_charge_eur_per_year\n"
                    "GAS,01067,T,2.7,1000,0.04,30.0\nGAS,1067,T,1001,2000,0.03,31.0\n")
    with pytest.raises(Exception):
        read_cost_bands(spark, str(path)).collect()
    loose = read_cost_bands(spark, str(path), mode="PERMISSIVE")
    got = sorted((r.postcode, r.consumption_from) for r in loose.collect())
    assert got == [("01067", None), ("1067", 1001)]
    nn = {r.column_name: r.failing_rows for r in Q.check_not_null(loose, ["consumption_from"], "m").collect()}
    assert nn == {"consumption_from": 1}


def test_heatmap_drops_empty_rows_keeps_label_columns(spark):
    from tariff_engine.plans.summary import heatmap_for, heatmap_matrix

    rows = [("ELECTRICITY", "standard", "00001", "low", 10.0), ("ELECTRICITY", "standard", "00001", "low", 20.0),
            ("ELECTRICITY", "standard", "00001", "max", None), ("ELECTRICITY", "standard", "00002", "max", None)]
    df = spark.createDataFrame(rows, "energy_type string, scenario string, postcode string, consumption_label string, "
                                     "percentile_rank double")
    m = heatmap_for(heatmap_matrix(df), "ELECTRICITY", "standard")
    assert m.columns == ["postcode", "low", "medium", "high", "max"]
    assert [tuple(r) for r in m.collect()] == [("00001", 15.0, None, None, None)]


def test_own_offers_scenario_filter(spark):
    from tariff_engine.plans.market import own_offers

    products = [("A", "One", "ELECTRICITY", 3.0, 50.0, 0.19, 10.0, 12, 12)]
    comps, _ = _model(spark, products)
    assert {r.scenario for r in own_offers(comps, scenario="aggressive").collect()} == {"aggressive"}
