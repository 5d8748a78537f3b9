"""Building every mart: marts written as tables, CSV exports read back with their schemas."""

import glob
import os
import tempfile

import pytest

from tariff_engine.plans.marts import build_marts
from tariff_engine.sources.driver_tables import load_inputs
from tariff_engine.sources.files import read_market_analysis

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables not present")
def test_build_marts_writes_marts_and_exports(spark):
    out = tempfile.mkdtemp(prefix="tariff-marts-")
    paths = build_marts(spark, load_inputs(spark, SF_DIR), out)
    analysis = spark.read.parquet(paths["market_analysis"])
    assert analysis.count() == 5400
    assert spark.read.parquet(paths["price_list"]).count() == 1800
    assert spark.read.parquet(paths["performance_summary"]).count() == 36
    report = spark.read.parquet(paths["quality_report"])
    failing = {(r.model, r.test) for r in report.where("failing_rows > 0").collect()}
    # Quotes repeat the same provider/product/level/contract at other prices in the fixture tables.
    assert failing <= {("quotes", "unique_combination"), ("quotes", "not_null")}

    exported = read_market_analysis(spark, paths["exports/market_analysis_scenarios"])
    assert exported.count() == 5400
    assert exported.where("length(postcode) = 5").count() == 5400
    header = open(sorted(glob.glob(os.path.join(paths["exports/price_lists"], "part-*.csv")))[0]).readline()
    assert header.strip().split(",")[:3] == ["energy_type", "product_name", "postcode"]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables not present")
def test_register_views_supports_sql(spark):
    from tariff_engine.plans.model import PricingModel, register_views

    names = register_views(spark, PricingModel.from_tables(spark, SF_DIR), prefix="t_")
    assert "t_price_list" in names
    got = spark.sql("SELECT energy_type, COUNT(*) AS n FROM t_price_list GROUP BY energy_type ORDER BY 1").collect()
    assert [(r.energy_type, r.n) for r in got] == [("ELECTRICITY", 1200), ("GAS", 600)]
    assert {"t_performance_summary", "t_consumption_levels", "t_margin_scenarios"} <= set(names)
    assert spark.sql("SELECT * FROM t_margin_scenarios").count() == 3
