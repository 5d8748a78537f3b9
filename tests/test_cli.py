"""The command line on CSV inputs: marts and exports land in the output folder."""

import json

from tariff_engine.__main__ import main


def test_cli_with_csv_inputs(spark, tmp_path, capsys):
    (tmp_path / "bands.csv").write_text(
        "energy_type,postcode,town,consumption_from,consumption_to,basecost_net_unit_rate_eur_per_kwh,"
        "basecost_net_standing_charge_eur_per_year\n"
        "ELECTRICITY,30159,T,100,20000,0.15,40.0\n"
        "GAS,30159,T,150,1200,0.05,30.0\nGAS,30159,T,1201,7000,0.04,36.0\n"
        "GAS,30159,T,7001,26000,0.035,45.0\nGAS,30159,T,26001,60000,0.03,90.0\n")
    (tmp_path / "products.csv").write_text(
        "product_code,product_name,energy_type,expected_customer_life_time,lead_cost,vat,"
        "net_procurement_cost_ct_per_kwh,price_guarantee_months,contract_length_months\n"
        "G12,Gas Twelve,GAS,2.5,80,0.19,4.0,12,12\nE12,Power Twelve,ELECTRICITY,3.5,50,0.19,9.0,12,12\n")
    (tmp_path / "quotes.csv").write_text(
        "energy_type,postcode,location_name,consumption_level_kwh,provider,product,unit_rate_ct_per_kwh,"
        "standing_charge_eur_per_year,signup_bonus,price_guarantee_months,contract_length_months\n"
        "ELECTRICITY,30159,T,2000,Other,Basic,28.0,120.0,50.0,12,12 Monate\n"
        "ELECTRICITY,30159,T,2000,Other,Basic,28.0,120.0,50.0,12,1 Jahr\n"
        "GAS,30159,T,15000,Other,Heat,9.0,150.0,0.0,12,2 Wochen\n")
    out = tmp_path / "out"
    assert main(["--local", "--bands", str(tmp_path / "bands.csv"), "--products", str(tmp_path / "products.csv"),
                 "--quotes", str(tmp_path / "quotes.csv"), "--out", str(out),
                 "--vars", json.dumps({"electricity_margin_ct_per_kwh": 1.5})]) == 0
    paths = json.loads(capsys.readouterr().out)
    pl = spark.read.parquet(paths["price_list"])
    assert pl.where("energy_type = 'ELECTRICITY' AND consumption_from = 100").first().unit_rate_gross_ct_per_kwh == 30.345
    ma = spark.read.parquet(paths["market_analysis"]).where(
        "energy_type = 'ELECTRICITY' AND consumption_level_kwh IN (1000, 2000) AND scenario = 'standard'")
    # The two quote rows parse to the same 12 months and dedupe to one competitor offer at 1000 and 2000 kWh.
    assert {r.total_offers for r in ma.collect()} == {2}
