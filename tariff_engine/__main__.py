"""Command line: build every mart and export in one run.

    spark-submit -m tariff_engine --tables /data/sf100 --out /shared/tariffs \\
        --vars '{"electricity_margin_ct_per_kwh": 2.0}'
    python -m tariff_engine --local --bands bands.csv --products products.csv --quotes quotes.parquet --out out/

``--vars`` overrides any ``PricingParams`` field, like a per-run variable override.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from tariff_engine.params import PricingParams
from tariff_engine.plans.marts import build_marts
from tariff_engine.session import ENGINE_DEFAULTS
from tariff_engine.sources import PricingInputs, load_inputs, read_cost_bands, read_products, read_quotes


def _session(local: bool) -> SparkSession:
    builder = SparkSession.builder.appName("tariff_engine")
    if local:
        builder = builder.master("local[*]").config("spark.ui.enabled", "false")
    spark = builder.getOrCreate()
    for key, value in ENGINE_DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tariff_engine", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--tables", help="folder with customer/lineitem parquet (benchmark mapping)")
    src.add_argument("--bands", help="cost bands file (CSV with header, or parquet)")
    ap.add_argument("--products", help="product catalogue file (with --bands)")
    ap.add_argument("--quotes", help="competitor quotes file (with --bands)")
    ap.add_argument("--out", required=True, help="shared output folder for marts and exports")
    ap.add_argument("--vars", default="{}", help="JSON object of parameter overrides")
    ap.add_argument("--views", metavar="PREFIX", help="let the catalog views PREFIX + mart name read the new marts")
    ap.add_argument("--no-csv", action="store_true", help="write the parquet marts only")
    ap.add_argument("--csv-mode", default="FAILFAST", choices=["FAILFAST", "PERMISSIVE"],
                    help="what malformed CSV numbers do: fail the run, or become NULL and reach the quality report")
    ap.add_argument("--local", action="store_true", help="run on local[*] instead of the submitted master")
    args = ap.parse_args(argv)

    params = PricingParams.from_vars(json.loads(args.vars))
    spark = _session(args.local)
    if args.tables:
        inputs = load_inputs(spark, args.tables)
    else:
        if not (args.products and args.quotes):
            ap.error("--bands needs --products and --quotes")
        inputs = PricingInputs(*(read(spark, path, mode=args.csv_mode) for read, path in (
            (read_cost_bands, args.bands), (read_products, args.products), (read_quotes, args.quotes))))
    paths = build_marts(spark, inputs, args.out, params, export_csv=not args.no_csv, view_prefix=args.views)
    print(json.dumps(paths, indent=2))
    return 0


if __name__ == "__main__":
    sys.exit(main())
