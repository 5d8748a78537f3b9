"""Map the benchmark's TPC-H style tables onto the pricing inputs.

* cost bands  <- the postcodes of ``customer``, each with the same bands of both energy types, and for each
  customer one of these bands again (a copy, as regional publications overlap)
* competitor quotes <- one row per ``lineitem``
* products    <- three inline catalogue rows

Every expression is integer arithmetic or an exact double operation, so the
SQL oracle derives bit-identical rows. The work of every derived input grows
with the tables it reads.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariff_engine.params import ELECTRICITY, GAS
from tariff_engine.sources.lookups import products_from_rows

# Fixed values of the table mapping.
POSTCODE_BUCKETS = 997
POSTCODE_BASE = 1067
POSTCODE_STEP = 99
BAND_WIDTH = {ELECTRICITY: 1000, GAS: 2000}
QUOTE_LEVELS_KWH = [1000, 2000, 3500, 4500, 8000]
GAS_LEVEL_FACTOR = 5
PROVIDER_BUCKETS = 40
TARIFF_BUCKETS = 3
CONTRACT_TEXT = ["24 Monate", "2 Jahre", "1 Jahr", "2 Wochen", "3 Wochen", "1 Monat", "12 Monate", "12 Monate"]

# Inline catalogue: code, name, energy, lifetime (y), lead cost, VAT, procurement ct/kWh,
# price guarantee (months), contract length (months).
PRODUCT_ROWS = [
    ("P1", "Volt 12", ELECTRICITY, 3.5, 48.0, 0.19, 10.25, 12, 12),
    ("P2", "Flame 12", GAS, 2.75, 80.0, 0.19, 3.9, 12, 12),
    ("P3", "Volt 24", ELECTRICITY, 2.5, 40.0, 0.19, 9.5, 24, 24),
]

TABLE_COLUMNS = {
    "customer": "c_custkey bigint",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double",
}

# Raw bands that every postcode publishes for each energy type.
BANDS_PER_POSTCODE = 25

# Quotes without a bonus have no annual cost and rank last.
NO_BONUS = "l_orderkey % 211 = 5"

# What the dirty variant of the inputs breaks, as conditions on the tables' keys (quality queries).
DIRTY_TOWN = "k % 10 = 3"
DIRTY_BAND_ENERGY = "k % 10 = 4 AND n = 7"
DIRTY_RATE = "k % 10 = 5"
DIRTY_PROVIDER = "l_orderkey % 50 = 7"
DIRTY_QUOTE_ENERGY = "l_orderkey % 50 = 13"
DIRTY_ENERGY = "WATER"
DIRTY_RATE_EUR_PER_KWH = -0.5
DIRTY_PRODUCT_ROWS = [
    ("P1", "Volt 12 again", ELECTRICITY, 3.5, 48.0, 0.19, 10.25, 12, 12),
    ("P4", "Spring 12", DIRTY_ENERGY, 3.0, 50.0, 0.19, 4.0, 12, 12),
]


@dataclass(frozen=True)
class PricingInputs:
    cost_bands: DataFrame
    products: DataFrame
    quotes: DataFrame


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table's columns that the mapping reads; with their types given, building a query opens no file."""
    return spark.read.schema(TABLE_COLUMNS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _postcode(bucket):
    return (F.lit(POSTCODE_BASE) + bucket * F.lit(POSTCODE_STEP)).cast("string")


def _town(bucket):
    return F.concat(F.lit("Town "), bucket.cast("string"))


def cost_bands_from_customers(customer: DataFrame, dirty: bool = False) -> DataFrame:
    """The raw cost bands of every postcode that has a customer, and a copy of one band for each customer (raw layout).

    Postcodes are made distinct first (map-side, then one small shuffle); their bands come from a literal range. The
    copies are a projection of the customers, so raw bands grow with them.
    """
    postcode = (F.col("c_custkey") % F.lit(POSTCODE_BUCKETS)).alias("k")
    postcodes = customer.select(postcode).distinct()
    energies = F.array(*[
        F.struct(F.lit(name).alias("energy_type"), F.lit(width).alias("width"))
        for name, width in BAND_WIDTH.items()
    ])
    grid = postcodes.select("k", F.explode(F.sequence(F.lit(0), F.lit(BANDS_PER_POSTCODE - 1))).alias("n"))
    copies = customer.select(postcode, F.expr(f"cast(c_custkey div {POSTCODE_BUCKETS} % {BANDS_PER_POSTCODE} as int)").alias("n"))
    grid = grid.unionByName(copies).select("k", "n", F.inline(energies))
    spoil = lambda condition, bad, good: F.when(F.expr(condition), bad).otherwise(good) if dirty else good
    k, n, w = F.col("k"), F.col("n"), F.col("width")
    return grid.select(
        spoil(DIRTY_BAND_ENERGY, F.lit(DIRTY_ENERGY), F.col("energy_type")).alias("energy_type"),
        _postcode(k).alias("postcode"),
        spoil(DIRTY_TOWN, F.lit(None).cast("string"), _town(k)).alias("town"),
        F.when(n == 0, F.lit(100)).otherwise(n * w).alias("consumption_from"),
        (n * w + w - F.lit(1)).alias("consumption_to"),
        spoil(DIRTY_RATE, F.lit(DIRTY_RATE_EUR_PER_KWH),
              (F.lit(1000) + (k % F.lit(50)) * F.lit(10) - F.expr("n div 5") * F.lit(20)).cast("double")
              / F.lit(10000.0)).alias("basecost_net_unit_rate_eur_per_kwh"),
        (F.lit(40) + k % F.lit(50)).cast("double").alias("basecost_net_standing_charge_eur_per_year"),
    )


def quotes_from_lineitem(lineitem: DataFrame, dirty: bool = False) -> DataFrame:
    """One raw competitor quote per line item (raw layout, contract length as text)."""
    elec = (F.col("l_partkey") % F.lit(2)) == F.lit(0)
    bucket = F.col("l_orderkey") % F.lit(POSTCODE_BUCKETS)
    level_idx = (F.floor("l_quantity").cast("int") % F.lit(len(QUOTE_LEVELS_KWH))) + F.lit(1)
    contract_idx = (F.col("l_suppkey") % F.lit(len(CONTRACT_TEXT))).cast("int") + F.lit(1)
    spoil = lambda condition, bad, good: F.when(F.expr(condition), bad).otherwise(good) if dirty else good
    return lineitem.select(
        spoil(DIRTY_QUOTE_ENERGY, F.lit(DIRTY_ENERGY),
              F.when(elec, F.lit(ELECTRICITY)).otherwise(F.lit(GAS))).alias("energy_type"),
        _postcode(bucket).alias("postcode"),
        _town(bucket).alias("location_name"),
        (F.element_at(F.array(*[F.lit(v) for v in QUOTE_LEVELS_KWH]), level_idx)
         * F.when(elec, F.lit(1)).otherwise(F.lit(GAS_LEVEL_FACTOR))).alias("consumption_level_kwh"),
        spoil(DIRTY_PROVIDER, F.lit(None).cast("string"),
              F.concat(F.lit("Provider "), (F.col("l_suppkey") % F.lit(PROVIDER_BUCKETS)).cast("string"))).alias("provider"),
        F.concat(F.lit("Tariff "), (F.col("l_partkey") % F.lit(TARIFF_BUCKETS)).cast("string")).alias("product"),
        (F.when(elec, F.lit(24.0)).otherwise(F.lit(8.0)) + F.col("l_discount") * F.lit(30)
         + (F.col("l_suppkey") % F.lit(7)) * F.lit(0.5)).alias("unit_rate_ct_per_kwh"),
        (F.lit(60) + F.floor("l_extendedprice") % F.lit(120)).cast("double").alias("standing_charge_eur_per_year"),
        F.when(~F.expr(NO_BONUS), F.col("l_tax") * F.lit(1000)).alias("signup_bonus"),
        F.lit(12).alias("price_guarantee_months"),
        F.element_at(F.array(*[F.lit(t) for t in CONTRACT_TEXT]), contract_idx).alias("contract_length_months"),
    )


def catalogue(spark: SparkSession, dirty: bool = False) -> DataFrame:
    return products_from_rows(spark, PRODUCT_ROWS + (DIRTY_PRODUCT_ROWS if dirty else []))


def load_inputs(spark: SparkSession, sf_dir: str, dirty: bool = False) -> PricingInputs:
    """The inputs from the tables; ``dirty`` breaks some rows, for the quality checks to find."""
    return PricingInputs(
        cost_bands=cost_bands_from_customers(_table(spark, sf_dir, "customer"), dirty),
        products=catalogue(spark, dirty),
        quotes=quotes_from_lineitem(_table(spark, sf_dir, "lineitem"), dirty),
    )
