"""Text normalisation of raw input columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tariff_engine.functions.numeric import round_half_away
from tariff_engine.params import DEFAULT_PARAMS, PricingParams

# Unit words of the German duration text (matched lower-case,
# as substrings, tested in this order) and the pattern for its first integer.
WEEK_WORD = "woche"
YEAR_WORD = "jahr"
MONTH_WORD = "monat"
FIRST_INTEGER = r"(\d+)"


def norm_postcode(col: Column, width: int = DEFAULT_PARAMS.postcode_width) -> Column:
    """Postcode as text, left-padded with zeros to ``width``; longer text is cut to ``width``."""
    return F.lpad(col.cast("string"), width, "0")


def contract_months(text: Column, params: PricingParams = DEFAULT_PARAMS) -> Column:
    """Duration text -> whole months.

    ``n Woche(n)`` -> round(n * days_per_week / days_per_month), ``n Jahr(e)`` -> n * 12,
    ``n Monat(e)`` or anything else -> n. Text without digits gives NULL rather than
    failing the job (the data-quality checks report it).
    """
    # few references to the text and the number: filters copy the whole expression into their scan's generated code,
    # and the virtual machine never compiles a method of more than 8,000 bytes
    lowered = F.lower(text)
    n = F.regexp_extract(text, FIRST_INTEGER, 1).try_cast("int")
    weeks = round_half_away(n * F.lit(params.days_per_week) / F.lit(params.days_per_month), 0).cast("int")
    per_unit = F.when(lowered.contains(YEAR_WORD), F.lit(12)).otherwise(F.lit(1))
    return F.when(lowered.contains(WEEK_WORD), weeks).otherwise(n * per_unit)
