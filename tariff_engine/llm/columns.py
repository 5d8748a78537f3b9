"""Small column helpers that several operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Steps in which `hashed_share` tells shares apart.
_SHARES = 1 << 30


def hashed_share(share: float, *keys: str) -> Column:
    """Condition that holds for about this share of all rows, by a hash of their keys; always the same rows.

    Unlike a sorted limit, a filter makes no task send more than its share.
    """
    return F.pmod(F.xxhash64(F.lit("share"), *keys), F.lit(_SHARES)) < F.lit(int(min(1.0, share) * _SHARES))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null stays null.

    On pure ASCII ``lower`` does exactly that and is much cheaper than ``translate``.
    """
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )
