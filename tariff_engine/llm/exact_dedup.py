"""Exact deduplication by skew-safe combining, with DataFrame functions only.

Copies per digest are counted first, with map-side partial sums, which names the hot digests. Only these have more than
one salt, and only they go through all three stages; other groups are whole after the second.

1. *Locally*: each map task combines its rows of a hot digest with the same salt **and the same full normalised text** into
   one local winner (the partial aggregation), so a task ships one text of each, however many copies it has.
2. *Salted*: local winners merge per (digest, salt, full text). All rows are shuffled once by (digest, salt), with their text,
   as the result has a row for each of them; within a part, rows with the same digest and the same full text
   form a class. No part holds more than about ``hot_share`` of all rows, but for rows that are repeated whole.
3. *Globally*: the winners of a hot digest's salts are combined by digest and full text, once more with a partial
   aggregation, and their verdict returns to the rows through a broadcast.

The two broadcasts are bounded by construction: fewer than ``1 / hot_share`` digests can each hold more than
``hot_share`` of the rows, and together they have fewer than ``2 / hot_share`` salts. They carry no text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tariff_engine.llm.columns import ascii_lower

#: A digest with more than this share of all rows is salted.
HOT_SHARE = 1e-4


def normalised(text: Column) -> Column:
    """What texts are compared by: A-Z lower-cased, null as the empty text."""
    return ascii_lower(F.coalesce(text, F.lit("")))


def exact_dedup(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_share: float = HOT_SHARE, carry: bool = False
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 (and ``row`` with ``carry``).

    Rows whose texts are equal after lower-casing A-Z form a group; its row with the largest id stays.
    With ``carry``, the struct ``row`` holds every input column, whatever its name, so that extra columns
    never clash with the result's.

    Null text counts as empty. Null ids sort below all others; a group of null ids only has a null keep_id.
    Of rows that repeat the largest id (ties, repeated rows), exactly one is kept. An empty table gives none.
    Texts of any length are compared in full.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]) if carry else F.struct(F.col(f"`{text_col}`").alias("text"))
    text_at = "row.`%s`" % (text_col if carry else "text")
    base = df.select(F.col(f"`{id_col}`").alias("doc_id"), row.alias("row")).withColumn(
        "text_sha256", F.sha2(normalised(F.col(text_at)), 256)
    )
    counts = base.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("copies"))
    at_most = F.greatest(F.lit(1.0), df.select(F.count(F.lit(1)) * F.lit(hot_share)).scalar())
    hot = counts.where(F.col("copies") > at_most).select("text_sha256", F.ceil(F.col("copies") / at_most).alias("salts"))

    salted = (
        base.join(F.broadcast(hot), "text_sha256", "left")
        .withColumn("salts", F.coalesce("salts", F.lit(1)))
        # from the row's values alone: both passes over the rows have to give it the same salt
        .withColumn("salt", F.when(F.col("salts") > 1, F.pmod(F.xxhash64("doc_id", "row"), F.col("salts"))).otherwise(F.lit(0).cast("long")))
    )
    content = normalised(F.col(text_at)).alias("content")
    # the text is normalised after the exchange, which so carries one text a row
    parts = salted.repartition("text_sha256", "salt").select("*", content)
    same = Window.partitionBy("text_sha256", "salt", "content")
    by_content = Window.partitionBy("text_sha256", "salt").orderBy("content")
    by_id = F.col("doc_id").desc_nulls_last()
    parts = parts.select(
        "doc_id", "row", "text_sha256", "salt",
        F.dense_rank().over(by_content).alias("content_no"),
        F.row_number().over(same.orderBy(by_id)).alias("place"),
        F.max("doc_id").over(same).alias("local_keep"),
        F.count(F.lit(1)).over(same).alias("local_size"),
    )
    of_hot = salted.where("salts > 1").select("doc_id", "text_sha256", "salt", content)
    local = of_hot.groupBy("text_sha256", "salt", "content").agg(F.max("doc_id").alias("keep"), F.count(F.lit(1)).alias("size"))
    # the largest id, null being the least, and of salts that tie on it the smallest
    best = F.max(F.struct("keep", (-F.col("salt")).alias("minus_salt"))).alias("best")
    numbered = local.withColumn("content_no", F.dense_rank().over(by_content))
    # a digest has at most 1 / hot_share salts
    salts = F.collect_list(F.struct("salt", "content_no")).alias("salts")
    groups = numbered.groupBy("text_sha256", "content").agg(best, F.sum("size").alias("all_size"), salts)
    winners = groups.select("text_sha256", "best", "all_size", F.inline("salts")).select(
        "text_sha256", "salt", "content_no", F.col("best.keep").alias("all_keep"), "all_size",
        (F.col("salt") == -F.col("best.minus_salt")).alias("elected"),
    )
    joined = parts.join(F.broadcast(winners), ["text_sha256", "salt", "content_no"], "left")
    split = F.col("all_size").isNotNull()
    return joined.select(
        "doc_id",
        F.when(split, F.col("all_keep")).otherwise(F.col("local_keep")).alias("keep_id"),
        F.coalesce("all_size", "local_size").alias("group_size"),
        ((F.col("place") == 1) & F.coalesce("elected", F.lit(True))).alias("kept"),
        "text_sha256",
        *(["row"] if carry else []),
    )
