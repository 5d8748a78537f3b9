"""SimHash near-duplicates by multi-index hashing.

A text's fingerprint has a bit set where over half of its 3-word shingles' XXH64 values (repeats included) have it.
Fingerprints link at `RADIUS` = 2 or fewer differing bits. All work after the fingerprints is on distinct ones:

* *Tables.* A fingerprint is cut into two 32-bit segments, each the key of one table. Of two fingerprints within two
  bits, by the pigeonhole principle, either the high segments differ in at most one bit, or the low ones are equal.
  So each fingerprint probes the high table with the 33 values of the Hamming ball of radius 1 around its segment,
  and the low table with its own value; the matches' complete distances are verified.
* *Hot segments.* Where more than `HOT` fingerprints share a segment, matching them in pairs would grow with the square
  of their number. Two fingerprints are within two bits exactly if some value is within one bit of both, so these
  fingerprints (and all that probe them) are grouped by the 65 values within one bit of them instead: every
  such group has at most 65 members, however many fingerprints share the segment.
* *Components* come from large and small stars over the links (`components.py`), and go back to the documents by
  fingerprint; a fingerprint of more than `HOT_SHARE` of all documents goes back by a broadcast, of which there are
  fewer than ``1 / HOT_SHARE``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariff_engine.llm import scratch
from tariff_engine.llm.components import connected_components

WORDS = 3
SEED = 42
RADIUS = 2
#: Fingerprints per segment value beyond which they are grouped by near values instead of matched in pairs.
HOT = 64
#: A fingerprint with more than this share of all documents is broadcast on the way back to them.
HOT_SHARE = 1e-3

#: Shingles whose bits are counted in one numpy pass.
_PASS = 1 << 15
_SEGMENT = 32


def fingerprint(text: bytes | None) -> int:
    """Unsigned 64-bit SimHash of a text: words are runs of bytes other than space and 0x09-0x0D, A-Z lower-cased."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= WORDS:
        return xxhash.xxh64_intdigest(joined, SEED)  # one value has its own bits in over half
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    first, last = starts[: 1 - WORDS], ends[WORDS - 1:]
    counts = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for low in range(0, len(first), _PASS):
        spans = zip(first[low:low + _PASS].tolist(), last[low:low + _PASS].tolist())
        values = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), dtype="<u8")
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(first), bitorder="little").tobytes(), "little")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.fromiter((fingerprint(t.as_py()) for t in batch.column(1)), dtype=np.uint64, count=batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``fp``, the fingerprint's 64 bits as a signed long, for every row."""
    docs = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    return docs.mapInArrow(_fingerprints, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


def _high(fp: str):
    return F.shiftrightunsigned(fp, _SEGMENT)


def _low(fp: str):
    return F.col(fp).bitwiseAND(F.lit((1 << _SEGMENT) - 1))


def _one_bit(n: int) -> list:
    """No bit, then each of the n lowest bits alone, as signed longs."""
    return [F.lit(0)] + [F.lit((1 << k) - (1 << 64) * (k == 63)) for k in range(n)]


def links(prints: DataFrame, hot: int = HOT) -> DataFrame:
    """(a, b): links among the distinct fingerprints ``fp`` that connect all within `RADIUS` bits of one another.

    Every pair within the radius is linked directly or, where its segment is hot, through a value near to both.
    """
    entries = prints.select(F.explode(F.array(
        F.struct(F.lit(0).alias("segment"), _high("fp").alias("value"), "fp"),
        F.struct(F.lit(1).alias("segment"), _low("fp").alias("value"), "fp"))).alias("e")).select("e.*")
    ball = [F.struct(F.lit(0).alias("segment"), _high("fp").bitwiseXOR(bit).alias("value")) for bit in _one_bit(_SEGMENT)]
    probes = prints.select("fp", F.inline(F.array(*ball, F.struct(F.lit(1).alias("segment"), _low("fp").alias("value")))))
    key = ["segment", "value"]
    crowded = entries.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select(*key)

    cold = entries.join(crowded, key, "left_anti").withColumnRenamed("fp", "other")
    verified = probes.join(cold, key).where(
        (F.col("fp") != F.col("other")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= RADIUS))
    pairs = verified.select(F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b"))

    near_hot = probes.join(crowded, key, "left_semi").select("fp").distinct()
    around = near_hot.select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(bit) for bit in _one_bit(64)])).alias("near"))
    # at most 65 fingerprints are within one bit of a value
    met = around.groupBy("near").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    stars = met.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b")
    return pairs.union(stars).distinct()


def simhash_groups(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, hot_share: float = HOT_SHARE
) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 lowercase hex digits), component_id.

    ``component_id`` is the smallest id of the rows whose fingerprints are reachable over links of at most two differing
    bits. Null, empty and white texts have fingerprint zero and link like any other. A text of fewer than three words has
    its whole sequence as its only shingle. Repeated rows and rows of one id with several texts each keep their row.
    Null ids are never the smallest; a component of null ids only has a null id. Texts of any length are read whole.
    Extra columns are not read, whatever their names. An empty table gives no rows.
    """
    docs = scratch.written(fingerprints(df, id_col, text_col), "fingerprints")
    prints = scratch.written(
        docs.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")), "distinct-fingerprints")
    grouped = connected_components(links(prints.select("fp"), hot)).select(F.col("node").alias("fp"), "component")
    labelled = prints.join(grouped, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    known = scratch.written(labelled.join(smallest, "component").select("fp", "copies", "component_id"), "fingerprint-components")

    # fewer than 1 / hot_share fingerprints can each have more than hot_share of the documents
    at_least = F.lit(hot_share) * docs.select(F.count(F.lit(1))).scalar()
    often = F.broadcast(known.where(F.col("copies") > at_least).select("fp", "component_id"))
    seldom = known.where(F.col("copies") <= at_least).select("fp", "component_id")
    found = docs.join(often, "fp").unionByName(docs.join(often, "fp", "left_anti").join(seldom, "fp"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
