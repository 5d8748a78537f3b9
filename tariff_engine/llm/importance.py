"""Target-distribution importance resampling over hashed n-grams.

* *Scan.* A text's separators are collapsed to single spaces; a regular expression with boundary lookarounds and
  ``overlapped=True`` then yields the span of every run of n words. Its CRC-32 modulo the number of buckets is the
  feature's bucket. Each text is scanned once: its buckets are kept as packed 16- or 32-bit numbers.
* *Counts.* Bucket counts over all source and all target texts are summed in the tasks, then over them, so a task
  sends at most one row per bucket. The log-ratio gains are one number per bucket: bounded by the parameter
  ``buckets``, not by the data, and sent to all tasks.
* *Weights.* A document's weight is the floored mean of its features' gains.
* *Drawing.* Gumbel noise from a hash of the id turns the highest scores into a sample without replacement.
  Places come from a range-partitioned sort: a row's place is its place within its partition plus the rows of
  earlier partitions (one row per partition). No task holds more than its range.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariff_engine.llm import scratch

#: Lower-cased ASCII letters, digits and every byte of a non-ASCII character are part of words.
_SEPARATORS = regex.compile(rb"[^0-9a-z\x80-\xff]+")
#: Distinct n-grams whose buckets a task remembers at a time.
_MEMO = 1 << 17


def _runs(n: int) -> regex.Pattern:
    """Runs of n words in a text whose words are separated by single spaces; overlapping ones too, if asked for."""
    return regex.compile(rb"(?<![^ ])[^ ]+" + rb"(?: [^ ]+)" * (n - 1) + rb"(?![^ ])")


class NgramBuckets:
    """Buckets of all runs of 1 to ``longest`` words of a text."""

    def __init__(self, longest: int, buckets: int) -> None:
        self.longest, self.buckets = longest, buckets
        self.dtype = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")
        self._patterns = [_runs(n) for n in range(1, longest + 1)]
        self._memo: dict[bytes, int] = {}

    def __reduce__(self):
        return NgramBuckets, (self.longest, self.buckets)

    def _bucket(self, gram: bytes) -> int:
        found = self._memo.get(gram)
        if found is None:
            if len(self._memo) >= _MEMO:
                self._memo.clear()
            found = self._memo[gram] = zlib.crc32(gram) % self.buckets
        return found

    def of(self, text: bytes | None) -> tuple[int, np.ndarray]:
        """(number of words, bucket of every feature)."""
        flat = _SEPARATORS.sub(b" ", (text or b"").lower()).strip(b" ")
        bucket = self._bucket
        found = [
            np.fromiter((bucket(m.group()) for m in p.finditer(flat, overlapped=True)), dtype=self.dtype) for p in self._patterns
        ]
        return len(found[0]), np.concatenate(found)


def _scan(ngrams: NgramBuckets):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [ngrams.of(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _ in found], pa.int64()), pa.array([f.tobytes() for _, f in found], pa.binary())],
                names=["doc_id", "n_words", "features"])

    return scan


def scanned(df: DataFrame, ngrams: NgramBuckets, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_words, features (packed buckets) of every row's whole text; a null text has no words."""
    docs = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    return docs.mapInArrow(
        _scan(ngrams), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, features binary")


def bucket_counts(features: DataFrame, ngrams: NgramBuckets) -> np.ndarray:
    """How often each bucket occurs over all rows: one row per bucket and task, then one per bucket."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ngrams.buckets, dtype=np.int64)
        for batch in batches:
            for packed in batch.column(0):
                total += np.bincount(np.frombuffer(packed.as_py(), ngrams.dtype), minlength=ngrams.buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    counted = features.select("features").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(ngrams.buckets, dtype=np.int64)
    for row in counted.collect():  # at most one row per bucket
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of each bucket's add-one share in the target over that in the source)."""
    k = len(source)
    s_all, t_all = int(source.sum()), int(target.sum())
    return np.array([
        math.floor(1000 * math.log((float(t + 1) * float(s_all + k)) / (float(s + 1) * float(t_all + k))))
        for s, t in zip(source.tolist(), target.tolist())
    ], dtype=np.int64)


def _weigh(gain: np.ndarray, dtype: np.dtype):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, weights = [], []
            for packed in batch.column(2):
                own = np.frombuffer(packed.as_py(), dtype)
                sizes.append(len(own))
                weights.append(int(gain[own].sum()) // len(own) if len(own) else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(weights, pa.int64())],
                names=["doc_id", "n_words", "n_features", "weight"])

    return weigh


def _noise(seed: int) -> Column:
    """floor(-1000 * ln(-ln(u))) of a number u in (0, 1) from a hash of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def with_places(df: DataFrame, *order: Column) -> DataFrame:
    """The rows with ``place`` (long, from 1) in the given order, without a task that holds them all.

    Equal rows are spread by the order they were read in, so that no range has to hold all of them.
    """
    spread = df.withColumn("_read", F.monotonically_increasing_id())
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    by = [*order, F.col("_read")]
    # `at` is the partition's number in its upper bits and the row's place in it in the lower 33
    ranged = spread.repartitionByRange(n, *by).sortWithinPartitions(*by).drop("_read").withColumn("at", F.monotonically_increasing_id())
    placed = scratch.written(ranged, "places").withColumn("part", F.shiftright("at", 33))
    sizes = {r["part"]: r["n"] for r in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a part
    bases, base = [], 0
    for part in range(max(sizes, default=0) + 1):
        bases.append(base)
        base += sizes.get(part, 0)
    earlier = F.element_at(F.array(*[F.lit(b).cast("long") for b in bases]), (F.col("part") + 1).cast("int"))
    return placed.withColumn("place", earlier + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("at", "part")


def importance_resample(
    source: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000, per_hundred: int = 10, least_words: int = 20,
    seed: int = 2024, id_col: str = "doc_id", text_col: str = "text", target_id: str = "item_id", target_text: str = "text",
) -> DataFrame:
    """One row per source row: doc_id, n_words, n_features, weight, score, rank (null where not drawn).

    Of the N rows with at least ``least_words`` words, floor(per_hundred * N / 100) with the highest scores are drawn;
    ties go to smaller ids (null ids last). Null and empty texts have no words, no features and weight 0. A null id
    counts as empty in the noise. Rows that repeat an id or are repeated whole are rows of their own, with equal
    scores if their texts are equal; their places follow the order they were read in. An empty target or source has
    counts of zero; an empty source gives no rows. Texts of any length are scanned whole. Extra columns are not read.
    """
    ngrams = NgramBuckets(longest, buckets)
    features = scratch.written(scanned(source, ngrams, id_col, text_col), "features")
    gain = gains(bucket_counts(features, ngrams), bucket_counts(scanned(target, ngrams, target_id, target_text), ngrams))
    schema = f"doc_id {features.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, weight long"
    weighed = features.mapInArrow(_weigh(gain, ngrams.dtype), schema)
    fit = F.col("n_words") >= least_words
    scored = weighed.withColumn("score", (F.col("weight") + _noise(seed)).cast("long")).withColumn("fit", fit)
    placed = with_places(scored, F.desc("fit"), F.desc("score"), F.asc_nulls_last("doc_id"))
    drawn = placed.select(F.floor(F.count_if("fit") * per_hundred / F.lit(100)).cast("long")).scalar()
    rank = F.when(F.col("fit") & (F.col("place") <= drawn), F.col("place"))
    return placed.select("doc_id", "n_words", "n_features", "weight", "score", rank.alias("rank"))
