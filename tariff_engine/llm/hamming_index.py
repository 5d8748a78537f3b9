"""Approximate nearest neighbours by multi-index hashing over learned rotated binary codes.

Vectors are centred, projected and rotated (iterative quantisation, learned from a bounded sample) and reduced to
signs. Each code is split into substrings and each substring is indexed. Two codes within Hamming distance r agree,
by the pigeonhole principle, up to floor(r / m) bits in at least one of m substrings, so probing all substring values
that near a query's retrieves every code within r; the originals of these are then ranked by inner product.

Every row is indexed: rows and queries are dealt into blocks of bounded size, each pair of blocks is one task, and a
query's best of all blocks are merged. The radius is the one that holds `COVERED` of the true neighbours in the
sample; where a block holds fewer than k codes within it, the radius grows there until it does.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tariff_engine.llm.columns import hashed_share

#: Sample that rotation and radius are learned from: all rows, or about this many by hash (four times as many at most, where
#: repeated ids share a hash).
SAMPLE_ROWS = 4096
SAMPLE_QUERIES = 256
#: Share of the sample's true neighbours that the radius has to hold.
COVERED = 0.985
BITS = 64
SUBSTRINGS = 4
BLOCK_ROWS = 8192
BLOCK_QUERIES = 1024

_POPCOUNT = np.bitwise_count(np.arange(1 << 16, dtype=np.uint32)).astype(np.uint8)


def takes_part(vector: Column) -> Column:
    """Whether a vector is not null, not zero, and free of null and non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


class BinaryCode:
    """A learned map from vectors to codes of up to 64 bits in substrings of up to 16."""

    def __init__(self, mean: np.ndarray, rotation: np.ndarray) -> None:
        self.mean, self.rotation = mean, rotation
        self.bits = rotation.shape[1]
        edges = np.linspace(0, self.bits, min(SUBSTRINGS, self.bits) + 1).astype(int)
        self.slices = list(zip(edges[:-1].tolist(), edges[1:].tolist()))

    @classmethod
    def fit(cls, sample: np.ndarray, rounds: int = 30, seed: int = 0) -> BinaryCode:
        mean = sample.mean(axis=0)
        centred = sample - mean
        _, _, axes = np.linalg.svd(centred, full_matrices=False)
        axes = axes[:BITS].T
        flat = centred @ axes
        rotation, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((axes.shape[1],) * 2))
        for _ in range(rounds):
            u, _, v = np.linalg.svd(np.where(flat @ rotation >= 0, 1.0, -1.0).T @ flat)
            rotation = (u @ v).T
        return cls(mean, axes @ rotation)

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """(rows, substrings) of unsigned 16-bit values."""
        signs = (vectors - self.mean) @ self.rotation >= 0
        return np.stack(
            [(signs[:, a:b] * (1 << np.arange(b - a))).sum(axis=1).astype(np.uint16) for a, b in self.slices], axis=1
        )


def distances(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Hamming distance of each code to one."""
    return _POPCOUNT[codes ^ code].sum(axis=1, dtype=np.int64)


class MultiIndex:
    """The codes of a block with one table per substring."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        self.tables = []
        for k in range(codes.shape[1]):
            order = np.argsort(codes[:, k], kind="stable")
            values, sizes = np.unique(codes[order, k], return_counts=True)
            self.tables.append((order, values, sizes))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows of every code within the radius, ascending."""
        m = len(self.tables)
        hit = np.zeros(len(self.codes), dtype=bool)
        for k, (order, values, sizes) in enumerate(self.tables):
            # radius = a * m + b: either one of the first b + 1 substrings is within a, or another one within a - 1
            near = radius // m - (k > radius % m)
            if near < 0:
                continue
            # of the values within reach, only those that occur are probed
            close = _POPCOUNT[values ^ code[k]] <= near
            hit[order[np.repeat(close, sizes)]] = True
        rows = np.flatnonzero(hit)
        return rows[distances(self.codes[rows], code) <= radius]


def _radius(code: BinaryCode, sample: np.ndarray, k: int) -> int:
    """The smallest radius that holds `COVERED` of the sample queries' true neighbours in the sample."""
    codes = code.codes(sample)
    found = []
    for q in range(min(SAMPLE_QUERIES, len(sample))):
        scores = sample @ sample[q]
        scores[q] = -np.inf
        near = np.argsort(-scores, kind="stable")[: min(k, len(sample) - 1)]
        found.append(distances(codes[near], codes[q]))
    found = np.concatenate(found) if found else np.zeros(1)
    return int(np.quantile(found, COVERED, method="higher")) if len(found) else code.bits


def _search(code: BinaryCode, radius: int, k: int):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table, queries: pa.Table) -> pa.Table:
        out_q, out_v, out_s = [], [], []
        if rows.num_rows and queries.num_rows:
            ids = rows["vec_id"].to_numpy()
            vectors = np.stack(rows["vector"].to_numpy(zero_copy_only=False)).astype(np.float64)
            keep = _smallest_ids(vectors, ids, k + 1)
            ids, vectors = ids[keep], vectors[keep]
            index = MultiIndex(code.codes(vectors))
            asked = np.stack(queries["vector"].to_numpy(zero_copy_only=False)).astype(np.float64)
            for own, vector, c in zip(queries["vec_id"].to_pylist(), asked, code.codes(asked)):
                enough = min(k, int((ids != own).sum()))
                reach = radius
                found = index.within(c, reach)
                found = found[ids[found] != own]
                while len(found) < enough:
                    reach += max(1, code.bits // 16)
                    found = index.within(c, reach)
                    found = found[ids[found] != own]
                scores = (vectors[found] * vector).sum(axis=1)
                best = np.lexsort((ids[found], -scores))[:k]
                out_q.append(np.full(len(best), own))
                out_v.append(ids[found][best])
                out_s.append(scores[best])
        none = np.empty(0, dtype=np.int64)
        return pa.table({
            "query_id": pa.array(np.concatenate([none, *out_q]), pa.int64()),
            "vec_id": pa.array(np.concatenate([none, *out_v]), pa.int64()),
            "score": pa.array(np.concatenate([none.astype(np.float64), *out_s]), pa.float64()),
        })

    return run


def _smallest_ids(vectors: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Rows but for those with n equal vectors of smaller ids: such rows cannot be among a query's n - 1 nearest."""
    raw = np.ascontiguousarray(vectors + 0.0).view([("", vectors.dtype)] * vectors.shape[1]).ravel()
    _, group = np.unique(raw, return_inverse=True)
    order = np.lexsort((ids, group))
    sorted_group = group[order]
    first = np.searchsorted(sorted_group, sorted_group)
    return np.sort(order[np.arange(len(order)) - first < n])


def nearest_neighbours(df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found of each query by inner product.

    ``is_query`` is a condition on the column ``vec_id``. A query is not its own candidate; equal scores go to
    the smaller id. With fewer than k candidates all are returned.

    Rows with a null id, and vectors that are null, zero, or that hold null or non-finite components take no part.
    Vectors of other lengths than the longest count as zero in the dimensions that they lack. Rows that repeat an id count as one another's own. Extra columns
    are not read. An empty table gives no rows.
    """
    vector = F.col(f"`{vector_col}`")
    valid = df.where(takes_part(vector) & F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), vector.cast("array<double>").alias("vector")
    )
    n_valid, longest = valid.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    dims = longest or 1
    missing = F.array_repeat(F.lit(0.0), F.lit(dims) - F.size("vector"))
    valid = valid.withColumn("vector", F.when(F.size("vector") == dims, F.col("vector")).otherwise(F.concat("vector", missing)))
    drawn = valid.where(hashed_share(SAMPLE_ROWS / max(1, n_valid), "vec_id")).limit(4 * SAMPLE_ROWS)
    sampled = sorted(drawn.collect())
    sample = np.asarray([r["vector"] for r in sampled], dtype=np.float64) if sampled else np.zeros((1, dims))
    code = BinaryCode.fit(sample)
    radius = _radius(code, sample, k)

    blocks = lambda rows, size: F.greatest(F.lit(1).cast("long"), F.ceil(rows / F.lit(size)))
    counted = df.select(F.count(F.lit(1)).alias("n"))
    n_rows, n_queries = (
        counted.select(blocks(F.col("n"), BLOCK_ROWS)).scalar(),
        valid.where(is_query).select(blocks(F.count(F.lit(1)), BLOCK_QUERIES)).scalar(),
    )
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    rows = valid.withColumn("row_block", F.pmod(F.xxhash64("vec_id"), n_rows)).withColumn("query_block", every(n_queries))
    queries = valid.where(is_query).withColumn("query_block", F.pmod(F.xxhash64(F.lit(1), "vec_id"), n_queries)).withColumn(
        "row_block", every(n_rows)
    )
    found = (
        rows.groupBy("row_block", "query_block").cogroup(queries.groupBy("row_block", "query_block"))
        .applyInArrow(_search(code, radius, k), "query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
