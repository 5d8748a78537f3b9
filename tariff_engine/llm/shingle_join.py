"""N-gram Jaccard join: all pairs of texts whose shingle sets reach a similarity, as components and counts.

Sets are joined by a count-vector R-tree (`count_rtree`): a tree's bounds give the candidates, exact intersections
decide. Four steps keep the trees small and the result whole:

1. *Frequencies.* Token blobs (one per batch of documents and hash bucket) go to buckets, which answer each batch with
   the tokens that occur elsewhere, and how often. A set's prefix is its rarest tokens, as many as one of which any
   similar set must share; a set whose prefix occurs nowhere else has no partner and leaves here.
2. *Hubs.* Equal sets are one class. Classes with an equal min-hash are verified against the least of them, and what
   links becomes a component, so that a group of near copies is not expanded into its pairs.
3. *Trees.* Classes that share a prefix token but not the component meet in blocks; large blocks are split into tiles
   of bounded size, each pair of tiles a block of its own. Each block is an R-tree join on count vectors, in which
   nothing is asked within the block's largest component. First each class is verified against the one of
   the highest bound only, which joins dense groups along few links; the last round verifies every candidate
   between components that are still different.
4. *Components* of all links. No link between different components is left out, so they are exact.
5. *Counts.* The links of steps 2 and 3 are only as many as span the components. Similar sets are in one component, so
   that the number of all links of a document comes from exact intersections of all pairs within each component,
   tile by tile; the pairs are counted where they are found and not emitted.

Shingles are 64-bit hashes; frequencies and intersections use their upper 48 bits. Two sets of 1,000 shingles have a
chance of about 4e-9 to share one by collision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariff_engine.llm import scratch
from tariff_engine.llm.components import connected_components
from tariff_engine.llm.count_rtree import LEAF, CountTree, count_vector, least_overlap, points_of
from tariff_engine.llm.shingles import mix, shingle_sets

#: Least similarity, as num / den.
SIMILARITY = (75, 100)
#: Tokens of one batch of documents (a longer document makes a batch of its own).
BATCH_TOKENS = 1 << 20
#: Tokens that a bucket of hashes is meant to hold: the number of buckets is that of all tokens over this, rounded up.
BUCKET_TOKENS = 1 << 21
#: A token in more documents of a batch than this goes to its bucket as a count.
WIDE = 64
#: Min-hash keys of a class.
KEYS = 1
#: Rounds in which each class is verified against its nearest ones only, before the whole join.
ROUNDS = 1
#: Classes of a block that is not split into tiles.
TILE = 512
#: The same where links are counted, and cells of a matrix of classes by tokens there.
COUNT_TILE = 1024
COUNT_CELLS = 1 << 22

_DEALT = "key long, batch long, kind int, payload binary"
_LIVE = "digest binary, n long, shared binary, prefix array<long>, keys array<long>"


def _digest(tokens: np.ndarray) -> bytes:
    """128 bits of a set, whatever the order of its tokens."""
    sums = [mix(tokens ^ np.uint64(s)).sum(dtype=np.uint64) for s in (0x51ED2701, 0xB5297A4D)]
    return np.asarray(sums, dtype="<u8").tobytes()


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = list(shingle_sets(batch.column(1).to_pylist()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(map(len, sets), pa.int64()), pa.array([_digest(s) if len(s) else None for s in sets], pa.binary())],
            names=["doc_id", "n_shingles", "digest"],
        )


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of unsigned integers, one after another, each with its length and width."""
    out = []
    for a in arrays:
        out += [np.asarray([len(a), a.dtype.itemsize], dtype="<u4").tobytes(), a.astype(f"<u{a.dtype.itemsize}").tobytes()]
    return b"".join(out)


def _unpack(blob: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(blob):
        n, width = np.frombuffer(blob, dtype="<u4", count=2, offset=at).tolist()
        out.append(np.frombuffer(blob, dtype=f"<u{width}", count=n, offset=at + 8))
        at += 8 + n * width
    return out


def _five(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lower 40 bits of token ids as 4 + 1 bytes."""
    return (tokens & np.uint64(0xFFFFFFFF)).astype(np.uint32), ((tokens >> np.uint64(32)) & np.uint64(0xFF)).astype(np.uint8)


def _whole(low: np.ndarray, high: np.ndarray, bucket: int, bits: int) -> np.ndarray:
    """48-bit ids from their lower 40 bits and their bucket, which is their upper ``bits``."""
    rest = low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32))
    kept = np.uint64(48 - bits)
    return (np.uint64(bucket) << kept) | (rest & ((np.uint64(1) << kept) - np.uint64(1)))


def _deal(bits: int):
    """Documents to blobs: a token's bucket is the upper ``bits`` (at least 8) of its id."""

    def batch_rows(number: int, sets: list[np.ndarray]) -> Iterator[tuple]:
        sizes = np.asarray([len(s) for s in sets], dtype=np.uint32)
        tokens = np.concatenate(sets) >> np.uint64(16)
        docs = np.repeat(np.arange(len(sets), dtype=np.uint32), sizes)
        buckets = (tokens >> np.uint64(48 - bits)).astype(np.int64)
        order = np.lexsort((tokens, buckets))
        run = tokens[order]
        first = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1])))
        counts = np.diff(np.append(first, len(run)))
        wide_run = counts > WIDE
        wide = np.zeros(len(tokens), dtype=bool)
        wide[order[np.repeat(wide_run, counts)]] = True
        wide_tokens, wide_counts = run[first[wide_run]], counts[wide_run].astype(np.uint32)
        wide_docs = docs[order][np.repeat(wide_run, counts)]  # by token
        digests = np.frombuffer(b"".join(_digest(s) for s in sets), dtype="<u8")
        # a key of its own, so that no group has more than one batch's
        yield (1 << bits) + number, number, 2, _pack(sizes, digests, wide_tokens, wide_counts, wide_docs)

        buckets, tokens, docs = buckets[~wide], tokens[~wide], docs[~wide]
        by_bucket = np.argsort(buckets, kind="stable")  # documents stay in order
        tokens, docs, buckets = tokens[by_bucket], docs[by_bucket], buckets[by_bucket]
        edges = np.searchsorted(buckets, np.arange((1 << bits) + 1))
        wide_edges = np.searchsorted((wide_tokens >> np.uint64(48 - bits)).astype(np.int64), np.arange((1 << bits) + 1))
        for bucket in np.flatnonzero((np.diff(edges) > 0) | (np.diff(wide_edges) > 0)).tolist():
            part = slice(edges[bucket], edges[bucket + 1])
            per_doc = np.bincount(docs[part], minlength=len(sets))
            per_doc = per_doc.astype(np.uint8 if per_doc.max(initial=0) < 256 else np.uint32)
            w = slice(wide_edges[bucket], wide_edges[bucket + 1])
            yield bucket, number, 0, _pack(per_doc, *_five(tokens[part]), *_five(wide_tokens[w]), wide_counts[w])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            columns = zip(*batch_rows(number, held))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["key", "batch", "kind", "payload"])

        for batch in batches:
            for tokens in shingle_sets(batch.column(0).to_pylist()):
                if len(tokens):
                    held.append(tokens)
                    size += len(tokens)
                    if size >= BATCH_TOKENS:
                        yield flush()
                        held, size, number = [], 0, number + 1
        if held:
            yield flush()

    return deal


def _frequencies(bits: int):
    """A bucket's answer to each batch: its tokens that occur more than once anywhere, and how often."""

    def count(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        if bucket >= 1 << bits:  # what a batch keeps for itself
            return table.select(["batch", "kind", "payload"])
        blobs = [_unpack(p.as_py()) for p in table["payload"]]
        tokens = [_whole(b[1], b[2], bucket, bits) for b in blobs]
        wide = [_whole(b[3], b[4], bucket, bits) for b in blobs]
        values, inverse = np.unique(np.concatenate(tokens + wide), return_inverse=True)
        weights = np.concatenate([np.ones(sum(map(len, tokens))), *[b[5] for b in blobs]])
        often = np.bincount(inverse, weights=weights, minlength=len(values)).astype(np.uint32)
        often = often[inverse]
        batch_out, blob_out, at = [], [], 0
        wide_at = sum(map(len, tokens))
        for number, blob, own, wide_own in zip(table["batch"].to_pylist(), blobs, tokens, wide):
            df = often[at:at + len(own)]
            wide_df = often[wide_at:wide_at + len(wide_own)]
            at, wide_at = at + len(own), wide_at + len(wide_own)
            shared = df > 1
            docs = np.repeat(np.arange(len(blob[0]), dtype=np.uint32), blob[0])[shared]
            if len(docs) or len(wide_own):
                batch_out.append(number)
                blob_out.append(_pack(docs, own[shared], df[shared], wide_own, wide_df))
        n = len(batch_out)
        return pa.table({"batch": pa.array(batch_out, pa.int64()), "kind": pa.array([0] * n, pa.int32()), "payload": pa.array(blob_out, pa.binary())})

    return count


def _prefixes(num: int, den: int):
    """A batch's documents with the tokens that they share and their prefixes; those without a partner leave."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        answers, own = [], None
        for kind, payload in zip(table["kind"].to_pylist(), table["payload"]):
            blob = _unpack(payload.as_py())
            if kind == 2:
                own = blob
            else:
                answers.append(blob)
        sizes, digests, wide_tokens, wide_counts, wide_docs = own
        often = dict(zip(*(np.concatenate([np.empty(0, np.uint64), *[a[k] for a in answers]]).tolist() for k in (3, 4))))
        wide_df = np.asarray([often[t] for t in wide_tokens.tolist()], dtype=np.int64)
        docs = np.concatenate([a[0] for a in answers] + [wide_docs]).astype(np.int64)
        tokens = np.concatenate([a[1] for a in answers] + [np.repeat(wide_tokens, wide_counts)]).astype(np.uint64)
        df = np.concatenate([a[2] for a in answers] + [np.repeat(wide_df, wide_counts)]).astype(np.int64)
        sizes = sizes.astype(np.int64)
        shared = np.bincount(docs, minlength=len(sizes))
        prefix = sizes - -(-num * sizes // den) + 1
        asks = prefix - (sizes - shared)  # the tokens that occur nowhere else come first in a prefix
        order = np.lexsort((tokens, df, docs))
        edges = np.searchsorted(docs[order], np.arange(len(sizes) + 1))
        out = {"digest": [], "n": [], "shared": [], "prefix": [], "keys": []}
        raw = digests.tobytes()
        for d in np.flatnonzero(asks > 0).tolist():
            mine = tokens[order[edges[d]:edges[d + 1]]]
            out["digest"].append(raw[16 * d:16 * d + 16])
            out["n"].append(int(sizes[d]))
            out["prefix"].append(mine[: int(asks[d])].astype(np.int64))
            out["keys"].append([int(mix(mine ^ np.uint64(0xA24BAED4 + k)).min().astype(np.int64)) for k in range(KEYS)])
            out["shared"].append(np.sort(mine).astype("<u8").tobytes())
        kinds = (pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        return pa.table({name: pa.array(out[name], kind) for name, kind in zip(out, kinds)})

    return run


def _similar(num: int, den: int):
    """Rows (a, b, n and shared tokens of both) whose sets reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            columns = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            for n_a, n_b, a, b in zip(columns["n_a"].to_pylist(), columns["n_b"].to_pylist(), columns["shared_a"], columns["shared_b"]):
                x, y = np.frombuffer(a.as_buffer(), dtype="<u8"), np.frombuffer(b.as_buffer(), dtype="<u8")
                if len(y) < len(x):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                both = int((y[at] == x).sum()) if len(y) else 0
                kept.append(den * both >= num * (n_a + n_b - both))
            mask = pa.array(kept, pa.bool_())
            yield pa.RecordBatch.from_arrays([columns["a"].filter(mask), columns["b"].filter(mask)], names=["a", "b"])

    return run


def verified(pairs: DataFrame, live: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of classes whose similarity is reached, by exact intersection."""
    side = lambda s: live.select(F.col("digest").alias(s), F.col("n").alias(f"n_{s}"), F.col("shared").alias(f"shared_{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    least, most = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    return both.where(least * den >= most * num).mapInArrow(_similar(num, den), "a binary, b binary")


def _points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds each class's point in the R-tree: the count vector of the tokens that it shares."""
    for batch in batches:
        shared = batch.column(batch.schema.get_field_index("shared"))
        points = [count_vector(np.frombuffer(s.as_buffer(), dtype="<u8")) for s in shared]
        rest = [k for k, name in enumerate(batch.schema.names) if name != "shared"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in rest), pa.array(points, pa.binary())],
            names=[*(batch.schema.names[k] for k in rest), "point"],
        )


def _tree_join(num: int, den: int, nearest: bool):
    """Candidates of every block of a bucket: pairs of different components whose bound reaches the least overlap.

    With ``nearest``, only the highest bound of each class in each block.
    """

    def search(points: np.ndarray, sizes: np.ndarray, comps: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple:
        if not len(left) or not len(right):
            return left[:0], left[:0], left[:0]
        if len(left) * len(right) <= LEAF * LEAF:
            q, r = (x.ravel() for x in np.meshgrid(left, right, indexing="ij"))
            bound = np.minimum(points[q], points[r]).sum(axis=1, dtype=np.int64)
            kept = bound >= least_overlap(sizes[q], sizes[r], num, den)
            q, r, bound = q[kept], r[kept], bound[kept]
        else:
            q, r, bound = CountTree(points[right], sizes[right]).matches(points[left], sizes[left], num, den)
            q, r = left[q], right[r]
        kept = comps[q] != comps[r]
        return q[kept], r[kept], bound[kept]

    def block(points: np.ndarray, sizes: np.ndarray, comps: np.ndarray, sides: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # nothing is asked within the largest component, however large it is
        small = comps != np.bincount(comps).argmax()
        left, right = sides <= 0, sides >= 0
        found = [search(points, sizes, comps, np.flatnonzero(left & small), np.flatnonzero(right))]
        if (sides != 0).any():
            found.append(search(points, sizes, comps, np.flatnonzero(right & small), np.flatnonzero(left & ~small)))
        q, r, bound = (np.concatenate(x) for x in zip(*found))
        if nearest and len(q):
            order = np.lexsort((r, -bound, q))
            first = np.concatenate(([True], q[order][1:] != q[order][:-1]))
            q, r = q[order][first], r[order][first]
        return q, r

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("token", "ascending"), ("tile", "ascending")])
        digests = np.asarray(table["digest"].to_pylist(), dtype=object)
        sizes = table["n"].to_numpy()
        _, comps = np.unique(np.asarray(table["component"].to_pylist(), dtype=object), return_inverse=True)
        points = points_of(table["point"].to_pylist())
        sides, tokens, tiles = table["side"].to_numpy(), table["token"].to_numpy(), table["tile"].to_numpy()
        starts = np.flatnonzero(np.concatenate(([True], (tokens[1:] != tokens[:-1]) | (tiles[1:] != tiles[:-1]))))
        found: set[tuple[bytes, bytes]] = set()
        for low, high in zip(starts.tolist(), [*starts[1:].tolist(), len(sizes)]):
            part = slice(low, high)
            q, r = block(points[part], sizes[part], comps[part], sides[part])
            a, b = digests[part][q].tolist(), digests[part][r].tolist()
            found.update((x, y) if x < y else (y, x) for x, y in zip(a, b))
        return pa.table({"a": pa.array([a for a, _ in found], pa.binary()), "b": pa.array([b for _, b in found], pa.binary())})

    return run


def blocks_of(live: DataFrame) -> DataFrame:
    """(token, digest, size) of the prefix tokens that several classes have."""
    rows = live.select("digest", F.explode("prefix").alias("token"))
    sizes = rows.groupBy("token").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return rows.join(sizes, "token")


def candidates(
    blocks: DataFrame, points: DataFrame, members: DataFrame, buckets: int, num: int, den: int, nearest: bool, tile: int = TILE
) -> DataFrame:
    """Pairs (a, b) of classes of different components (``members``: node, component) that an R-tree cannot rule out.

    With ``nearest``, each class has only the partner of the highest bound in each of its blocks.
    """
    at = members.select(F.col("node").alias("digest"), "component")
    rows = blocks.join(at, "digest", "left").withColumn("component", F.coalesce("component", "digest"))
    mixed = rows.groupBy("token").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    active = rows.join(mixed.where("least <> most").select("token"), "token", "left_semi")
    active = active.withColumn("tiles", F.ceil(F.col("size") / tile))
    # a class's row goes to every pair of tiles that its own is in
    own = F.pmod(F.xxhash64("token", "digest"), F.col("tiles"))
    dealt = active.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    dealt = dealt.select(
        "digest", "token", "component",
        (F.greatest("own", "other") * F.col("tiles") + F.least("own", "other")).alias("tile"),
        F.signum(F.col("own") - F.col("other")).cast("int").alias("side"),
    )
    placed = dealt.join(points, "digest").withColumn("bucket", F.pmod(F.xxhash64("token", "tile"), F.lit(buckets)))
    return placed.groupBy("bucket").applyInArrow(_tree_join(num, den, nearest), "a binary, b binary").distinct()


def merged(members: DataFrame, links: DataFrame) -> DataFrame:
    """``members`` (node, component) after further links (a, b) between nodes, some of which may be new."""
    at = lambda side: members.select(F.col("node").alias(side), F.col("component").alias(f"c_{side}"))
    component = lambda side: F.coalesce(F.col(f"c_{side}"), F.col(side)).alias(side)
    between = links.join(at("a"), "a", "left").join(at("b"), "b", "left").select(component("a"), component("b"))
    wider = connected_components(between).select(F.col("node").alias("component"), F.col("component").alias("wider"))
    alone = links.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(members, "node", "left_anti")
    every = members.union(alone.select("node", F.col("node").alias("component")))
    every = every.join(wider, "component", "left").select("node", F.coalesce("wider", "component").alias("component"))
    return scratch.written(every, "members")


def _overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of all left sets (rows) with all right ones (columns)."""
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    rows = np.repeat(np.arange(len(sets)), np.fromiter(map(len, sets), dtype=np.int64, count=len(sets)))
    _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = column.reshape(-1)
    shared = often > 1
    rows, column = rows[shared[column]], (np.cumsum(shared) - 1)[column[shared[column]]]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    width = max(1, COUNT_CELLS // len(sets))  # sums of a float32 product stay exact far beyond it
    for low in range(0, int(shared.sum()), width):
        part = slice(*np.searchsorted(column, [low, low + width]))
        has = np.zeros((len(sets), min(width, int(shared.sum()) - low)), dtype=np.float32)
        has[rows[part], column[part] - low] = 1
        out += (has[left] @ has[right].T).astype(np.int64)
    return out


def _count_links(num: int, den: int):
    """Of rows sorted by component and tile: each class's links in a tile, as the number of documents at their other ends."""

    def block(rows: list[tuple]) -> Iterator[tuple[bytes, int]]:
        digests, sizes, weights, shared, sides = zip(*rows)
        sizes, weights, sides = (np.asarray(x, dtype=np.int64) for x in (sizes, weights, sides))
        left, right = np.flatnonzero(sides <= 0), np.flatnonzero(sides >= 0)
        if not len(left) or not len(right):
            return
        both = _overlaps([np.frombuffer(x, dtype="<u8") for x in shared], left, right)
        linked = den * both >= num * (sizes[left][:, None] + sizes[right][None, :] - both)
        found = np.zeros(len(rows), dtype=np.int64)
        if (sides == 0).all():  # a tile with itself: each pair is there twice
            np.fill_diagonal(linked, False)
            found[left] = linked @ weights[right]
        else:
            found[left], found[right] = linked @ weights[right], weights[left] @ linked
        yield from ((digests[k], int(found[k])) for k in np.flatnonzero(found).tolist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            found = list(block(rows))
            return pa.RecordBatch.from_arrays(
                [pa.array([d for d, _ in found], pa.binary()), pa.array([c for _, c in found], pa.int64())], names=["digest", "linked"]
            )

        at, held = None, []
        for batch in batches:
            for component, tile, *row in zip(*(column.to_pylist() for column in batch.columns)):
                if (component, tile) != at:
                    if held:
                        yield out(held)
                    at, held = (component, tile), []
                held.append(row)
        if held:
            yield out(held)

    return run


def link_counts(members: DataFrame, live: DataFrame, weights: DataFrame, num: int, den: int, tile: int = COUNT_TILE) -> DataFrame:
    """(digest, linked): the number of documents in other classes that a class is linked with, where there are any.

    ``members``: node, component of all classes with a link. ``weights``: digest, weight (the documents of a class).
    """
    sizes = members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / tile).alias("tiles"))
    rows = members.withColumnRenamed("node", "digest").join(sizes, "component")
    own = F.pmod(F.xxhash64("component", "digest"), F.col("tiles"))
    dealt = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    dealt = dealt.select(
        "digest", "component",
        (F.greatest("own", "other") * F.col("tiles") + F.least("own", "other")).alias("tile"),
        F.signum(F.col("own") - F.col("other")).cast("int").alias("side"),
    )
    placed = dealt.join(weights, "digest").join(live.select("digest", "n", "shared"), "digest")
    placed = placed.select("component", "tile", "digest", "n", "weight", "shared", "side")
    blocks = placed.repartition("component", "tile").sortWithinPartitions("component", "tile")
    found = blocks.mapInArrow(_count_links(num, den), "digest binary, linked long")
    return found.groupBy("digest").agg(F.sum("linked").alias("linked"))


@dataclass(frozen=True)
class ShingleJoin:
    """``documents``: doc_id, n_shingles, component_id. ``links``: verified pairs (a, b) of classes, as many as span the
    components, not all. ``classes``: (doc_id, class). ``counted``: documents with n_links, of all similar pairs."""

    documents: DataFrame
    links: DataFrame
    classes: DataFrame
    counted: DataFrame


def shingle_join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: tuple[int, int] = SIMILARITY) -> ShingleJoin:
    """Join texts whose sets of five-word shingles have a Jaccard similarity of at least num / den.

    One row per input row, in ``documents``: the size of its set and the smallest id reachable by links. Equal
    sets are linked; a text with an empty set (null, empty or without words) is linked with nothing and keeps its
    own id. Null ids are ignored as component ids, unless a component has no other. Repeated rows share a class.
    ``counted`` adds n_links: the number of other rows, with equal sets or others, of which each is similar itself.
    It is computed only where it is read.
    Extra columns are not read. An empty table gives no rows. Texts of any length are read whole.
    """
    num, den = similarity
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    profiles = scratch.written(docs.mapInArrow(_profiles, f"doc_id {kind}, n_shingles long, digest binary"), "profiles")
    tokens = profiles.agg(F.sum("n_shingles")).first()[0] or 0
    bits = max(8, (partitions - 1).bit_length(), (tokens // BUCKET_TOKENS).bit_length())

    dealt = docs.select("text").mapInArrow(_deal(bits), _DEALT)
    answers = dealt.groupBy("key").applyInArrow(_frequencies(bits), "batch long, kind int, payload binary")
    live = answers.groupBy("batch").applyInArrow(_prefixes(num, den), _LIVE)
    live = scratch.written(live.dropDuplicates(["digest"]), "live")

    keyed = live.select("digest", F.posexplode("keys").alias("no", "key"))
    hubs = keyed.groupBy("no", "key").agg(F.min("digest").alias("hub"), F.count(F.lit(1)).alias("size")).where("size > 1")
    near = keyed.join(hubs, ["no", "key"]).where("digest <> hub").select(F.col("hub").alias("a"), F.col("digest").alias("b"))
    by_hub = scratch.written(verified(scratch.written(near.distinct(), "pairs"), live, num, den), "links")
    members = scratch.written(connected_components(by_hub), "members")

    blocks = scratch.written(blocks_of(live), "blocks")
    points = live.select("digest", "n", "shared").mapInArrow(_points, "digest binary, n long, point binary")
    points = scratch.written(points, "points")
    links = by_hub
    for nearest in [True] * ROUNDS + [False]:
        # written, so that the planner knows how few they are
        pairs = scratch.written(candidates(blocks, points, members, 1 << bits, num, den, nearest), "pairs")
        found = scratch.written(verified(pairs, live, num, den), "links")
        links = links.union(found)
        members = merged(members, found)
    final = members.withColumnRenamed("node", "digest")

    classes = profiles.where(F.col("digest").isNotNull()).groupBy("digest").agg(F.min("doc_id").alias("least"))
    grouped = classes.join(final, "digest", "left").withColumn("component", F.coalesce("component", "digest"))
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    labels = grouped.select("digest", "component").join(least, "component").select("digest", "component_id")
    component_id = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    documents = profiles.join(labels, "digest", "left").select("doc_id", "n_shingles", component_id)

    weights = profiles.where(F.col("digest").isNotNull()).groupBy("digest").agg(F.count(F.lit(1)).alias("weight"))
    counts = weights.join(link_counts(members, live, weights, num, den), "digest", "left")
    counts = counts.select("digest", (F.col("weight") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    counted = profiles.join(labels.join(counts, "digest"), "digest", "left").select(
        "doc_id", "n_shingles", component_id, F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")
    )
    return ShingleJoin(documents, links, profiles.select("doc_id", F.col("digest").alias("class")), counted)
