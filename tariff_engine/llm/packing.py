"""Best-fit packing of documents into token sequences by a distributed grouping genetic algorithm.

An individual is a whole packing: which piece lies in which sequence. Crossover injects well-filled sequences of
one parent whole into the other, drops the sequences that now hold a piece twice, and best-fits the displaced
pieces. Mutation empties the worst-filled sequences and a few others. Fitness: fewer sequences, then fuller ones.

Pieces are dealt by hash into cells of about ``cell_docs`` documents, so that no group grows with the data. Every
cell is evolved on several islands, each a task with its own random stream; between epochs each island's elite
migrates to the next island of its cell, and the best packing of a cell wins at the end. Only small rows
(lengths, not ids) move between machines. Full pieces need no search and take a sequence of their own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariff_engine.llm import scratch
from tariff_engine.llm.encoding import byte_encoder

CAPACITY = 2048
#: Documents of one cell.
CELL_DOCS = 4096
ISLANDS = 2
EPOCHS = 2
POPULATION = 4
GENERATIONS = 8
#: Share of a parent's sequences that a crossover injects.
INJECTED = 0.35
#: Sequence numbers within a cell.
CELL_SHIFT = 32

_PIECE = "spread long, doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(tokenizer: str, capacity: int, end_id: int, keep_ids: bool):
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(tokenizer)
        spread = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = []
            texts = batch.column(1).to_pylist()
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts)):
                ids += end
                n = len(ids) // 4
                # the first piece takes what whole pieces leave over
                ends = [*range(n % capacity or capacity, n, capacity), n] if n > capacity else [n]
                start = 0
                for piece, stop in enumerate(ends):
                    part = ids[4 * start:4 * stop]
                    rows.append((spread, doc, piece, start, stop - start, zlib.crc32(part), *([part] if keep_ids else [])))
                    spread += 1
                    start = stop
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                names = ["spread", "doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names[:6 + keep_ids]
                )

    return cut


class Packing:
    """One individual: the sequence of each piece and the fill of each sequence."""

    __slots__ = ("of", "fill", "fitness")

    def __init__(self, of: np.ndarray, lengths: np.ndarray, capacity: int) -> None:
        used, self.of = np.unique(of, return_inverse=True)
        self.fill = np.bincount(self.of, weights=lengths, minlength=len(used)).astype(np.int64)
        self.fitness = (-len(self.fill), float(((self.fill / capacity) ** 2).sum()))


def best_fit(of: np.ndarray, fill: list[int], order: np.ndarray, lengths: np.ndarray, capacity: int) -> None:
    """Put each piece of ``order`` where it leaves the least room, or in a new sequence; in place."""
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r: some sequence has room r
    for number, used in enumerate(fill):
        room = capacity - used
        if room > 0:
            rooms[room].append(number)
            open_rooms |= 1 << room
    for piece, length in zip(order.tolist(), lengths[order].tolist()):
        fitting = open_rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            number = rooms[room].pop()
            if not rooms[room]:
                open_rooms ^= 1 << room
        else:
            room, number = capacity, len(fill)
            fill.append(0)
        of[piece] = number
        fill[number] += length
        room -= length
        if room:
            rooms[room].append(number)
            open_rooms |= 1 << room


def _refit(of: np.ndarray, displaced: np.ndarray, lengths: np.ndarray, capacity: int, rng: np.random.Generator, noise: float) -> Packing:
    """A packing from a partial one: ``displaced`` pieces are best-fitted, long ones first."""
    kept = np.ones(len(of), dtype=bool)
    kept[displaced] = False
    out = np.full(len(of), -1, dtype=np.int64)
    numbers, out[kept] = np.unique(of[kept], return_inverse=True)
    fill = np.bincount(out[kept], weights=lengths[kept], minlength=len(numbers)).astype(np.int64).tolist()
    keys = lengths[displaced] * (1 + noise * rng.random(len(displaced)))
    best_fit(out, fill, displaced[np.argsort(-keys, kind="stable")], lengths, capacity)
    return Packing(out, lengths, capacity)


def crossover(a: Packing, b: Packing, lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> Packing:
    """Inject well-filled sequences of ``b`` into ``a`` whole, and best-fit what they displace."""
    n = max(1, int(INJECTED * len(b.fill)))
    # the fuller a sequence, the likelier it is taken
    weights = rng.random(len(b.fill)) * (b.fill / capacity) ** 8
    taken = np.zeros(len(b.fill), dtype=bool)
    taken[np.argpartition(-weights, n - 1)[:n]] = True
    injected = taken[b.of]
    broken = np.zeros(len(a.fill), dtype=bool)
    broken[a.of[injected]] = True
    displaced = np.flatnonzero(broken[a.of] & ~injected)
    of = np.where(injected, len(a.fill) + b.of, a.of)
    return _refit(of, displaced, lengths, capacity, rng, 0.0)


def mutate(a: Packing, lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> Packing:
    """Empty the worst-filled sequences and a few random ones, and best-fit their pieces."""
    n = len(a.fill)
    emptied = np.zeros(n, dtype=bool)
    emptied[np.argsort(a.fill, kind="stable")[: max(1, n // 20)]] = True
    emptied[rng.integers(0, n, max(1, n // 20))] = True
    return _refit(a.of, np.flatnonzero(emptied[a.of]), lengths, capacity, rng, 0.1)


def evolve(lengths: np.ndarray, capacity: int, seeds: list[np.ndarray], rng: np.random.Generator) -> np.ndarray:
    """The best packing that one island finds in one epoch, as the sequence of each piece."""
    everything, nowhere = np.arange(len(lengths)), np.full(len(lengths), -1, dtype=np.int64)
    people = [Packing(s, lengths, capacity) for s in seeds]
    for k in range(len(people), POPULATION):
        people.append(_refit(nowhere, everything, lengths, capacity, rng, 0.0 if k == 0 else 0.3 * k / POPULATION))
    least = -(-int(lengths.sum()) // capacity)
    for _ in range(GENERATIONS):
        people.sort(key=lambda p: p.fitness, reverse=True)
        if len(people[0].fill) == least:  # no packing has fewer
            break
        a, b = rng.integers(0, len(people), 2).tolist()
        child = crossover(people[a], people[b], lengths, capacity, rng) if a != b else mutate(people[a], lengths, capacity, rng)
        if child.fitness > people[-1].fitness:
            people[-1] = child
        else:
            people[-1] = mutate(people[0], lengths, capacity, rng)
    return max(people, key=lambda p: p.fitness).of


_GENOME = "cell long, island int, lengths binary, genome binary"


def _genome(cell: int, island: int, lengths: np.ndarray, of: np.ndarray) -> pa.Table:
    return pa.table({
        "cell": pa.array([cell], pa.int64()), "island": pa.array([island], pa.int32()),
        "lengths": pa.array([lengths.astype("<i4").tobytes()]), "genome": pa.array([of.astype("<i4").tobytes()]),
    })


def _first_epoch(capacity: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        cell, island = (k.as_py() for k in key)
        table = table.sort_by("spread")
        lengths = table["length"].to_numpy().astype(np.int64)
        return _genome(cell, island, lengths, evolve(lengths, capacity, [], np.random.default_rng((cell, island, 0))))

    return run


def _next_epoch(capacity: int, epoch: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        cell, island = (k.as_py() for k in key)
        lengths = np.frombuffer(table["lengths"][0].as_py(), dtype="<i4").astype(np.int64)
        seeds = [np.frombuffer(g.as_py(), dtype="<i4").astype(np.int64) for g in table["genome"]]
        return _genome(cell, island, lengths, evolve(lengths, capacity, seeds, np.random.default_rng((cell, island, epoch))))

    return run


def _placed(capacity: int):
    def place(key: tuple[pa.Scalar, ...], pieces: pa.Table, genomes: pa.Table) -> pa.Table:
        cell = key[0].as_py()
        pieces = pieces.sort_by("spread")
        lengths = pieces["length"].to_numpy().astype(np.int64)
        short = lengths < capacity
        of = np.empty(len(lengths), dtype=np.int64)
        n = 0
        if genomes.num_rows:
            packings = [Packing(np.frombuffer(g.as_py(), dtype="<i4"), lengths[short], capacity) for g in genomes["genome"]]
            best = max(packings, key=lambda p: p.fitness)
            of[short], n = best.of, len(best.fill)
        of[~short] = np.arange(n, n + int((~short).sum()))
        order = np.lexsort((np.arange(len(of)), of))
        before = np.cumsum(lengths[order]) - lengths[order]
        first = np.concatenate(([True], of[order][1:] != of[order][:-1])) if len(of) else np.zeros(0, dtype=bool)
        offsets = np.empty(len(of), dtype=np.int64)
        offsets[order] = before - np.maximum.accumulate(np.where(first, before, 0))
        out = pieces.drop_columns(["cell", "spread"])
        return out.append_column("sequence_id", pa.array(of + (cell << CELL_SHIFT))).append_column("offset", pa.array(offsets))

    return place


def pack_documents(
    df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = 0,
    cell_docs: int = CELL_DOCS, islands: int = ISLANDS, epochs: int = EPOCHS, keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids as bytes, if kept).

    A document is its ids and ``end_id``. Only longer ones than ``capacity`` are cut, into full pieces after a
    first one that may be shorter. Pieces of a sequence lie gapless from offset 0 and never exceed the capacity.

    Null texts count as empty (``end_id`` alone). Null ids, repeated rows and equal lengths are packed like any
    other row; extra columns are not read. An empty table gives no rows. Texts of any length are taken whole.
    """
    docs = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    piece = _PIECE + (", ids binary" if keep_ids else "")
    cells = F.greatest(F.lit(1).cast("long"), df.select(F.ceil(F.count(F.lit(1)) / cell_docs)).scalar())
    cut = docs.mapInArrow(_pieces(tokenizer, capacity, end_id, keep_ids), piece)
    cut = scratch.written(cut.withColumn("cell", F.pmod(F.xxhash64("spread"), cells)), "pieces")

    each = F.explode(F.sequence(F.lit(0), F.lit(islands - 1)))
    short = cut.where(F.col("length") < capacity).select("cell", "spread", "length")
    found = short.withColumn("island", each).groupBy("cell", "island").applyInArrow(_first_epoch(capacity), _GENOME)
    for epoch in range(1, epochs):
        at_home = F.col("island")
        next_island = ((F.col("island") + 1) % islands).cast("int")
        both = found.withColumn("island", F.explode(F.array_distinct(F.array(at_home, next_island))))
        found = both.groupBy("cell", "island").applyInArrow(_next_epoch(capacity, epoch), _GENOME)
    out = piece.split(", ", 1)[1] + ", sequence_id long, offset long"
    return cut.groupBy("cell").cogroup(found.select("cell", "genome").groupBy("cell")).applyInArrow(_placed(capacity), out)
