"""Token ids as flat unsigned integer files with 64-bit document offsets, for memory-mapped reading.

Layout of a folder, one set of files for each range of document ids (parts in ascending order):

* ``part-00000.tokens``   ids, unsigned 16 or 32 bit, little-endian, no header
* ``part-00000.docs``     document ids, signed 64 bit (0 for null ids, which come first; the manifest counts them)
* ``part-00000.lengths``  ids of each document, unsigned 64 bit
* ``part-00000.offsets``  ids of all documents before each one, over all parts, unsigned 64 bit
* ``manifest.json``       type of the ids; documents, ids and base of each part

A range shuffle puts documents in order, each task streams its part to a temporary name and renames it, the
parts' totals (one row each) give every part's base as a prefix sum, and a second pass writes the offsets. A task
that runs again writes the same files. The folder must be mounted on every machine, as memory maps ask for.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariff_engine.llm import scratch
from tariff_engine.llm.encoding import word_encoder

#: Documents that one reading step hands on at once.
READ_DOCS = 1024

_PART = "part long, docs long, null_docs long, tokens long"


def _name(folder: str, part: int, kind: str) -> str:
    return os.path.join(folder, f"part-{part:05d}.{kind}")


class _Atomic:
    """A file that appears under its name only when whole."""

    def __init__(self, path: str) -> None:
        self.path, self.draft = path, f"{path}.{uuid.uuid4().hex}"
        self.file = open(self.draft, "wb")

    def commit(self) -> None:
        self.file.close()
        os.replace(self.draft, self.path)


def _write_part(folder: str, tokenizer: str, end_id: int, id_type: str) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        part = TaskContext.get().partitionId()
        end = np.asarray([end_id], dtype="<u4").tobytes()
        tokens = None
        docs, lengths, nulls, total = [], [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if tokens is None:
                tokens = _Atomic(_name(folder, part, "tokens"))
            ids = [x + end for x in encoder.encode(batch.column(1).to_pylist())]
            tokens.file.write(np.frombuffer(b"".join(ids), dtype="<u4").astype(id_type).tobytes())
            lengths.append(np.fromiter((len(x) // 4 for x in ids), dtype="<u8", count=len(ids)))
            column = batch.column(0)
            nulls += column.null_count
            docs.append(np.asarray(column.fill_null(0).to_numpy(zero_copy_only=False), dtype="<i8"))
        if tokens is None:
            return
        for kind, arrays in (("docs", docs), ("lengths", lengths)):
            file = _Atomic(_name(folder, part, kind))
            file.file.write(np.concatenate(arrays).tobytes())
            file.commit()
        tokens.commit()
        total = int(sum(int(x.sum()) for x in lengths))
        yield pa.RecordBatch.from_pydict(
            {"part": [part], "docs": [sum(map(len, docs))], "null_docs": [nulls], "tokens": [total]}
        )

    return write


def _write_offsets(folder: str) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.fromfile(_name(folder, row["part"], "lengths"), dtype="<u8")
                offsets = np.cumsum(lengths, dtype="<u8") - lengths + np.uint64(row["base"])
                file = _Atomic(_name(folder, row["part"], "offsets"))
                file.file.write(offsets.astype("<u8").tobytes())
                file.commit()
                yield pa.RecordBatch.from_pydict({"part": [row["part"]]})

    return write


@dataclass(frozen=True)
class TokenFiles:
    """A written folder."""

    folder: str
    id_type: str
    parts: tuple[dict, ...]

    @classmethod
    def open(cls, folder: str) -> TokenFiles:
        with open(os.path.join(folder, "manifest.json"), encoding="utf-8") as f:
            manifest = json.load(f)
        return cls(folder, manifest["id_type"], tuple(manifest["parts"]))

    def maps(self, part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Memory maps of a part: ids, document ids, lengths, offsets."""
        kinds = (("tokens", self.id_type), ("docs", "<i8"), ("lengths", "<u8"), ("offsets", "<u8"))
        return tuple(np.memmap(_name(self.folder, part, kind), dtype=dtype, mode="r") for kind, dtype in kinds)

    def scan(self, spark: SparkSession, digest: Callable[[np.ndarray], object], schema: str, arrow: pa.DataType) -> DataFrame:
        """One row per document: doc_id, start, n_tokens and ``digest`` of its ids; ``schema`` names its column."""
        rows = [(p["part"], p["null_docs"], p["base"]) for p in self.parts]
        at = spark.createDataFrame(rows, "part long, null_docs long, base long").repartition(max(1, len(rows)), "part")

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    tokens, docs, lengths, offsets = self.maps(row["part"])
                    for low in range(0, len(docs), READ_DOCS):
                        n = min(READ_DOCS, len(docs) - low)
                        starts = offsets[low:low + n].astype(np.int64)
                        sizes = lengths[low:low + n].astype(np.int64)
                        local = (starts - row["base"]).tolist()
                        digests = [digest(tokens[a:a + s]) for a, s in zip(local, sizes.tolist())]
                        null = np.arange(low, low + n) < row["null_docs"]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(docs[low:low + n], mask=null), pa.array(starts), pa.array(sizes), pa.array(digests, arrow)],
                            names=["doc_id", "start", "n_tokens", "digest"],
                        )

        out = at.mapInArrow(read, f"doc_id long, start long, n_tokens long, digest {schema.split(' ', 1)[1]}")
        return out.withColumnRenamed("digest", schema.split(" ", 1)[0])

    def documents(self, spark: SparkSession) -> DataFrame:
        """doc_id, start, n_tokens, ids (array of long) of every document."""
        return self.scan(spark, lambda ids: ids.astype(np.int64), "ids array<long>", pa.list_(pa.int64()))


def write_token_files(
    df: DataFrame, tokenizer: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1
) -> TokenFiles:
    """Encode every text, append ``end_id``, and write the ids in ascending order of document id.

    Null texts count as empty (``end_id`` alone). Null ids come first; rows that repeat an id follow each other in
    no fixed order. An empty table gives a manifest without parts. Extra columns are not read. Texts of any length
    are encoded whole; a task holds one Arrow batch at a time.
    """
    spark = df.sparkSession
    folder = scratch.mounted(folder or f"{scratch.shared_folder(spark)}/tokens-{uuid.uuid4().hex}")
    os.makedirs(folder)
    id_type = "<u2" if max(word_encoder(tokenizer).vocabulary - 1, end_id) < 1 << 16 else "<u4"
    docs = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    in_order = docs.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    written = in_order.mapInArrow(_write_part(folder, tokenizer, end_id, id_type), _PART)
    base, parts = 0, []
    for row in sorted(written.collect()):  # one row a part
        parts.append(row.asDict() | {"base": base})
        base += row.tokens
    if parts:
        rows = spark.createDataFrame([(p["part"], p["base"]) for p in parts], "part long, base long")
        rows.repartition(len(parts), "part").mapInArrow(_write_offsets(folder), "part long").count()
    manifest = _Atomic(os.path.join(folder, "manifest.json"))
    manifest.file.write(json.dumps({"id_type": id_type, "parts": parts}).encode())
    manifest.commit()
    return TokenFiles(folder, id_type, tuple(parts))
