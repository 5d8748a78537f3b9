"""Language ID: a bidirectional GRU over bytes labels every position; a document pools its positions' probabilities.

The network learns on the driver from a bounded, balanced sample of labelled rows: of each language the
``per_language`` documents with the smallest hashes, and of each of these up to ``SPANS`` spans of text. Prediction
runs in the tasks, over whole texts; its only input is the text. The network's state starts anew every ``WINDOW`` bytes
(`byte_gru.py`), in training and prediction alike: a byte's label depends on the bytes of its window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tariff_engine.llm.byte_gru import LANES, WINDOW, ByteGru, train, windows

#: Bound of the training sample: documents of each language. Every language that occurs is learned.
PER_LANGUAGE = 512
SPANS = 3
#: A language's rows are thinned by their hashes to about this many times its sample, of which the first are taken.
SPARE = 4

UNKNOWN = "und"


def training_sample(df: DataFrame, text: Column, lang: Column, order: Column, per_language: int) -> DataFrame:
    """lang, spans: a bounded sample of the labelled rows with a text; the spans reach from its start to its end."""
    last = F.greatest(F.length("text") - WINDOW, F.lit(0))
    rows = df.select(text.alias("text"), lang.alias("lang"), F.xxhash64(order).alias("place")).where(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.length("text") > 0)
    )
    span = lambda k: F.substring("text", (F.floor(last * k / (SPANS - 1)) + 1).cast("int"), F.lit(WINDOW))
    spans = rows.select("lang", "place", F.array(*[span(k) for k in range(SPANS)]).alias("spans"))
    # one row a language, as the network has an output for each
    counts = F.broadcast(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")))
    steps = 1 << 30
    thinned = spans.join(counts, "lang").where(F.pmod("place", F.lit(steps)) / F.lit(steps) < SPARE * per_language / F.col("n"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("place", "spans"))
    return thinned.withColumn("no", first).where(F.col("no") <= per_language).select("lang", "spans")


class LanguageModel:
    """A trained network with its languages."""

    def __init__(self, net: ByteGru | None, languages: list[str]) -> None:
        self.net, self.languages = net, languages

    @classmethod
    def fit(cls, sample: DataFrame) -> LanguageModel:
        rows = sorted((r["lang"], s) for r in sample.collect() for s in set(r["spans"]) if s)
        languages = sorted({lang for lang, _ in rows})
        if not languages:
            return cls(None, [])
        pieces = [(windows(s.encode("utf-8")), languages.index(lang)) for lang, s in rows]
        x = np.concatenate([w for w, _ in pieces])
        y = np.repeat([k for _, k in pieces], [len(w) for w, _ in pieces])
        return cls(train(x, y, len(languages)), languages)

    def position_labels(self, texts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
        """For each text the class of every byte, and the mean probabilities over its bytes."""
        cut = [windows(t) for t in texts]
        of = np.repeat(np.arange(len(texts)), [len(w) for w in cut])
        sums = np.zeros((len(texts), len(self.languages)))
        labels = []
        kind = np.dtype(np.min_scalar_type(max(0, len(self.languages) - 1))).newbyteorder("<")
        x = np.concatenate(cut) if cut else np.empty((0, WINDOW), dtype=np.int16)
        for low in range(0, len(x), LANES):
            part = x[low:low + LANES]
            p = self.net.probabilities(part)
            real = part.T < 256
            np.add.at(sums, of[low:low + LANES], (p * real[:, None]).sum(axis=0).T)
            labels.append(p.argmax(axis=1).astype(kind).T)
        flat = np.concatenate(labels).reshape(-1) if labels else np.empty(0, dtype=kind)
        starts = WINDOW * np.concatenate(([0], np.cumsum([len(w) for w in cut])[:-1])).astype(np.int64) if cut else []
        lengths = [len(t) for t in texts]
        means = sums / np.maximum(1, np.asarray(lengths))[:, None]
        return [flat[s:s + n] for s, n in zip(starts, lengths)], means


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


#: Bytes of text that go through the network together.
_STEP_BYTES = 1 << 20


def detect_language(df: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", keep_labels: bool = False, carry: bool = False) -> DataFrame:
    """One row per input row: doc_id, lang_pred, score, and with ``keep_labels`` the class index of every byte
    (unsigned, little-endian, of one byte each with up to 256 languages, of two or four with more).

    ``score`` is the mean probability of the predicted language over all bytes. Null texts, texts without a
    letter, and a model that learned from no labelled row give ``und`` with score 0. Ties go to the language
    that sorts first. Null ids, repeated rows and extra columns pass (``carry`` returns all columns as ``row``);
    an empty table gives no rows. Texts of any length are read whole.
    """
    row = [F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")] if carry else []
    docs = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), *row)
    names = ["doc_id", "lang_pred", "score"] + ["labels"] * keep_labels + ["row"] * carry
    fields = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = f"doc_id {fields['doc_id']}, lang_pred string, score double" + ", labels binary" * keep_labels
    if carry:
        schema += f", row {docs.schema['row'].dataType.simpleString()}"

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = list(_answers(model, batch.column(1).to_pylist()))
            columns = [batch.column(0), pa.array([f[0] for f in found]), pa.array([f[1] for f in found], pa.float64())]
            if keep_labels:
                columns.append(pa.array([f[2] for f in found], pa.binary()))
            if carry:
                columns.append(batch.column(2))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(predict, schema)


def _answers(model: LanguageModel, texts: list[str | None]) -> Iterator[tuple[str, float, bytes]]:
    """(language, score, labels) of each text, in order; a bounded number of bytes at a time."""
    held: list[bytes | None] = []
    size = 0

    def flush() -> Iterator[tuple[str, float, bytes]]:
        labels, means = model.position_labels([h for h in held if h is not None]) if any(h is not None for h in held) else ([], [])
        at = 0
        for h in held:
            if h is None:
                yield UNKNOWN, 0.0, b""
            else:
                best = int(means[at].argmax())
                yield model.languages[best], min(1.0, float(means[at][best])), labels[at].tobytes()
                at += 1

    for text in texts:
        held.append(text.encode("utf-8") if model.net is not None and _has_letter(text) else None)
        size += len(held[-1] or b"")
        if size >= _STEP_BYTES:
            yield from flush()
            held, size = [], 0
    if held:
        yield from flush()
