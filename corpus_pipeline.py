"""A corpus pipeline over `documents`: language ID, exact dedup, near-duplicate join, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and reread as the
next stage's docs. All but the last return the columns of `documents`, whatever further columns these are.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariff_engine.llm import scratch
from tariff_engine.llm.exact_dedup import exact_dedup
from tariff_engine.llm.lang_id import PER_LANGUAGE, UNKNOWN, LanguageModel, detect_language, training_sample
from tariff_engine.llm.packing import pack_documents
from tariff_engine.llm.shingle_join import shingle_join

#: How far a document's best language has to be above chance (1 / languages), as a share of the way to certainty.
#: Only texts that no language explains stay below, however many languages there are.
ABOVE_CHANCE = 1 / 15


def least_score(languages: int) -> float:
    """The mean probability below which a document has no language; 0.3 with four languages."""
    chance = 1 / max(1, languages)
    return chance + (1 - chance) * ABOVE_CHANCE - 1e-9


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: no text, no letter, or no language of at least `least_score`.

    Each row is judged by its own text alone, read whole whatever its length: rows that are repeated or share an id stay or
    go each for itself. With no labelled row at all nothing can be known, and all documents go. An empty table gives none.
    """
    sample = training_sample(docs, F.col("text"), F.col("lang"), F.col("doc_id"), PER_LANGUAGE)
    model = LanguageModel.fit(sample)
    found = detect_language(docs, model, carry=True)
    known = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score(len(model.languages)))
    return found.where(known).select("row.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts (A-Z lower-cased), the one with the largest doc_id stays.

    Of rows that tie on it (a repeated row, or an id with equal texts) exactly one stays; other texts of that id are not
    touched. Null ids sort below all others; null and empty texts are equal. Whole texts are compared. An empty table gives none.
    """
    return exact_dedup(docs, carry=True).where("kept").select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that five-word shingles link at 0.75 or more, the one with the smallest doc_id stays (null ids last).

    Rows are decided each for itself: of an id that several texts share, only the rows that are near copies go, and of
    rows that tie on the smallest id (repeated rows) the one read first stays. Documents without words stay.
    Whole texts are compared, whatever their length. An empty table gives none.
    """
    # numbered once and written, as another pass may split the files otherwise
    numbered = scratch.written(docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.monotonically_increasing_id().alias("row")), "numbered")
    rows = numbered.select("row", F.col("doc.doc_id").alias("id"), F.col("doc.text").alias("text"))
    joined = shingle_join(rows, "row").documents.select(F.col("doc_id").alias("row"), "component_id")
    placed = joined.join(rows.select("row", "id"), "row")
    stays = placed.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first"))
    gone = placed.join(stays, "component_id").where(F.col("row") != F.col("first.row")).select(F.col("row").alias("gone"))
    return numbered.join(gone, F.col("row") == F.col("gone"), "left_anti").select("doc.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: one row per piece of a document.

    Repeated rows and rows that share an id are documents of their own; null and empty texts hold the end id alone; longer
    texts than a sequence are cut. An empty table gives none.
    """
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language ID", known_language),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("best-fit packing", packed),
]

#: The language and packing stages are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{scratch.shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{base}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
