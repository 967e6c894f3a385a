"""The corpus pipeline: five stages from raw documents to piece ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its rows are written as
Parquet and read again as the next stage's ``docs``. All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termdex.llm import decontaminate, langid, neardup, pieces, pii
from termdex.llm.common import saved
from termdex.sources.files import read_table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that are in one of the languages of the labelled rows."""
    model = langid.learn(docs)
    return docs.filter(langid.accepted(spark, model, F.col("text")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: the one with the smallest id.

    Rows of one id are one document, of which one row stays. Rows without an id stay.
    """
    copies = neardup.near_duplicates(docs).filter(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    rest = docs.join(saved(copies, "copies"), "doc_id", "left_anti")
    repeated = saved(docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated")
    if repeated.isEmpty():
        return rest.select(*docs.columns)
    once = rest.join(repeated, "doc_id", "left_anti")
    return once.union(rest.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that cover a benchmark item."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by tags."""
    return pii.redact(docs, pii.fit(docs))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document."""
    ids = pieces.encode(spark, pieces.public_model(), F.col("text"))
    return docs.select("doc_id", "lang", "source", ids.alias("ids")).withColumn("n_pieces", F.size("ids").cast("long"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("sentencepiece", sentencepiece),
]

# Stages 1, 2, 4 and 5 are models, an iteration and a coding that SQL can't state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
