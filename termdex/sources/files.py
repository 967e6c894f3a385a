"""Corpus sources: text files or tables, always as ``documents(doc, text)``.

A document is keyed by ``doc``. Several rows may share one ``doc`` (lines of a file,
turns of a conversation, two files with the same basename in different folders);
the index merges their counts, so callers never need to pre-group text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termdex.functions.text import doc_name


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _reader(spark: SparkSession, recursive: bool):
    # Files whose names start with "_" or "." are skipped by Spark's file index.
    return spark.read.option("recursiveFileLookup", str(bool(recursive)).lower())


def read_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    recursive: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """One row per line of every file under ``paths`` -> ``(doc, text)``.

    Large files are split into several tasks by the text source; ``doc`` is the
    decoded basename of the file a line came from. ``partitions`` > 0 spreads the
    lines round-robin first (K5), as the reference's optional argument does.
    """
    df = _reader(spark, recursive).text(_paths(paths))
    df = df.select(doc_name(F.col("_metadata.file_path")).alias("doc"), F.col("value").alias("text"))
    if partitions is not None and partitions > 0:
        df = df.repartition(partitions)
    return df


def read_whole(
    spark: SparkSession,
    paths: str | Sequence[str],
    recursive: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """One row per file -> ``(doc, text)`` (whole file in one row).

    Use for corpora of many small files; ``read_lines`` is the scalable choice for
    large files, and both give the same index (note N6).
    """
    df = _reader(spark, recursive).option("wholetext", "true").text(_paths(paths))
    df = df.select(doc_name(F.col("_metadata.file_path")).alias("doc"), F.col("value").alias("text"))
    if partitions is not None and partitions > 0:
        df = df.repartition(partitions)
    return df


def from_table(df: DataFrame, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Adapt any table to ``(doc, text)``; only the two columns are read."""
    return df.select(F.col(doc_col).alias("doc"), F.col(text_col).alias("text"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one of the driver's Parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
