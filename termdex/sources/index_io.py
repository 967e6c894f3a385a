"""Index sinks and readers: Parquet postings (primary) and the text line form.

Parquet (K7): postings range-partitioned and sorted by (term, doc), so each file
and row group covers a narrow term range and a ``term IN (...)`` filter skips the
rest (S7). Range bounds include ``doc``, so one very common term is spread over
several files instead of landing in one task.

Text (K1-K4): one line per (term, doc block), in one of four part layouts:

- ``hash``   K1 + K2: parts hash-partitioned by (term, block), lines sorted within each part.
- ``round``  K3: lines spread round-robin over the parts.
- ``range``  contiguous term ranges of about equal size, sorted.
- ``exact``  K4: all lines in order, cut after every ceil(lines / parts) lines.

Beside a text index lies a manifest (``write_manifest``): first and last term, lines and bytes of
every part, so that a search opens only the parts that can hold one of its words.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from termdex.functions.text import TAB_SEP, WHITESPACE_CLASS
from termdex.operators.index import DEFAULT_BLOCK_BITS, dealt, merge_postings, sized_blocks, task_count
from termdex.operators.lines import line_rows, parse_lines
from termdex.plans.inspect import exchanges
from termdex.session import exists, staged

LAYOUTS = ("hash", "round", "range", "exact")
# The manifest's folder inside a text index; readers of the index skip names with an underscore.
MANIFEST = "_manifest"


class BuildReport(NamedTuple):
    """What a text build wrote, measured by the writing job itself."""

    terms: int
    occurrences: int
    postings: int
    lines: int
    bytes: int


def write_index(post: DataFrame, path: str, parts: int | None = None, mode: str = "errorifexists") -> None:
    """K7: write postings as Parquet sorted by (term, doc).

    The ranges are drawn by a pass of its own over the rows. So a build (postings whose plan has a shuffle) is
    stored first and counts nothing twice; its rows are known then, and ranges hold about as many each.
    """
    df = post.select("term", "doc", "tf")
    if not post.is_cached and exchanges(post):
        df = staged(df, "postings")
        parts = parts or task_count(df)
    df = df.repartitionByRange(parts, "term", "doc") if parts else df.repartitionByRange("term", "doc")
    df.sortWithinPartitions("term", "doc").write.mode(mode).parquet(path)


def write_merged(parts: Sequence[DataFrame], path: str, n_parts: int | None = None, mode: str = "errorifexists") -> None:
    """A5 + K7: merge stored indexes into one, written as ``write_index`` does.

    The rows move once, to their range of (term, doc), and counts add up there; the ranges are drawn
    over the stored rows, so no merge runs twice for them.
    """
    rows = reduce(lambda a, b: a.unionByName(b), (p.select("term", "doc", "tf") for p in parts))
    rows = rows.repartitionByRange(n_parts, "term", "doc") if n_parts else rows.repartitionByRange("term", "doc")
    merge_postings(rows).sortWithinPartitions("term", "doc").write.mode(mode).parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Read a Parquet postings index -> ``(term, doc, tf)``."""
    return spark.read.parquet(path).select("term", "doc", "tf")


def _exact_chunks(lines: DataFrame, parts: int) -> DataFrame:
    """K4: the lines in (term, block) order, ``ceil(lines / parts)`` in every partition (the last ones fewer).

    ``lines`` lie in ranges of terms. They are sorted once into a table. A line's number is its place in
    its range plus the lines of the ranges before, one count for each of which reaches the driver.
    """
    ranged = lines.sortWithinPartitions("term", "block")
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    ranged = staged(ranged.withColumns({"range": F.spark_partition_id(), "place": place}), "exact-lines")
    before, total = [], 0
    for r, n in sorted(ranged.groupBy("range").count().collect()):
        before.append((r, total))
        total += n
    starts = lines.sparkSession.createDataFrame(before, "range int, before long")
    size = max(1, -(-total // parts))
    numbered = ranged.join(F.broadcast(starts), "range").withColumn("number", F.col("before") + F.col("place"))
    chunk = F.floor(F.col("number") / size).cast("int")
    return numbered.withColumn("chunk", chunk).repartitionById(parts, F.col("chunk")).sortWithinPartitions("number")


def write_text_index(
    post: DataFrame,
    path: str,
    parts: int | None = None,
    sep: str = TAB_SEP,
    layout: str = "hash",
    block_bits: int = DEFAULT_BLOCK_BITS,
    mode: str = "errorifexists",
    max_docs: int | None = None,
    stored: bool = False,
    manifest: bool | None = None,
) -> BuildReport:
    """K1-K4 with P6-P8: write the index as text lines; ``max_docs`` and ``stored`` as in ``with_block``.

    ``parts=None`` keeps the shuffle's own partitioning (no extra exchange for
    ``hash``). The default save mode refuses an existing output, as the Hadoop and
    Spark sinks do. The report's numbers are observed by the write itself, without
    another pass. A manifest is written for the layouts with contiguous terms unless
    ``manifest`` says otherwise.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    if layout == "exact" and not parts:
        raise ValueError("layout exact needs the number of parts")
    cut, heavy, tasks = sized_blocks(post, block_bits, max_docs, stored)
    # postings that move to a range of terms become lines there: ranges are drawn over the postings, and nothing
    # is built twice for them; a given number of ranges is drawn over the lines, which any number of tasks builds
    ranged = layout == "exact" or layout == "range" and not parts
    lines = line_rows(dealt(cut, heavy, tasks, ranged), sep)
    if layout == "hash":
        if parts:
            # by (term, block): the lines of one very common term spread over the parts
            lines = lines.repartition(parts, "term", "block")
        lines = lines.sortWithinPartitions("term", "block")
    elif layout == "round":
        if parts:
            lines = lines.repartition(parts)
    elif layout == "range":
        lines = lines if ranged else lines.repartitionByRange(parts, "term", "block")
        lines = lines.sortWithinPartitions("term", "block")
    else:
        lines = _exact_chunks(lines, parts)
    seen = Observation()
    count = lambda c: F.coalesce(F.sum(c), F.lit(0))
    lines.observe(
        seen,
        count((F.col("block") == 0).cast("long")).alias("terms"),
        count("occurrences").alias("occurrences"),
        count("entries").alias("postings"),
        F.count(F.lit(1)).alias("lines"),
        count(F.octet_length("line") + 1).alias("bytes"),
    ).select("line").write.mode(mode).text(path)
    if manifest or (manifest is None and layout in ("range", "exact")):
        write_manifest(post.sparkSession, path)
    # whole lists are seen one by one; cut ones were counted when they were found
    return BuildReport(**seen.get | {"terms": seen.get["terms"] + heavy})


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines of every part file under ``path`` -> ``(value)``."""
    return spark.read.option("recursiveFileLookup", "true").text(path)


def read_text_index(spark: SparkSession, path: str) -> DataFrame:
    """Parse every part file -> ``(term, doc string, tf bigint)``.

    A term found in several lines or parts keeps all its entries (union, 2.4).
    """
    return parse_lines(read_text_lines(spark, path))


def filter_text_lines(lines: DataFrame, terms: list[str], col: str = "value") -> DataFrame:
    """S7 for text: keep only lines whose first word is one of ``terms``.

    Only the first word is cut out, so the long tail of each line is split just for
    the lines that survive.
    """
    return lines.filter(_first_word(F.col(col)).isin(terms))


# -- parts -----------------------------------------------------------------------------


def _first_word(col: Column) -> Column:
    return F.regexp_extract(col, f"^[{WHITESPACE_CLASS}]*([^{WHITESPACE_CLASS}]+)", 1)


def _plain(file: Column) -> Column:
    """A file's path as it is spelled, from the URL-encoded form that Spark gives."""
    return F.coalesce(F.try_url_decode(F.replace(file, F.lit("+"), F.lit("%2B"))), file)


def _tail(file: Column, path: str) -> Column:
    """A file's path below ``path``; scheme and host of either do not matter."""
    folder = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path).rstrip("/") + "/"
    return F.substring(_plain(file), F.locate(folder, _plain(file)) + len(folder), F.length(_plain(file)))


def _part_rows(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, place, term, bytes`` of every line with a term, in no order."""
    lines = read_text_lines(spark, path).select(
        _tail(F.col("_metadata.file_path"), path).alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        _first_word(F.col("value")).alias("term"),
        (F.octet_length("value") + 1).cast("long").alias("bytes"),
    )
    return lines.filter(F.col("term") != "")


def inspect_parts(spark: SparkSession, path: str) -> DataFrame:
    """K2 + K6: ``file, lines, bytes, first, last, in_order`` of every part file of a text index.

    A file is in order if no line's term is smaller than that of the line before it. Lines
    are compared inside each block of a file (a task reads a block from top to bottom), then
    each block with the one before it, so no task holds more than a block.
    """
    rows = _part_rows(spark, path)
    up = F.lag("term").over(Window.partitionBy("file", "block").orderBy("place"))
    blocks = (
        rows.withColumn("down", F.coalesce(F.col("term") < up, F.lit(False)))
        .groupBy("file", "block")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum("bytes").alias("bytes"),
            F.min("term").alias("first"),
            F.max("term").alias("last"),
            F.min_by("term", "place").alias("top"),
            F.max_by("term", "place").alias("bottom"),
            F.bool_or("down").alias("down"),
        )
    )
    above = F.lag("bottom").over(Window.partitionBy("file").orderBy("block"))
    joined = blocks.withColumn("down", F.col("down") | F.coalesce(F.col("top") < above, F.lit(False)))
    return joined.groupBy("file").agg(
        F.sum("lines").alias("lines"),
        F.sum("bytes").alias("bytes"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        (~F.bool_or("down")).alias("in_order"),
    )


def write_manifest(spark: SparkSession, path: str, mode: str = "errorifexists") -> None:
    """Write ``file, lines, bytes, first, last`` of every part of a text index (any writer's) beside its parts.

    One scan of the index that cuts out first words only; map-side counts leave a row for
    each (task, file).
    """
    parts = _part_rows(spark, path).groupBy("file").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("bytes").alias("bytes"), F.min("term").alias("first"), F.max("term").alias("last")
    )
    parts.coalesce(1).sortWithinPartitions("first").write.mode(mode).parquet(f"{path.rstrip('/')}/{MANIFEST}")


def manifest_files(spark: SparkSession, path: str, terms: list[str]) -> list[str] | None:
    """Part files of a text index that can hold a line of one of ``terms``; null if there is no manifest.

    The manifest's rows are filtered where they are; the driver gets the names of the files
    that a search opens. A part that the manifest does not know (one added later) is
    always among them; one that is gone is not.
    """
    root = path.rstrip("/")
    if not exists(spark, f"{root}/{MANIFEST}/_SUCCESS"):
        return None
    manifest = spark.read.parquet(f"{root}/{MANIFEST}")
    there = read_text_lines(spark, root).inputFiles()
    names = spark.createDataFrame([(f,) for f in there], "path string")
    named = names.select(_plain(F.col("path")).alias("path"), _tail(F.col("path"), root).alias("file"))
    asked = F.lit(False)
    for t in terms:
        asked = asked | F.lit(t).between(F.col("first"), F.col("last"))
    hit = named.join(manifest, "file", "left").filter(F.col("first").isNull() | asked)
    return [r.path for r in hit.select("path").collect()]
