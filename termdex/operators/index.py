"""Index build: documents -> tokens -> postings -> grouped postings, plus merge and stats.

The flat ``postings(term, doc, tf)`` table is the index. It has one row per
(term, document) pair, so no row grows with the corpus, and every later step
(search, text lines, statistics, merging) reads it. A grouped form with all of a
term's documents in one row is only built in bounded blocks (see ``with_block``).

Plan shape of ``postings`` (checked in ``tests/test_plans.py``)::

    Scan parquet [doc, text] -> Generate explode -> HashAggregate (partial count)
      -> Exchange hashpartitioning(term, doc) -> HashAggregate (final count)

The partial aggregate below the exchange is Spark's built-in map-side combine, the
counterpart of the reference's combiner and in-mapper combining (A2, A4); it spills
by itself, so no heap threshold is needed.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termdex.functions.text import raw_terms
from termdex.session import staged

# log2 of the documents per posting block: a term with at most 2**20 documents has one
# grouped row or text line; a longer list is cut into rows of about that many.
DEFAULT_BLOCK_BITS = 20
# A side of a join is broadcast only if its counted bytes are within this.
MAX_BROADCAST_BYTES = 128 << 20
# Bytes that a broadcast row takes besides its strings.
ROW_BYTES = 32
# Bytes of a scan that one task tokenises and combines, about, where the input is spread.
SPREAD_BYTES = 16 << 20
# Rows of a document's key, at most, where its texts move to one task (``few_rows``).
MAX_DOC_ROWS = 64
# Postings of a stored build that one task sorts or collects, about.
TASK_POSTINGS = 1 << 19


def keyed(doc: Column | str) -> Column:
    """A document key that must not be null: a null one fails the job (for every builder and search)."""
    doc = F.col(doc) if isinstance(doc, str) else doc
    return F.when(doc.isNull(), F.raise_error(F.lit("null document key"))).otherwise(doc)


def spread(df: DataFrame, partitions: int | str | None = "auto") -> DataFrame:
    """K5: optionally spread rows round-robin over more tasks before heavy work.

    ``None``/``0`` leaves the scan as it is; an int repartitions to that count;
    ``"auto"`` is for plain scans: it repartitions when the scan has fewer splits
    than the cluster has task slots (a single large Parquet row group is read by one
    task), or when its splits may be longer than ``SPREAD_BYTES``. The map-side combine keeps
    a row for each of its task's postings, so a long split fills the memory that the task
    can get, then spills and sorts; moving the texts once costs less. A scan of many short
    splits is left as it is. Plans that shuffle already should be given ``None``.
    """
    if partitions is None or partitions == 0:
        return df
    if partitions == "auto":
        splits, tasks = partition_count(df), spread_tasks(df)
        return df if splits == tasks else df.repartition(tasks)
    return df.repartition(int(partitions))


def spread_tasks(df: DataFrame) -> int:
    """Tasks for a plain scan: a slot each at least, and about ``SPREAD_BYTES`` of the scan each at most."""
    pieces = -(-split_bytes(df.sparkSession) // SPREAD_BYTES)
    return max(df.sparkSession.sparkContext.defaultParallelism, partition_count(df) * pieces)


def few_rows(docs: DataFrame, most: int = MAX_DOC_ROWS) -> bool:
    """Whether no document has more than ``most`` rows; counted from the key column alone."""
    return docs.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most).isEmpty()


def task_count(stored: DataFrame) -> int | None:
    """Tasks that sort or collect the postings of a stored table, ``TASK_POSTINGS`` each; its rows are counted from footers.

    Without a number a shuffle has ``spark.sql.shuffle.partitions`` tasks, which grow with the input
    until they spill. Null if there are fewer than task slots: such a shuffle is left to the planner.
    """
    n = -(-stored.count() // TASK_POSTINGS)
    return n if n >= stored.sparkSession.sparkContext.defaultParallelism else None


def split_bytes(spark: SparkSession) -> int:
    """Bytes of a scan's split, at most on average (``spark.sql.files.maxPartitionBytes``)."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)i?b?\s*", spark.conf.get("spark.sql.files.maxPartitionBytes").lower()).groups()
    return max(1, int(number)) << 10 * " kmgtp".index(unit or " ")


def partition_count(df: DataFrame) -> int:
    """K6: number of partitions of a DataFrame (of a scan: its splits; no job is run for those)."""
    return df.rdd.getNumPartitions()


def tokens(docs: DataFrame, partitions: int | str | None = None) -> DataFrame:
    """One row per term occurrence -> ``(doc, term)``.

    ``partitions`` spreads the documents before tokenising (see ``spread``).
    """
    return _occurrences(spread(_texts(docs), partitions))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(keyed("doc").alias("doc"), "text")


def _occurrences(texts: DataFrame) -> DataFrame:
    occ = texts.select("doc", F.explode(raw_terms("text")).alias("term"))
    return occ.select("doc", F.lower("term").alias("term"))


def postings(docs: DataFrame, partitions: int | str | None = None, by_doc: bool = False) -> DataFrame:
    """A1: count each term per document -> ``(term, doc, tf bigint)``.

    Rows of the same ``doc`` anywhere in the input add up, so lines of one file,
    turns of one conversation and same-named files all merge (section 1, N6).

    ``by_doc`` is for builds of plain scans whose documents have ``few_rows`` each: their texts move to
    the document's task and are counted there, so that the texts move and the larger postings do not
    (``partitions`` is not used).
    """
    if by_doc:
        # the key is checked before the texts move: a key computed again would not count as dealt out
        occ = _occurrences(_texts(docs).repartition(spread_tasks(docs), "doc"))
    else:
        occ = tokens(docs, partitions)
    return (
        occ.groupBy("term", "doc")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def merge_postings(*parts: DataFrame) -> DataFrame:
    """A5: merge partial indexes; counts of the same (term, doc) add up.

    The parts' pairs are unique, so all of them move in the one shuffle: merge when many
    increments have gathered (``streaming.ingest.compact``), not for each.
    """
    if not parts:
        raise ValueError("merge_postings needs at least one index")
    union = reduce(lambda a, b: a.unionByName(b), (p.select("term", "doc", "tf") for p in parts))
    return union.groupBy("term", "doc").agg(F.sum("tf").cast("bigint").alias("tf"))


def stats(post: DataFrame) -> DataFrame:
    """A6 + A7: ``(num_terms, tot_terms)`` = distinct terms and total occurrences.

    Summing per term first lets the partial aggregate collapse each term per map
    task, so the shuffle carries at most one row per (task, term).
    """
    per_term = post.groupBy("term").agg(F.sum("tf").alias("occ"))
    return per_term.agg(
        F.count(F.lit(1)).alias("num_terms"),
        F.coalesce(F.sum("occ"), F.lit(0)).cast("bigint").alias("tot_terms"),
    )


def heavy_terms(post: DataFrame, size: int) -> DataFrame:
    """``(term, parts)`` of the terms with more than ``size`` documents: the blocks that each is cut into."""
    df = post.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return df.filter(F.col("df") > size).select("term", F.ceil(F.col("df") / size).alias("parts"))


def blocks(
    post: DataFrame,
    block_bits: int = DEFAULT_BLOCK_BITS,
    max_docs: int | None = None,
    stored: bool = False,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> tuple[DataFrame, int]:
    """``with_block``, and the number of terms whose lists are cut."""
    return sized_blocks(post, block_bits, max_docs, stored, max_broadcast_bytes)[:2]


def sized_blocks(
    post: DataFrame,
    block_bits: int = DEFAULT_BLOCK_BITS,
    max_docs: int | None = None,
    stored: bool = False,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> tuple[DataFrame, int, int | None]:
    """``blocks``, and the ``task_count`` of what was stored to count the lists (null if nothing was)."""
    size, tasks = 1 << block_bits, None
    if max_docs is None or max_docs > size:
        if not stored:
            post = staged(post.withColumn("doc", keyed("doc")), "postings")
        tasks = task_count(post)
        heavy = staged(heavy_terms(post, size), "heavy-terms")
        n, sent = heavy.agg(F.count(F.lit(1)), F.sum(F.octet_length("term") + ROW_BYTES)).first()
        if n:
            heavy = F.broadcast(heavy) if sent <= max_broadcast_bytes else heavy.hint("merge")
            digest = F.conv(F.substring(F.md5(F.col("doc").cast("string")), 1, 8), 16, 10).cast("bigint")
            block = F.when(F.col("parts").isNull(), F.lit(0)).otherwise(F.pmod(digest, F.col("parts")) + 1).cast("bigint")
            cut = post.join(heavy, "term", "left").withColumn("doc", keyed("doc")).withColumn("block", block).drop("parts")
            return cut, n, tasks
    return post.withColumn("doc", keyed("doc")).withColumn("block", F.lit(0).cast("bigint")), 0, tasks


def with_block(
    post: DataFrame,
    block_bits: int = DEFAULT_BLOCK_BITS,
    max_docs: int | None = None,
    stored: bool = False,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``post`` plus a ``block`` column: 0 for every term with at most ``2**block_bits`` documents.

    Only a longer list is cut, by a hash of the document, into the fewest blocks of that
    many documents on average (numbered from 1), so the result depends on neither the key's
    type nor the partitioning.

    A list is no longer than the number of documents, so where the caller knows that there
    are no more than ``max_docs`` and this is within a block, nothing has to be counted.
    Otherwise the build runs once, into a table (unless ``post`` is ``stored`` already);
    the heavy terms are counted from that table's term column, and the lines read the
    table too. So the corpus is read and tokenised by one stage, whatever the planner makes
    of two readers. The heavy terms are broadcast if their counted bytes are within the limit,
    else joined by a shuffle.
    """
    return blocks(post, block_bits, max_docs, stored, max_broadcast_bytes)[0]


def block_keys(heavy: int) -> list[str]:
    """Columns that a row's block is grouped by: the block is a constant where no list is cut."""
    return ["term", "block"] if heavy else ["term"]


def dealt(cut: DataFrame, heavy: int, tasks: int | None, ranged: bool = False) -> DataFrame:
    """Postings moved to their block: dealt by a hash, or ``ranged`` in order, over ``tasks`` (null: the planner's number)."""
    keys = ([] if tasks is None else [tasks]) + block_keys(heavy)
    return cut.repartitionByRange(*keys) if ranged else cut.repartition(*keys)


def grouped(post: DataFrame, block_bits: int = DEFAULT_BLOCK_BITS, max_docs: int | None = None, stored: bool = False) -> DataFrame:
    """A3 + P5: ``(term, block, postings array<struct<doc, tf>>)`` sorted by doc.

    All of a common term's documents in one row would grow with the corpus, so the
    list is cut into blocks of documents (``with_block``); other terms have one row.
    Postings move to their block before they are collected: lists that are gathered map-side
    first would be sorted and spilled on both sides, and hardly shrink.
    """
    return (
        dealt(*sized_blocks(post, block_bits, max_docs, stored))
        .select("term", "block", F.struct("doc", "tf").alias("p"))
        .groupBy("term", "block")
        .agg(F.sort_array(F.collect_list("p")).alias("postings"))
    )
