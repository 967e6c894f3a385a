"""Text form of the index: one line per term (and doc block), and its parser.

Line layout (P6-P8): ``term SEP doc:tf SEP doc:tf ...`` with entries sorted by doc.
SEP is a tab (MapReduce and Spark builders) or four blanks (Python builder).
The parser (P9, P10, P13) reads both layouts and any mix of part files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termdex.functions.text import ENTRY_SEP, TAB_SEP, WHITESPACE_RUN, split_words
from termdex.operators.index import DEFAULT_BLOCK_BITS, dealt, sized_blocks


def format_lines(
    post: DataFrame,
    sep: str = TAB_SEP,
    block_bits: int = DEFAULT_BLOCK_BITS,
    max_docs: int | None = None,
    stored: bool = False,
) -> DataFrame:
    """P6-P8 over A3: ``(term, block, line)``; ``max_docs`` and ``stored`` as in ``with_block``."""
    return line_rows(dealt(*sized_blocks(post, block_bits, max_docs, stored)), sep).select("term", "block", "line")


def line_rows(cut: DataFrame, sep: str = TAB_SEP) -> DataFrame:
    """Lines of postings with their ``block``, and the ``entries`` and ``occurrences`` in each.

    ``cut`` is partitioned by block already (``block_keys``), so its postings move as they are, once,
    and no list is gathered, sorted and spilled before it moves.
    Each entry string is built before the aggregation and carried next to its doc,
    so the per-group work is one sort and one join of strings, with no lambda.
    Doc names holding whitespace cannot be read back, and a null doc key would vanish
    from its line, so both fail the job (N3); Parquet keeps them.
    """
    doc = F.col("doc")
    doc_type = cut.schema["doc"].dataType
    doc_str = doc.cast("string")
    if isinstance(doc_type, T.StringType):
        doc_str = F.when(
            doc.rlike(WHITESPACE_RUN),
            F.raise_error(F.concat(F.lit("doc name with whitespace cannot be written as text: "), doc)),
        ).otherwise(doc)
    entry = F.concat(doc_str, F.lit(ENTRY_SEP), F.col("tf").cast("string"))
    return (
        cut.select("term", "block", "tf", F.struct(doc.alias("d"), entry.alias("e")).alias("p"))
        .groupBy("term", "block")
        .agg(F.sort_array(F.collect_list("p")).alias("ps"), F.sum("tf").alias("occurrences"))
        .select(
            "term",
            "block",
            F.concat(F.col("term"), F.lit(sep), F.array_join(F.col("ps.e"), sep)).alias("line"),
            F.size("ps").cast("long").alias("entries"),
            "occurrences",
        )
    )


def parse_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """P9 + P10 + P13: text index lines -> ``(term, doc string, tf bigint)``.

    Blank lines are skipped; word 0 is the term and every further word is an entry.
    An entry splits at its last ``:`` (the reference takes the first; names with a
    colon then still read back). An entry without ``:``, or with a count that is not a
    number, gives a null ``tf`` instead of failing the read (Spark 4 casts are ANSI).
    """
    words = split_words(F.col(col))
    entries = (
        lines.select(words.alias("w"))
        .filter(F.size("w") > 0)
        .select(
            F.element_at("w", 1).alias("term"),
            F.explode(F.slice("w", 2, F.greatest(F.size("w") - 1, F.lit(1)))).alias("e"),
        )
    )
    has_sep = F.instr("e", ENTRY_SEP) > 0
    tail = F.substring_index("e", ENTRY_SEP, -1)
    head = F.substring("e", F.lit(1), F.length("e") - F.length(tail) - F.lit(1))
    doc = F.when(has_sep, head).otherwise(F.col("e"))
    tf = F.when(has_sep, tail.try_cast("bigint"))
    return entries.select("term", doc.alias("doc"), tf.alias("tf"))
