"""Incremental index build with Structured Streaming (A5 applied per micro-batch).

New documents arriving in a folder (text files or Parquet rows) are tokenised and
counted per micro-batch; each batch's postings are written, sorted, to its own folder
``<index>/epoch=<stream>-<number>``, where the stream is the query's id, which its
checkpoint keeps. A batch that is retried after a failure overwrites its own folder, so
no count is added twice; another stream, or a new checkpoint, has folders of its own.

Readers merge the partial indexes on the fly (``read_merged``): a document split
across batches (more lines of the same file name, more turns of a conversation)
adds up exactly as ``merge_postings`` does. ``compact`` rewrites the partials into
one term-sorted Parquet index when the number of epochs grows.

No state store is used: the index is never held as streaming state, so memory
does not grow with the corpus.
"""

from __future__ import annotations

import os
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from termdex.functions.text import doc_name
from termdex.operators.index import merge_postings, postings
from termdex.sources.index_io import write_index, write_merged


def stream_text_files(spark: SparkSession, folder: str, whole: bool = True, max_files: int | None = None) -> DataFrame:
    """Streaming S1/S2: text files appearing in ``folder`` -> ``(doc, text)``."""
    reader = spark.readStream.option("wholetext", str(whole).lower())
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    df = reader.text(folder)
    return df.select(doc_name(F.col("_metadata.file_path")).alias("doc"), F.col("value").alias("text"))


def stream_table(
    spark: SparkSession,
    path: str,
    schema: StructType,
    doc_col: str = "doc_id",
    text_col: str = "text",
    max_files: int | None = None,
) -> DataFrame:
    """Streaming S8: Parquet files appearing under ``path`` -> ``(doc, text)``."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).select(F.col(doc_col).alias("doc"), F.col(text_col).alias("text"))


def index_stream(
    docs: DataFrame,
    index_path: str,
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    write: Callable[[DataFrame, str], None] | None = None,
) -> StreamingQuery:
    """Start indexing a streaming ``(doc, text)`` DataFrame into ``index_path``.

    ``available_now=True`` indexes everything present and stops (batch-like runs
    that resume from the checkpoint); otherwise the query runs on ``processing_time``.
    The checkpoint defaults to ``<index_path>/_checkpoint`` (hidden from Parquet
    readers), so restarting on the same index resumes instead of indexing old
    input again. ``write`` takes each micro-batch and its name in place of the folder
    of its own (``streaming.levels`` keeps a manifest instead).
    """
    checkpoint = checkpoint or os.path.join(index_path, "_checkpoint")

    started, stream = threading.Event(), []

    def write_epoch(batch: DataFrame, epoch_id: int) -> None:
        started.wait()
        name = f"{stream[0]}-{epoch_id}"
        if write:
            write(batch, name)
        else:
            write_index(postings(batch, "auto"), os.path.join(index_path, f"epoch={name}"), mode="overwrite")

    writer = docs.writeStream.foreachBatch(write_epoch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    query = writer.start()
    stream.append(query.id)
    started.set()
    return query


def read_partials(spark: SparkSession, index_path: str) -> DataFrame:
    """All partial postings written so far -> ``(term, doc, tf, epoch)``."""
    return spark.read.parquet(index_path)


def read_merged(spark: SparkSession, index_path: str) -> DataFrame:
    """The current index: partial postings merged per (term, doc) (A5)."""
    return merge_postings(read_partials(spark, index_path))


def compact(spark: SparkSession, index_path: str, out_path: str, parts: int | None = None) -> None:
    """Merge all partials into one term-sorted Parquet index (K7) at ``out_path``."""
    write_merged([read_partials(spark, index_path)], out_path, parts)
