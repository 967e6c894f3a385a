"""Helpers shared by the operators: words, hashes, saved tables."""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Callable, Iterable
from typing import TypeVar

import numpy as np
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termdex.session import shared_dir

_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xD6E8FEB86659FD93)
_S1 = np.uint64(32)
_S2 = np.uint64(29)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the cluster's shared folder and read that.

    The lineage ends there: a lost executor costs a reread, not the work before.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


T = TypeVar("T")
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Texts sent to a Python worker at once, unless the session says otherwise.
TEXTS = 1024


def small_batches(spark: SparkSession) -> None:
    """Lower Spark's default of 10,000 rows a batch to ``TEXTS``: a batch of texts is held whole.

    A value that the session's owner has set stays.
    """
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(TEXTS))


def ship(spark: SparkSession, model: T) -> Callable[[], T]:
    """Broadcast a model of bounded size; the function returned gives it to a task."""
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(model))
    return lambda: pickle.loads(packed.value)


def split_of(id_col: str, parts: int) -> Column:
    """``crc32(id as text) mod parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % parts


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z in lower case, as UTF-8 bytes."""
    return text.encode().lower().split() if text else []


def word_ids(texts: Iterable[str | None]) -> tuple[list[np.ndarray], list[bytes]]:
    """Per text the numbers of its words, and the distinct words in the order of their numbers."""
    vocab: defaultdict[bytes, int] = defaultdict()
    vocab.default_factory = vocab.__len__
    number = vocab.__getitem__
    out = []
    for t in texts:
        w = words(t)
        out.append(np.fromiter(map(number, w), np.int64, len(w)))
    return out, list(vocab)


def hashes(items: list[bytes]) -> np.ndarray:
    """64-bit hash of each item."""
    return np.fromiter(map(xxhash.xxh64_intdigest, items), np.uint64, len(items))


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of the ordered pair of two hash arrays."""
    x = a * _M1 + b
    x ^= x >> _S1
    x *= _M2
    x ^= x >> _S2
    return x


def slots(df: DataFrame) -> int:
    """Shuffle partitions of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
