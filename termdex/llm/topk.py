"""Exact top-k inner-product search by block-at-a-time pruning.

Vectors become whole numbers (``floor(SCALE * x)``). Candidates are laid out in
document-range blocks of ``BLOCK`` vectors; a block's summary holds, for every term
(dimension), the largest and the smallest value in it. A query's bound for a block is the
sum over its terms of the larger of weight times maximum and weight times minimum. Per query,
blocks are visited in falling order of their bounds and scored through the block's
forward index (its rows of numbers) until the bound of the next block is below the kth
score found; blocks whose bound equals it are still scored, so ties are kept. The result is
exact.

How it runs. Candidates are ranged by a coarse key (signs of the first dimensions), so
vectors that point the same way share blocks and bounds are tight; ranges are as many as
their counted bytes need. A task takes in ``HELD`` bytes of blocks at a time and carries each
query's best on. Queries are taken in chunks of ``CHUNK`` (counted), each against all blocks. A chunk
is broadcast, its results are written, and the broadcast is released before the next, so
the driver holds one chunk. Of a chunk there are two passes: the first scores, for every
``HELD`` bytes, each query's most promising block, and the kth best score over all of them is a
floor that no result is below; the second visits the other blocks against that floor. Only the
best k per query and task leave a task; they meet by (query) with at most k rows per task.

Null vectors and vectors with null or non-finite components take no part. Vectors of
different lengths are compared as if the shorter ended in zeros; an empty vector scores 0.
A row is not compared with rows of its own id. Rows that repeat another id are candidates
each; a query id that repeats is answered once for each distinct vector. Null ids are no
queries, and as candidates sort after all others. Scores beyond 64 bits are an error.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termdex.llm.common import saved, slots
from termdex.session import shared_dir

SCALE = 256
K = 5
QUERY_EVERY = 50
BLOCK = 256
# Queries broadcast at once.
CHUNK = 4096
# Bytes of candidates that a task holds at once, and that a range has.
HELD = 32 << 20
# Leading dimensions whose signs order the candidates.
SIGNS = 12
# Whole numbers up to this are exact as doubles.
_EXACT = 2**53


def whole_numbers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``(vec_id, v array<bigint>)`` of the rows that take part."""
    v = F.col(vector_col)
    # a null fails the test, and so does a NaN or an infinity
    whole = F.forall(v, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    rows = vectors.filter(v.isNotNull() & whole).select(F.col(id_col).alias("vec_id"), v.alias("v"))
    return rows.select("vec_id", F.transform("v", lambda x: F.floor(x.cast("double") * scale)).alias("v"))


def _matrix(lists: list, width: int) -> np.ndarray:
    out = np.zeros((len(lists), width), np.int64)
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact ``a @ b.T``: in doubles where every partial sum is exact, else in whole numbers."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < _EXACT:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    if most < 2**63:
        return a @ b.T
    exact = a.astype(object) @ b.astype(object).T
    if exact.size and max(exact.max(), -exact.min()) >= 2**63:
        raise OverflowError("a score exceeds 64 bits")
    return exact.astype(np.int64)


class Queries:
    """A chunk of queries: ids and vectors in the same order."""

    def __init__(self, rows: list[tuple]):
        self.ids = np.array([r[0] for r in rows], np.int64)
        self.width = max((len(r[1]) for r in rows), default=0)
        self.vectors = _matrix([r[1] for r in rows], self.width)


class _Best:
    """The best k candidates of each query so far: falling score, then rising id."""

    LAST = np.iinfo(np.int64).max
    NONE = np.iinfo(np.int64).min

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), self.NONE, np.int64)
        self.id = np.full((n, k), self.LAST, np.int64)
        self.there = np.zeros((n, k), bool)

    def add(self, q: np.ndarray, ids: np.ndarray, score: np.ndarray, ok: np.ndarray) -> None:
        """Candidates ``ids`` with ``score[q, candidate]`` where ``ok``."""
        s = np.concatenate([self.score[q], np.where(ok, score, self.NONE)], 1)
        i = np.concatenate([self.id[q], np.broadcast_to(ids, score.shape)], 1)
        t = np.concatenate([self.there[q], ok], 1)
        by = np.lexsort((i, -s, ~t), axis=1)[:, : self.k] if len(q) else np.zeros((0, self.k), int)
        self.score[q], self.id[q], self.there[q] = (np.take_along_axis(x, by, 1) for x in (s, i, t))

    def kth(self) -> np.ndarray:
        return np.where(self.there[:, -1], self.score[:, -1], self.NONE)


def _search(get_queries, k: int, get_floor, first: bool):
    """A task's blocks against a chunk of queries.

    First pass: every query's best block. Second pass: all blocks that may still hold a
    result, in falling order of their bounds.
    """

    def visit(queries: Queries, best: _Best, floor: np.ndarray, ids: list, blocks: list, high: list, low: list) -> None:
        n = len(queries.ids)
        up, down = np.maximum(queries.vectors, 0), np.minimum(queries.vectors, 0)
        bound = _product(up, np.array(high)) + _product(down, np.array(low))
        order = np.argsort(-bound, axis=1, kind="stable")
        for step in range(1 if first else order.shape[1]):
            at = order[:, step]
            reach = bound[np.arange(n), at]
            todo = np.flatnonzero((reach >= floor) & (reach >= best.kth()))
            if not len(todo):
                break
            for block in np.unique(at[todo]):
                q = todo[at[todo] == block]
                score = _product(queries.vectors[q], blocks[block])
                best.add(q, ids[block], score, ids[block][None, :] != queries.ids[q][:, None])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = get_queries()
        n = len(queries.ids)
        floor = np.full(n, _Best.NONE, np.int64) if first else get_floor()
        best = _Best(n, k)
        held: tuple[list, list, list, list] = ([], [], [], [])
        size = 0
        for b in batches:
            vec, lists = b.column("vec_id"), b.column("v").to_pylist()
            width = max(queries.width, max(map(len, lists), default=0))
            numbers = np.array([_Best.LAST if x is None else x for x in vec.to_pylist()], np.int64)
            for a in range(0, len(lists), BLOCK):
                m = _matrix(lists[a : a + BLOCK], width)[:, : queries.width]
                for kept, x in zip(held, (numbers[a : a + BLOCK], m, m.max(0), m.min(0)), strict=True):
                    kept.append(x)
                size += m.nbytes
                if size >= HELD and n:
                    visit(queries, best, floor, *held)
                    held, size = ([], [], [], []), 0
        if held[0] and n:
            visit(queries, best, floor, *held)
        q, place = np.nonzero(best.there)
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(best.id[q, place]), pa.array(best.score[q, place])], ["q", "vec_id", "score"])

    return run


def top_k(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    every: int = QUERY_EVERY,
    scale: int = SCALE,
    chunk: int = CHUNK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best candidates of every row whose id ``every`` divides."""
    spark = vectors.sparkSession
    rows = whole_numbers(vectors, id_col, vector_col, scale)
    sign = F.concat_ws("", *(F.when(F.get("v", F.lit(d)) >= 0, "1").otherwise("0") for d in range(SIGNS)))
    total = rows.agg(F.sum(8 * F.size("v") + 8)).first()[0] or 0
    ranges = max(slots(vectors), -(-total // HELD))
    laid = saved(rows.withColumn("coarse", sign).repartitionByRange(ranges, "coarse", "vec_id").sortWithinPartitions("coarse", "vec_id").select("vec_id", "v"), "topk-vectors")
    asked = saved(rows.filter(F.col("vec_id") % every == 0).distinct(), "topk-queries")
    size = asked.count()
    chunks = max(1, -(-size // chunk) * 2 if size > chunk else 1)  # hashed chunks stay below the bound
    schema = "q long, vec_id long, score long"
    results = shared_dir(spark, "topk-found")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    last = F.when(F.col("vec_id") != _Best.LAST, F.col("vec_id")).alias("vec_id")
    for c in range(chunks):
        part = asked if chunks == 1 else asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(chunks)) == c)
        queries = Queries(sorted((r["vec_id"], r["v"]) for r in part.collect()))
        if not len(queries.ids):
            continue
        sent = spark.sparkContext.broadcast(cloudpickle.dumps(queries))
        get = lambda b=sent: pickle.loads(b.value)
        seeds = ranked(laid.mapInArrow(_search(get, k, None, True), schema)).filter(F.col("rank") == k).select("q", "score").collect()
        floor = np.full(len(queries.ids), _Best.NONE, np.int64)
        for r in seeds:
            floor[r["q"]] = r["score"]
        floors = spark.sparkContext.broadcast(floor)
        found = ranked(laid.mapInArrow(_search(get, k, lambda b=floors: b.value, False), schema))
        names = spark.createDataFrame([(i, int(x)) for i, x in enumerate(queries.ids.tolist())], "q long, query_id long")
        found = found.join(F.broadcast(names), "q").select("query_id", F.col("rank").cast("int").alias("rank"), last, "score")
        found.write.parquet(f"{results}/chunk={c}")
        sent.destroy()
        floors.destroy()
    out = T.StructType.fromDDL("query_id long, rank int, vec_id long, score long")
    if not size:
        return spark.createDataFrame([], out)
    return spark.read.schema(T.StructType(out.fields + [T.StructField("chunk", T.IntegerType())])).parquet(results).select(*out.names)
