"""A growing index as levelled partial indexes under one manifest (A5).

A partial index is a folder of term-sorted Parquet (K7). New documents add a small one;
partials of similar size are merged by term range into one of the next level, so each
posting is rewritten about once per level, and a reader merges few partials. Level ``k``
holds partials of up to ``base * fanout ** k`` rows.

What is in the index is said by the manifest alone: the list of live partials, as a table of
one small file per version below ``<index>/_manifest``. A compaction first writes the
merged partial, which nobody sees yet, then commits one version that has it in place of its
inputs. A reader takes the newest version once and reads its folders, which are never
changed, so it sees each posting once, before, between and after the steps. Folders that no
kept version names are what a failed or finished compaction leaves; ``stale`` lists them.

There is one writer at a time. A version is written by ``errorifexists`` into a folder of its
number, so of two writers that start from the same version one fails instead of undoing
the other. A step that is tried again adds nothing twice: a partial is in the manifest or
not, by its name.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from termdex.operators.index import merge_postings, postings
from termdex.session import exists
from termdex.sources.index_io import read_index, write_index, write_merged
from termdex.streaming.ingest import index_stream

MANIFEST = "_manifest"
_ROW = "folder string, level int, rows bigint"
# Partials of one level that are merged together.
FANOUT = 4
# Rows of a partial of level 0, at most.
BASE_ROWS = 1_000_000


def _versions(spark: SparkSession, path: str) -> DataFrame:
    """All committed versions -> ``(folder, level, rows, version)``; a version without partials has no rows."""
    folder = f"{path.rstrip('/')}/{MANIFEST}"
    if not exists(spark, folder):
        return spark.createDataFrame([], f"{_ROW}, version bigint")
    return spark.read.schema(f"{_ROW}, version bigint").parquet(folder)


def live(spark: SparkSession, path: str) -> tuple[int, list[tuple[str, int, int]]]:
    """Number of the newest version (0 if there is none) and its partials: folder, level, rows.

    A handful of rows for each level reaches the driver.
    """
    table = _versions(spark, path)
    version = table.agg(F.max("version")).first()[0] or 0
    rows = table.filter(F.col("version") == version).orderBy("folder").collect()
    return version, [(r.folder, r.level, r.rows) for r in rows]


def commit(spark: SparkSession, path: str, version: int, add: list[tuple[str, int, int]], remove: list[str] = ()) -> int:
    """Commit the version after ``version``: its partials with ``add`` and without ``remove``."""
    at, now = live(spark, path)
    if at != version:
        raise ValueError(f"the index is at version {at}, not {version}: another writer has committed")
    known = {f for f, _, _ in now}
    missing = set(remove) - known
    if missing:
        raise ValueError(f"no partials of the index: {sorted(missing)}")
    kept = [x for x in now if x[0] not in remove] + [x for x in add if x[0] not in known]
    out = f"{path.rstrip('/')}/{MANIFEST}/version={version + 1}"
    spark.createDataFrame(kept, _ROW).coalesce(1).write.mode("errorifexists").parquet(out)
    return version + 1


def level_of(rows: int, fanout: int = FANOUT, base: int = BASE_ROWS) -> int:
    """The level of a partial by its rows."""
    level, size = 0, base
    while rows > size:
        level, size = level + 1, size * fanout
    return level


def append(spark: SparkSession, path: str, post: DataFrame, name: str | None = None, fanout: int = FANOUT, base: int = BASE_ROWS) -> str:
    """Add postings as a partial; one of a ``name`` that the index has already is not added again."""
    version, now = live(spark, path)
    folder = f"part={name or uuid.uuid4().hex[:12]}"
    if folder not in {f for f, _, _ in now}:
        out = f"{path.rstrip('/')}/{folder}"
        # a folder that no version names is what a failed attempt left
        write_index(post, out, mode="overwrite")
        rows = read_index(spark, out).count()
        commit(spark, path, version, [(folder, level_of(rows, fanout, base), rows)])
    return folder


def read_live(spark: SparkSession, path: str) -> DataFrame:
    """The index of the newest version: its partials merged per (term, doc)."""
    _, now = live(spark, path)
    if not now:
        raise ValueError(f"no index at {path}")
    return merge_postings(*(read_index(spark, f"{path.rstrip('/')}/{f}") for f, _, _ in now))


def merge_step(spark: SparkSession, path: str, fanout: int = FANOUT, base: int = BASE_ROWS, parts: int | None = None):
    """First step of a compaction: the lowest level with ``fanout`` partials becomes one partial.

    Returns what to commit, ``(version, add, remove)``, or null if no level is full. The new
    folder is in no version yet.
    """
    version, now = live(spark, path)
    for level in sorted({x[1] for x in now}):
        full = [x for x in now if x[1] == level]
        if len(full) >= fanout:
            names = [f for f, _, _ in full]
            folder = f"merged={uuid.uuid4().hex[:12]}"
            out = f"{path.rstrip('/')}/{folder}"
            # so many ranges that a task merges about BASE_ROWS rows, however large the level
            ranges = parts or max(1, -(-sum(n for _, _, n in full) // BASE_ROWS))
            write_merged([read_index(spark, f"{path.rstrip('/')}/{f}") for f in names], out, ranges)
            rows = read_index(spark, out).count()
            # counts of shared pairs add up, so the rows may be few; a merged partial still rises
            return version, [(folder, max(level + 1, level_of(rows, fanout, base)), rows)], names
    return None


def compact_levels(spark: SparkSession, path: str, fanout: int = FANOUT, base: int = BASE_ROWS, parts: int | None = None) -> int:
    """Merge levels until none is full; returns the number of merges."""
    done = 0
    while (step := merge_step(spark, path, fanout, base, parts)) is not None:
        commit(spark, path, *step)
        done += 1
    return done


def stale(spark: SparkSession, path: str, keep_versions: int = 1) -> list[str]:
    """Partials of older versions that the last ``keep_versions`` no longer name: free to be deleted.

    Only when no reader of an older version is left.
    """
    table = _versions(spark, path)
    newest = table.agg(F.max("version")).first()[0] or 0
    kept = table.filter(F.col("version") > newest - keep_versions).select("folder").distinct()
    gone = table.select("folder").distinct().join(kept, "folder", "left_anti")
    return sorted(r.folder for r in gone.collect())


def append_stream(docs: DataFrame, path: str, checkpoint: str | None = None, compact: bool = True, fanout: int = FANOUT, base: int = BASE_ROWS) -> StreamingQuery:
    """Index a streaming ``(doc, text)`` DataFrame: every micro-batch adds a partial and merges full levels.

    A partial is named by stream and epoch, so an epoch that is tried again adds nothing twice.
    """

    def write(batch: DataFrame, name: str) -> None:
        append(batch.sparkSession, path, postings(batch, "auto"), name, fanout, base)
        if compact:
            compact_levels(batch.sparkSession, path, fanout, base)

    return index_stream(docs, path, checkpoint, write=write)
