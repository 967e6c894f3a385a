"""Phrase collocations from a depth-truncated suffix tree, built in parts that fit in memory.

Texts (A-Z in lower case) are cut at ``.,;:!?`` and line ends into pieces, and pieces at blanks
and tabs into words; everything is counted for each language on its own. A phrase of 2 to
``max_words`` words that occurs ``min_count`` times or more inside pieces is a candidate. Its
score is the smallest, over its cuts in two, of ``scale * a * a // (l * r)`` with the counts of
the phrase and of both parts. A candidate inside a longer one with ``share`` percent of its
count or more is dropped.

Vertical partitioning. The suffixes that begin at the places of the corpus, truncated to
``max_words`` words, are the leaves of a tree whose inner nodes are phrases; a node's count is
the total of its leaves. The tree is cut from top to bottom by *prefixes*, as in the ERA method:
words whose suffixes fit in the memory budget stay whole, larger ones are extended by another
word until their parts fit. Prefixes in order are packed into groups of about ``budget`` leaves,
and each group's subtree is built on its own, by sorting its leaves.

How it runs.

1. A task cuts its texts into chunks of one language, of about ``CHUNK`` bytes, and numbers
   the words of each. The corpus is tokenised once.
2. Words and counts of the chunks are added up. A phrase can't be more frequent than one of its
   words, so words below ``min_count`` end a piece from here on. The others are numbered
   by falling count; numbers return to the chunks by a join. What is left is the coded corpus.
3. Each chunk's distinct suffixes are counted by prefix, one level after another for those over
   the budget, which gives the groups' borders (one for every ``budget`` leaves, at least one for
   each shuffle partition). A prefix's weight is the number of rows that its group will
   get: distinct suffixes of a chunk, whose occurrences are added up before they move. So a
   passage that is in a third of all texts is one row for each chunk.
4. Every chunk sends its suffixes to their groups as packed arrays, and groups build their
   subtrees. Nodes that a border cuts are added up.
5. Scores, containment and ranks are joins of the nodes. Products are exact decimals.

Memory of a task is bounded by a chunk or a group. The driver gets the borders, and sizes of
partitions. Counts of 10^13 and more are out of the decimals' range.

Null texts are empty, a null language is ``und``. Repeated rows count each. Ties in score and count
are ranked by the phrase's bytes. Empty tables give no rows. Other columns are ignored. A
text longer than a chunk is cut at a piece's end; one piece is never cut.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termdex.llm.common import saved, ship, slots, small_batches

# Bytes of text in a chunk.
CHUNK = 4 << 20
# Rows (distinct suffixes of a chunk) in a group.
BUDGET = 2_000_000
# A prefix is extended if it has more than a quarter of the budget, or than one in SHARE of all
# rows: then small corpora, too, fall into even groups.
SHARE = 1024
# Parts of a language whose phrases are ranked on their own first.
RANKED_APART = 64
# Pieces end at these bytes; words at blanks and tabs.
ENDS = b".,;:!?\n\x0b\x0c\r"
_BREAK = b"."
_TABLE = bytes.maketrans(ENDS + b"\t", _BREAK * len(ENDS) + b" ")
_END = re.compile(b"[" + re.escape(ENDS) + b"]")


# -- coded corpus ----------------------------------------------------------------------


def _cut(text: bytes, size: int) -> Iterator[bytes]:
    """Parts of a text of at least ``size`` bytes, each but the last up to the end of a piece."""
    at = 0
    while len(text) - at > size:
        end = _END.search(text, at + size)
        if not end:
            break
        yield text[at : end.end()]
        at = end.end()
    yield text[at:]


def _chunk(lang: str, texts: list[bytes]) -> pa.RecordBatch:
    """Words, their counts, and the word numbers (from 1; 0 between pieces) of some texts of one language."""
    vocab: defaultdict[bytes, int] = defaultdict()
    vocab.default_factory = vocab.__len__
    vocab[_BREAK]
    w = _BREAK.join(texts).lower().translate(_TABLE).replace(_BREAK, b" " + _BREAK + b" ").split()
    tokens = np.fromiter(map(vocab.__getitem__, w), "<i4", len(w))
    counts = np.bincount(tokens, minlength=len(vocab))[1:]
    words = pa.array(list(vocab)[1:], pa.binary()).cast(pa.string())
    row = [pa.array([lang]), _one_list(words), _one_list(pa.array(counts, pa.int64())), pa.array([tokens.tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(row, ["lang", "words", "counts", "tokens"])


def _one_list(x: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)


def _chunks(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: defaultdict[str, list[bytes]] = defaultdict(list)
        bytes_: defaultdict[str, int] = defaultdict(int)
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
                for part in _cut(text, size):
                    held[lang].append(part)
                    bytes_[lang] += len(part)
                    if bytes_[lang] >= size:
                        yield _chunk(lang, held.pop(lang))
                        del bytes_[lang]
        for lang, texts in held.items():
            yield _chunk(lang, texts)

    return run


def _numbered(frequent: DataFrame) -> DataFrame:
    """``lang, word, id`` with numbers from 0 by falling count: a common word has a small number."""
    at = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    ranked = frequent.orderBy(F.desc("f"), "lang", "word").select("lang", "word", F.spark_partition_id().alias("part"), at.alias("at"))
    ranked = saved(ranked, "phrases-words")
    first, total = [], 0
    for part, n in sorted(ranked.groupBy("part").count().collect()):
        first.append((part, total))
        total += n
    if total >= 1 << 31:
        raise ValueError("more than 2**31 words reach min_count")
    starts = ranked.sparkSession.createDataFrame(first, "part int, first long")
    return ranked.join(F.broadcast(starts), "part").select("lang", "word", (F.col("first") + F.col("at")).cast("int").alias("id"))


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word numbers of the chunks become those of the corpus; -1 ends a piece."""
    for b in batches:
        for r in range(b.num_rows):
            tokens = np.frombuffer(b.column("tokens")[r].as_py(), "<i4")
            known = b.column("known")[r].values.flatten()
            table = np.full(b.column("size")[r].as_py() + 1, -1, "<i4")
            table[known[0].to_numpy() + 1] = known[1].to_numpy()
            x = table[tokens]
            twice = np.zeros(len(x), bool)
            twice[1:] = (x[1:] < 0) & (x[:-1] < 0)
            yield pa.RecordBatch.from_arrays([pa.array([x[~twice].tobytes()], pa.binary())], ["data"])


# -- suffixes --------------------------------------------------------------------------


def _sorted_rows(cols: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For rows of numbers from -1 on: a row of each distinct kind, in order, and every row's kind."""
    kind, row = cols[0].astype(np.int64) + 1, np.zeros(0, np.int64)
    if len(cols) == 1:
        _, row, kind = np.unique(kind, return_index=True, return_inverse=True)
    for c in cols[1:]:
        _, row, kind = np.unique(kind << 32 | (c.astype(np.int64) + 1), return_index=True, return_inverse=True)
    return row, kind


def suffixes(x: np.ndarray, depth: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct truncated suffixes of a coded text in order (a column for each word, -1 after the end), and their counts."""
    place = np.flatnonzero(x >= 0)
    after = np.concatenate([x, np.full(depth, -1, x.dtype)])
    cols = [x[place]]
    for d in range(1, depth):
        cols.append(np.where(cols[-1] >= 0, after[place + d], -1).astype(x.dtype))
    row, kind = _sorted_rows(cols)
    return [c[row] for c in cols], np.bincount(kind, minlength=len(row))


def _starts(cols: list[np.ndarray]) -> np.ndarray:
    """Where a new prefix begins in rows that are in order."""
    new = np.zeros(len(cols[0]), bool)
    if len(new):
        new[0] = True
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _weights(depth: int, level: int, heavy: Callable[[], set[tuple[int, ...]]] | None):
    """Rows by prefix of ``level`` words; from level 2 on below the heavy prefixes only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        within = heavy() if heavy else None
        for b in batches:
            for data in b.column("data").to_pylist():
                cols, _ = suffixes(np.frombuffer(data, "<i4"), depth)
                if within is not None:
                    for d in range(1, level):
                        first = {p[:d] for p in within}
                        at = _starts(cols[:d])
                        size = np.diff(np.append(at, len(cols[0])))
                        keep = np.repeat(np.fromiter((p in first for p in zip(*(c[at].tolist() for c in cols[:d]), strict=True)), bool, len(at)), size)
                        cols = [c[keep] for c in cols]
                at = _starts(cols[:level])
                rows = np.diff(np.append(at, len(cols[0])))
                yield pa.RecordBatch.from_arrays([*(pa.array(c[at]) for c in cols[:level]), pa.array(rows)], [*(f"p{d}" for d in range(level)), "rows"])

    return run


def borders(coded: DataFrame, depth: int, budget: int) -> np.ndarray:
    """First prefix of every group of about ``budget`` rows, in order (a column for each word)."""
    names = [f"p{d}" for d in range(depth)]
    heavy, light, limit = None, [], 0
    for level in range(1, depth + 1):
        own = names[:level]
        shared = ship(coded.sparkSession, heavy) if heavy is not None else None
        got = coded.mapInArrow(_weights(depth, level, shared), ", ".join(f"{n} int" for n in own) + ", rows long")
        got = saved(got.groupBy(*own).agg(F.sum("rows").alias("rows")), "phrases-prefixes")
        if level == 1:
            # so at most four prefixes for every budget of rows, or SHARE, are too large
            total = got.agg(F.sum("rows")).first()[0] or 0
            limit = min(budget // 4, max(1, total // SHARE))
        large = (F.col("rows") > limit) & F.lit(level < depth)
        light.append(got.filter(~large).select(*own, *(F.lit(-1).alias(n) for n in names[level:]), "rows"))
        heavy = {tuple(r) for r in got.filter(large).select(*own).collect()}
        if not heavy:
            break
    prefixes = reduce(DataFrame.union, light)
    ranged = saved(prefixes.repartitionByRange(slots(coded), *names).withColumn("part", F.spark_partition_id()), "phrases-ranges")
    before = F.sum("rows").over(Window.partitionBy("part").orderBy(*names).rowsBetween(Window.unboundedPreceding, -1))
    number = F.floor(F.coalesce(before, F.lit(0)) / budget)
    first = ranged.withColumn("number", number).groupBy("part", "number").agg(F.min(F.struct(*names)).alias("p")).select("p.*")
    table = first.toArrow()
    cols = [table.column(n).to_numpy().astype(np.int32) for n in names]
    order = np.lexsort(cols[::-1])
    return np.stack([c[order] for c in cols])


def place(cols: list[np.ndarray], borders: list[np.ndarray]) -> np.ndarray:
    """How many borders are at or before each row; both are in order."""
    low = np.searchsorted(borders[0], cols[0], side="left")
    high = np.searchsorted(borders[0], cols[0], side="right")
    if len(cols) == 1:
        return high
    tie = np.flatnonzero(high > low)
    out = low
    if len(tie):
        runs = np.flatnonzero(np.diff(cols[0][tie], prepend=-2))
        for a, b in zip(tie[runs].tolist(), (tie[np.append(runs[1:], len(tie)) - 1] + 1).tolist(), strict=True):
            lo, hi = int(low[a]), int(high[a])
            out[a:b] = lo + place([c[a:b] for c in cols[1:]], [x[lo:hi] for x in borders[1:]])
    return out


# -- subtrees --------------------------------------------------------------------------


def _pack(cols: list[np.ndarray]) -> bytes:
    """Columns with the equal-place bytes of their numbers together, which shuffles small."""
    return b"".join(np.ascontiguousarray(c, "<i4").view(np.uint8).reshape(-1, 4).T.tobytes() for c in cols)


def _unpack(data: bytes, n_cols: int) -> list[np.ndarray]:
    planes = np.frombuffer(data, np.uint8).reshape(n_cols, 4, -1)
    return [np.ascontiguousarray(p.T).view("<i4").ravel() for p in planes]


def _dealt(depth: int, shared: Callable[[], np.ndarray]):
    """A chunk's suffixes as one packed row for each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = list(shared())
        for b in batches:
            for data in b.column("data").to_pylist():
                cols, counts = suffixes(np.frombuffer(data, "<i4"), depth)
                if not len(counts):
                    continue
                group = place(cols, edges) - 1
                at = np.append(_starts([group]), len(group))
                rows = [_pack([*(c[x:y] for c in cols), counts[x:y]]) for x, y in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(group[at[:-1]].astype(np.int32)), pa.array(rows, pa.binary())], ["group", "data"])

    return run


def _subtree(depth: int, min_count: int):
    """All rows of a group -> the nodes of its subtree: phrase and total of the leaves below."""

    def run(t: pa.Table) -> pa.Table:
        parts = [_unpack(d, depth + 1) for d in t.column("data").to_pylist()]
        cols = [np.concatenate(c) for c in zip(*parts, strict=True)]
        row, kind = _sorted_rows(cols[:depth])
        count = np.zeros(len(row), np.int64)
        np.add.at(count, kind, cols[depth].astype(np.int64))
        leaves = [c[row] for c in cols[:depth]]
        out = []
        for d in range(1, depth + 1):
            at = _starts(leaves[:d])
            total = np.add.reduceat(count, at)
            # the first and the last node may go on in another group
            keep = total >= min_count
            keep[[0, -1]] = True
            keep &= leaves[d - 1][at] >= 0
            ids = np.stack([c[at[keep]] for c in leaves[:d]], axis=1)
            ends = pa.array(np.arange(len(ids) + 1, dtype=np.int32) * d)
            out.append(pa.table({"ids": pa.ListArray.from_arrays(ends, pa.array(ids.ravel(), pa.int32())), "f": total[keep]}))
        return pa.concat_tables(out)

    return run


def _scored(nodes: DataFrame, scale: int) -> DataFrame:
    """``ids, a, l, r, score`` of every phrase at its lowest-scoring cut."""
    exact: Callable[[str], Column] = lambda c: F.col(c).cast("decimal(13,0)")
    many = nodes.filter(F.size("ids") > 1).select("ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    cuts = many.select("ids", "a", "k", F.slice("ids", F.lit(1), F.col("k")).alias("first"), F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")).alias("rest"))
    cuts = cuts.join(nodes.select(F.col("ids").alias("first"), F.col("f").alias("l")), "first")
    cuts = cuts.join(nodes.select(F.col("ids").alias("rest"), F.col("f").alias("r")), "rest")
    cuts = cuts.withColumn("over", exact("a") * exact("a") * F.lit(scale).cast("decimal(10,0)")).withColumn("under", exact("l") * exact("r"))
    cuts = cuts.withColumn("score", F.expr("over div under"))
    best = cuts.groupBy("ids", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    return best.select("ids", "a", "m.l", "m.r", "m.score")


def _contained(nodes: DataFrame, share: int) -> DataFrame:
    """Phrases inside a longer one with ``share`` percent of their count.

    A longer phrase holds one of a single word more than its part, whose count is no smaller.
    """
    n = F.size("ids")
    inner = F.array(F.slice("ids", F.lit(1), n - 1), F.slice("ids", F.lit(2), n - 1))
    longest = nodes.filter(n > 2).select(F.explode(inner).alias("ids"), "f").groupBy("ids").agg(F.max("f").alias("longer"))
    return longest.join(nodes, "ids").filter(100 * F.col("longer") >= share * F.col("f")).select("ids")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    max_words: int = 3,
    min_count: int = 10,
    share: int = 50,
    scale: int = 1_000_000,
    top: int | None = 2000,
    chunk: int = CHUNK,
    budget: int = BUDGET,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's best phrases (all, if ``top`` is null)."""
    if max_words < 2 or min_count < 1:
        raise ValueError("max_words must be 2 and min_count 1 at least")
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    texts = docs.filter(F.col(text_col).isNotNull()).select(lang.alias("lang"), F.col(text_col).cast("binary").alias("text"))
    cut = texts.mapInArrow(_chunks(chunk), "lang string, words array<string>, counts array<long>, tokens binary")
    chunks = saved(cut.withColumn("chunk", F.monotonically_increasing_id()), "phrases-chunks")

    total = chunks.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y).alias("n")).groupBy("lang").agg(F.sum("n").alias("n"))
    each = chunks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w"))
    counted = each.groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("f"))
    words = saved(_numbered(counted.filter(F.col("f") >= min_count)), "phrases-dictionary")

    asked = chunks.select("chunk", "lang", F.posexplode("words").alias("at", "word"))
    known = asked.join(words, ["lang", "word"]).groupBy("chunk").agg(F.collect_list(F.struct("at", "id")).alias("known"))
    joined = chunks.select("chunk", F.size("words").alias("size"), "tokens").join(known, "chunk")
    coded = saved(joined.select("size", "tokens", "known").mapInArrow(_coded, "data binary"), "phrases-coded")

    edges = borders(coded, max_words, budget)
    dealt = coded.mapInArrow(_dealt(max_words, ship(spark, edges)), "group int, data binary")
    nodes = dealt.groupBy("group").applyInArrow(_subtree(max_words, min_count), "ids array<int>, f long")
    nodes = saved(nodes.groupBy("ids").agg(F.sum("f").alias("f")).filter(F.col("f") >= min_count), "phrases-nodes")

    kept = _scored(nodes, scale).join(_contained(nodes, share), "ids", "left_anti")
    first = words.select(F.col("id").alias("first"), "lang")
    kept = kept.withColumn("first", F.element_at("ids", 1)).join(first, "first").drop("first")
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    if top is not None:
        # with all that tie for the last place, before the words come back: first in parts of a
        # language, so that no task reads what all others have kept
        kept = kept.withColumn("part", F.pmod(F.xxhash64("ids"), F.lit(RANKED_APART)))
        apart = Window.partitionBy("lang", "part").orderBy(F.desc("score"), F.desc("a"))
        for window in (apart, by):
            kept = kept.withColumn("rank", F.rank().over(window)).filter(F.col("rank") <= top).drop("rank")
        kept = kept.drop("part")
    kept = saved(kept, "phrases-best")
    spelled = _spelled(kept.select("ids", F.posexplode("ids").alias("at", "id")).join(words.select("id", "word"), "id"))
    ranked = kept.join(spelled, "ids").join(total, "lang")
    ranked = ranked.withColumn("rank", F.row_number().over(by.orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long"))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _spelled(words: DataFrame) -> DataFrame:
    """``ids, phrase`` from the words of each phrase with their places."""
    listed = words.groupBy("ids").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("w"))
    return listed.select("ids", F.array_join(F.col("w.word"), " ").alias("phrase"))
