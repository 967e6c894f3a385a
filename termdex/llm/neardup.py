"""MinHash near-duplicates with sequential Bayesian verification.

Two documents are linked if the Jaccard similarity of their sets of word shingles is at
least ``THRESHOLD``. Documents with the same set form a class; one member stands for it.
Candidates are classes that share a band of MinHash values. A candidate is compared batch
by batch of signature values; after each batch it is dropped if, given the matches so far
and a uniform prior on the similarity, the probability that the similarity reaches the
threshold is below ``MISS``. Survivors are verified on the full shingle sets. The classes'
components over verified links give each document's component.

Large groups. A group of n near copies is never expanded into its n^2 pairs:

1. *Stars.* In every bucket each member is compared with one centre: the member whose
   buckets are largest in sum. In a group of edited copies that is the version most of
   the others come from. Verified stars are merged into components.
2. *Remainder.* Only buckets that still hold two or more components can hide a link. Their
   members are compared inside tasks on packed signatures, in chunk pairs of ``CHUNK``
   members, skipping members of the same component. Of the survivors a task reports no more
   than a forest, which joins them into clusters; a second pass over chunk pairs of each
   cluster verifies its survivors exactly, on the texts, inside the task, and again reports
   a forest of links.

So no bucket is capped and no linked pair of different components is left out; what can be
missed is bounded by the bands (a pair at the threshold shares none of 32 bands of 4 with
probability 5e-6) and by ``MISS``. The stars move rows in proportion to the members. In the
remainder a bucket of n members moves each of them, with its signature, once for every chunk:
n * ceil(n / CHUNK) rows, which for 1,024, 4,096 and 16,384 members of one bucket that are no
copies of each other are 1,024, 16,384 and 262,144. The comparisons, too, are quadratic in such
a bucket; both spread over its chunk pairs.

Defined results. Null and empty texts have no shingle, no link, and are their own
component. A document with fewer words than a shingle has its whole sequence as the one
shingle. Rows that repeat a ``doc_id`` are the same document: their texts' links meet in
it. A null id can't be named by others: such a row takes the component of equal sets (null
if there is none), and ``kept`` compares nulls as equal. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termdex.llm.common import hashes, mix, saved, slots, small_batches, word_ids
from termdex.llm.components import components

SHINGLE = 5
THRESHOLD = 0.75
# The same as whole numbers: 100 * intersection >= 75 * union.
PER_CENT = 75
HASHES, BANDS, ROWS = 256, 32, 4
BATCH = 32
# Probability, after any batch, with which a linked pair may be dropped.
MISS = 1e-5
# Texts whose words are numbered together.
TOGETHER = 256
# Members of a bucket that are compared with each other in one task.
CHUNK = 1024
# Ids that are broadcast to pick texts; beyond, the texts are shuffled to the ids.
MAX_BROADCAST = 1_000_000
# Parts into which the pairs of one centre are dealt.
SALTS = 32


_SIGNED = T.StructType().add("n_shingles", T.LongType()).add("hi", T.LongType()).add("lo", T.LongType()).add("sig", T.BinaryType())


def _shingles(words: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """Distinct 64-bit hashes of a document's shingles, from the hashes of its words."""
    n = len(words)
    if not n:
        return words
    if n < width:
        width, seed = n, n
    else:
        seed = 0
    h = np.full(n - width + 1, seed, np.uint64)
    for k in range(width):
        h = mix(h, words[k : n - width + 1 + k])
    return np.unique(h)


def _sets(batches: Iterator[pd.Series]) -> Iterator[list[np.ndarray]]:
    """Shingle sets of texts, a few texts at a time: a batch's words are never held at once."""
    for texts in batches:
        for a in range(0, len(texts), TOGETHER):
            ids, vocab = word_ids(texts.iloc[a : a + TOGETHER])
            h = hashes(vocab)
            yield [_shingles(h[x]) for x in ids]


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    k = np.arange(1, n + 1, dtype=np.uint64)
    z = np.zeros(n, np.uint64)
    return mix(k, z) | np.uint64(1), mix(k, z + np.uint64(7))


def _minhash(s: np.ndarray, mul: np.ndarray, add: np.ndarray) -> np.ndarray:
    """Sixteen bits of each minimum: enough, as equal minima of unequal sets are 1 in 65536."""
    low = np.full(len(mul), np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(s), 64):
        x = s[a : a + 64, None] * mul + add
        x ^= x >> np.uint64(31)
        np.minimum(low, x.min(0), out=low)
    return (mix(low, add) >> np.uint64(48)).astype("<u2")


@F.pandas_udf(_SIGNED)
def _signature(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    mul, add = _seeds(HASHES)
    for sets in _sets(texts):
        rows = []
        for s in sets:
            if not len(s):
                rows.append((0, None, None, None))
                continue
            d = xxhash.xxh3_128_digest(s.tobytes())
            hi, lo = np.frombuffer(d, "<i8").tolist()
            rows.append((len(s), hi, lo, _minhash(s, mul, add).tobytes()))
        yield pd.DataFrame(rows, columns=["n_shingles", "hi", "lo", "sig"]).astype({"hi": "Int64", "lo": "Int64"})


@F.pandas_udf(T.BinaryType())
def _packed(texts: pd.Series) -> pd.Series:
    """Texts, deflated: a third of the size of their sets."""
    return pd.Series([zlib.compress(x.encode(), 1) if x else None for x in texts], dtype=object)


class _Sets:
    """Shingle sets of packed texts; the last few are remembered."""

    def __init__(self):
        self.seen: dict[bytes, np.ndarray] = {}

    def get(self, packed: bytes | None) -> np.ndarray:
        if not packed:
            return np.zeros(0, np.uint64)
        s = self.seen.get(packed)
        if s is None:
            if len(self.seen) >= 2 * CHUNK:
                self.seen.clear()
            w = zlib.decompress(packed).lower().split()
            s = self.seen[packed] = _shingles(hashes(w))
        return s

    def linked(self, x: bytes | None, y: bytes | None) -> bool:
        p, q = self.get(x), self.get(y)
        if not len(p) or 100 * min(len(p), len(q)) < PER_CENT * max(len(p), len(q)):
            return False
        both = len(np.intersect1d(p, q, assume_unique=True))
        return 100 * both >= PER_CENT * (len(p) + len(q) - both)


def least_matches(seen: int, threshold: float = THRESHOLD, miss: float = MISS) -> int:
    """Fewest matches among ``seen`` values that keep a candidate.

    With a uniform prior the similarity's posterior is Beta(m + 1, seen - m + 1), and its
    mass above t is the chance of at most m successes in seen + 1 trials of chance t.
    """
    mass = 0.0
    for m in range(seen + 1):
        mass += comb(seen + 1, m) * threshold**m * (1 - threshold) ** (seen + 1 - m)
        if mass >= miss:
            return m
    return seen


# By number of values seen.
LEAST = {k: least_matches(k) for k in range(BATCH, HASHES + 1, BATCH)}


@F.pandas_udf(T.BooleanType())
def _plausible(a: pd.Series, b: pd.Series) -> pd.Series:
    """Sequential test of signature pairs."""
    x = np.frombuffer(b"".join(a), "<u2").reshape(-1, HASHES)
    y = np.frombuffer(b"".join(b), "<u2").reshape(-1, HASHES)
    alive, m = np.arange(len(x)), np.zeros(len(x), np.int64)
    for k in range(0, HASHES, BATCH):
        m[alive] += (x[alive, k : k + BATCH] == y[alive, k : k + BATCH]).sum(1)
        alive = alive[m[alive] >= LEAST[k + BATCH]]
    out = np.zeros(len(x), bool)
    out[alive] = True
    return pd.Series(out)


@F.pandas_udf(T.BooleanType())
def _linked(a: pd.Series, b: pd.Series) -> pd.Series:
    """Exact test of pairs of packed texts."""
    sets = _Sets()
    return pd.Series([sets.linked(x, y) for x, y in zip(a, b, strict=True)], dtype=bool)


def _both_sides(pairs: DataFrame, values: DataFrame, test) -> DataFrame:
    """Pairs ``(a, b)`` whose ``values(node, v)`` pass ``test``; a hub ``a`` is dealt into salts."""
    salted = pairs.withColumn("salt", F.pmod(F.hash("b"), F.lit(SALTS)))
    left = salted.select("a", "salt").distinct().join(values, F.col("a") == F.col("node")).select("a", "salt", F.col("v").alias("va"))
    right = salted.join(values, F.col("b") == F.col("node")).select("a", "salt", "b", F.col("v").alias("vb"))
    return right.join(left, ["a", "salt"]).filter(test("va", "vb")).select("a", "b")


def _texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Packed texts of some nodes, kept for both verifications; texts are packed before they move."""
    packed = docs.select(F.col("doc_id").alias("node"), _packed("text").alias("v"))
    nodes = saved(nodes, "nodes")
    if nodes.count() <= MAX_BROADCAST:
        nodes = F.broadcast(nodes)
    return saved(packed.join(nodes, "node", "left_semi"), "texts")


def _bands(sig: Column) -> Column:
    """The bands of a signature as an array of their bytes."""
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.substring(sig, i * (2 * ROWS) + 1, F.lit(2 * ROWS)))


def _compare(keys: list[str], exact: bool):
    """Compare the members of each group of sorted rows: a forest of plausible, or of exact, links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t])
            ends = _ends(t, keys)
            held = t.slice(ends[-1])
            yield from _compared(t, ends, exact)
        if held is not None and held.num_rows:
            yield from _compared(held, np.append(_ends(held, keys), held.num_rows), exact)

    return run


def _ends(t: pa.Table, keys: list[str]) -> np.ndarray:
    """Where groups start; the last one may go on in the next batch."""
    new = np.zeros(t.num_rows, bool)
    new[:1] = True
    for k in keys:
        x = t.column(k).combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _compared(t: pa.Table, ends: np.ndarray, exact: bool) -> Iterator[pa.RecordBatch]:
    if len(ends) < 2:
        return
    t = t.combine_chunks()
    label = t.column("label").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    chunk, low, high, size = (t.column(c).to_numpy() for c in ("chunk", "low", "high", "n"))
    sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), "<u2").reshape(-1, HASHES)
    text = t.column("v").to_pylist() if exact else None
    sets = _Sets()
    left, right = [], []
    for start, end in zip(ends[:-1], ends[1:], strict=True):
        # What is joined so far in this group: members if plausible, as each must meet its
        # partners again in the cluster; whole components if linked.
        up: dict[int, int] = {}

        def top(x: int, up: dict[int, int] = up) -> int:
            while (y := up.get(x, x)) != x:
                x = y
            return x

        at = np.arange(start, end)
        rest = at[chunk[start:end] != low[start]]
        for i in at if low[start] == high[start] else at[chunk[start:end] == low[start]]:
            j = np.arange(i + 1, end) if low[start] == high[start] else rest
            j = j[(label[j] != label[i]) & (100 * np.minimum(size[j], size[i]) >= PER_CENT * np.maximum(size[j], size[i]))]
            m = np.zeros(len(j), np.int64)
            for k in range(0, HASHES, BATCH):
                if not len(j):
                    break
                m += (sig[j, k : k + BATCH] == sig[i, k : k + BATCH]).sum(1)
                ok = m >= LEAST[k + BATCH]
                j, m = j[ok], m[ok]
            for o in j.tolist():
                x, y = (top(int(label[i])), top(int(label[o]))) if exact else (top(int(i)), top(o))
                if x != y and (not exact or sets.linked(text[i], text[o])):
                    up[max(x, y)] = min(x, y)
                    left.append(int(i))
                    right.append(o)
    node = t.column("node").combine_chunks()
    if left:
        yield pa.RecordBatch.from_arrays([node.take(pa.array(left)), node.take(pa.array(right))], ["a", "b"])


def _compared_in_chunks(rows: DataFrame, keys: list[str], exact: bool) -> DataFrame:
    """``_compare`` the rows (keys, size of the group, node, label, n, sig[, v]) of each group in chunk pairs."""
    rows = (
        rows.withColumn("parts", F.ceil(F.col("size") / CHUNK).cast("int"))
        .withColumn("chunk", F.pmod(F.hash("node"), F.col("parts")))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("low", F.least("chunk", "other"))
        .withColumn("high", F.greatest("chunk", "other"))
        .select(*keys, "low", "high", "chunk", "node", "label", "n", "sig", *(["v"] if exact else []))
    )
    group = [*keys, "low", "high"]
    kind = rows.schema["node"].dataType.simpleString()
    return rows.repartition(slots(rows), *group).sortWithinPartitions(*group).mapInArrow(_compare(group, exact), f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    signed = saved(docs.select("doc_id", _signature("text").alias("s")).select("doc_id", "s.*"), "signatures")
    named = signed.filter("doc_id is not null and n_shingles > 0")

    # one member for each distinct set
    classes = saved(
        named.groupBy("hi", "lo").agg(F.min(F.struct("doc_id", "n_shingles", "sig")).alias("m")).select(
            "hi", "lo", F.col("m.doc_id").alias("node"), F.col("m.n_shingles").alias("n"), "m.sig"
        ),
        "classes",
    )
    rows = classes.select("node", F.posexplode(_bands(F.col("sig"))).alias("band", "key"))
    crowded = rows.groupBy("band", "key").agg(F.count("*").alias("size")).filter("size > 1")
    members = saved(rows.join(crowded, ["band", "key"]), "members")

    # 1. stars
    score = members.groupBy("node").agg(F.sum("size").alias("score"))
    scored = members.join(score, "node")
    centre = scored.groupBy("band", "key").agg(F.max(F.struct("score", "node")).alias("c")).select("band", "key", F.col("c.node").alias("a"))
    stars = members.join(centre, ["band", "key"]).filter(F.col("a") != F.col("node")).select("a", F.col("node").alias("b")).distinct()
    sigs = classes.select("node", F.col("sig").alias("v"))
    tried = saved(_both_sides(stars, sigs, _plausible), "star-candidates")
    texts = _texts(docs, members.select("node").distinct())
    links = saved(_both_sides(tried, texts, _linked), "star-links")
    # texts that share a doc_id are one document
    twice = named.select("doc_id", "hi", "lo").distinct().groupBy("doc_id").agg(F.count("*").alias("k")).filter("k > 1")
    same = named.join(twice, "doc_id", "left_semi").join(classes.select("hi", "lo", "node"), ["hi", "lo"])
    labels = components(links.union(same.select(F.col("doc_id").alias("a"), F.col("node").alias("b"))))

    # 2. remainder
    marked = members.join(labels, "node", "left").select("band", "key", "node", F.coalesce("label", "node").alias("label"))
    mixed = marked.groupBy("band", "key").agg(F.min("label").alias("l1"), F.max("label").alias("l2"), F.count("*").alias("size")).filter("l1 <> l2")
    about = classes.select("node", "n", "sig")
    crowd = marked.join(mixed.select("band", "key", "size"), ["band", "key"]).join(about, "node")
    near = saved(_compared_in_chunks(crowd, ["band", "key"], False), "rest-near")
    clusters = components(near).withColumnRenamed("label", "cluster")
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("size"))
    inside = clusters.join(sizes, "cluster").join(about, "node").join(texts, "node").join(labels, "node", "left")
    inside = inside.withColumn("label", F.coalesce("label", "node"))
    late = saved(_compared_in_chunks(inside, ["cluster"], True), "rest-links")
    if not late.isEmpty():
        old = labels.select(F.col("node"), F.col("label"))
        ends = late.join(old.toDF("a", "la"), "a", "left").join(old.toDF("b", "lb"), "b", "left")
        merged = components(ends.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")))
        every = classes.select("node").union(labels.select("node")).distinct().join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"))
        labels = every.join(merged.toDF("label", "low"), "label", "left").select("node", F.coalesce("low", "label").alias("label"))

    found = classes.join(labels, "node", "left").select("hi", "lo", F.coalesce("label", "node").alias("found"))
    return signed.join(found, ["hi", "lo"], "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("found", "doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.coalesce("found", "doc_id")).alias("kept"),
    )
