"""Benchmark decontamination by greedy string tiling.

A document shares a *seed* with a benchmark item if both hold the same ``MIN_TILE`` words in
a row. For each such pair, running Karp-Rabin matching finds the longest common run of
words that no tile covers yet, marks it as a tile, and goes on until no run of
``MIN_TILE`` words is left. The share of the item's words under tiles is its coverage;
tiles may come in any order, so a passage whose sentences were shuffled is covered all the
same. Documents covering at least ``THRESHOLD`` of an item are contaminated by it.

Words are runs of letters, digits and underscores in lower case, so punctuation and line
breaks don't hide a passage. In scripts without blanks (``ALONE``: Chinese, Japanese, Thai and
its neighbours) every character is a word. An item shorter than ``MIN_TILE`` words is matched
by one tile of its full length.

How it runs. The items, not the documents, travel: their words go to the workers in blocks
of at most ``MAX_WORDS`` words (counted), one pass over a text for each block, so the
broadcast is bounded whatever the benchmark's size. Documents are neither shuffled nor
exploded; a pair is tiled in the task that holds the document, on the stretches of the
document that hold seeds of that item only.

Null and empty texts, and those without a word, on either side, match nothing. Items that repeat an id are tiled each.
Items with a null id are reported with a null id. Other columns are untouched.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termdex.llm.common import ship, small_batches

MIN_TILE = 4
THRESHOLD = 0.5
# Benchmark words sent to the workers at once.
MAX_WORDS = 2_000_000
# Characters that are words by themselves: kana, Han, Thai, Lao, Myanmar, Khmer.
ALONE = "\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff"
_WORDS = re.compile(rf"(?=\w)[{ALONE}]|(?:(?![{ALONE}])\w)+").findall
_PLAIN = re.compile(r"\w+").findall
_ANY_ALONE = re.compile(f"[{ALONE}]").search
_K = np.uint64(0x9E3779B97F4A7C15)
# A word number that no item uses.
OTHER = -1


def _words(text: str | None) -> list[str]:
    """Words of a text in lower case."""
    low = (text or "").lower()
    return _WORDS(low) if _ANY_ALONE(low) else _PLAIN(low)


def _windows(x: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hash of every window of ``size`` numbers, from running sums of powers."""
    n = len(x) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    v = (x + 2).astype(np.uint64)
    for k in range(size):
        h = h * _K + v[k : k + n]
    return h


def tiles(item: np.ndarray, text: np.ndarray, least: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Greedy tiling of two word sequences: ``(length, place in item, place in text)``.

    The search length starts at half the item, doubles while longer runs turn up, and
    halves as they run out, ending at ``least``.
    """
    free_i, free_t = item != OTHER, text != OTHER
    found: list[tuple[int, int, int]] = []
    size = max(least, len(item) // 2)
    while True:
        runs = _scan(item, text, free_i, free_t, size)
        longest = max((r[0] for r in runs), default=0)
        if longest > 2 * size:
            size = longest
            continue
        # longest first, then first in the item, then first in the text
        again = False
        for n, a, b in sorted(runs, key=lambda r: (-r[0], r[1], r[2])):
            if free_i[a : a + n].all() and free_t[b : b + n].all():
                free_i[a : a + n] = False
                free_t[b : b + n] = False
                found.append((n, a, b))
            else:
                again = True  # part of it is covered now; what is left is found anew
        if again:
            continue
        if size == least:
            return found
        size = max(least, size // 2)


def _scan(item: np.ndarray, text: np.ndarray, free_i: np.ndarray, free_t: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """Maximal common runs of uncovered words with at least ``size`` words."""
    if len(item) < size or len(text) < size:
        return []
    whole = lambda f: np.convolve(f, np.ones(size, int), "valid") == size
    ok_i, ok_t = np.flatnonzero(whole(free_i)), np.flatnonzero(whole(free_t))
    hi, ht = _windows(item, size)[ok_i], _windows(text, size)[ok_t]
    hit = np.isin(ht, hi)
    if not hit.any():
        return []
    table = defaultdict(list)
    for a, h in zip(ok_i.tolist(), hi.tolist(), strict=True):
        table[h].append(a)
    runs = []
    for b, h in zip(ok_t[hit].tolist(), ht[hit].tolist(), strict=True):
        for a in table[h]:
            if a and b and free_i[a - 1] and free_t[b - 1] and item[a - 1] == text[b - 1]:
                continue  # the run that starts one word earlier holds this one
            n = 0
            while a + n < len(item) and b + n < len(text) and free_i[a + n] and free_t[b + n] and item[a + n] == text[b + n]:
                n += 1
            if n >= size:
                runs.append((n, a, b))
    return runs


class Items:
    """Benchmark items by word numbers, with their seeds."""

    def __init__(self, rows: list[tuple], least: int = MIN_TILE):
        self.number: dict[str, int] = {}
        self.ids: list = []
        self.words: list[np.ndarray] = []
        self.least = least
        for item_id, text in rows:
            w = _words(text)
            if w:
                self.ids.append(item_id)
                self.words.append(np.array([self.number.setdefault(x, len(self.number)) for x in w], np.int64))
        #: By size of the seeds (that of a short item is all of it): hashes in order, and whose they are.
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        sizes = np.array([min(least, len(w)) for w in self.words], np.int64)
        for size in sorted(set(sizes.tolist()), reverse=True):
            own = np.flatnonzero(sizes == size)
            seeds = [_windows(self.words[o], size) for o in own]
            key = np.concatenate(seeds)
            owner = np.repeat(own, [len(s) for s in seeds])
            by = np.lexsort((owner, key))
            self.seeds[size] = key[by], owner[by]

    def match(self, text: str | None, threshold: float) -> list[tuple]:
        """``(item_id, coverage, n_tiles, longest)`` of the items that the text covers."""
        if not text or not self.seeds:
            return []
        words = _words(text)
        get = self.number.get
        x = np.fromiter((get(w, OTHER) for w in words), np.int64, len(words))
        known = np.concatenate([[0], np.cumsum(x != OTHER)])
        out = []
        for size, (key, owner) in self.seeds.items():
            at = np.flatnonzero(known[size:] - known[:-size] == size) if len(x) >= size else np.zeros(0, np.int64)
            if not len(at):
                continue
            h = _windows(x, size)[at]
            low, high = np.searchsorted(key, h), np.searchsorted(key, h, side="right")
            places: dict[int, list[int]] = defaultdict(list)
            for k in np.flatnonzero(high > low).tolist():
                for o in set(owner[low[k] : high[k]].tolist()):
                    places[o].append(int(at[k]))
            for o, where in sorted(places.items()):
                item = self.words[o]
                # only the stretches that hold seeds of this item can hold tiles
                inside = np.zeros(len(x) + 1, bool)
                for k in range(size):
                    inside[np.array(where) + k] = True
                ends = np.flatnonzero(np.diff(np.concatenate([[0], inside.astype(np.int8)])) == 1)
                stretch = np.insert(x[inside[:-1]], np.cumsum(inside)[ends] - 1, OTHER)
                found = tiles(item, stretch, size)
                covered = sum(t[0] for t in found) / len(item)
                if covered >= threshold:
                    out.append((self.ids[o], covered, len(found), max(t[0] for t in found)))
        return out


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", max_words: int = MAX_WORDS) -> Iterator[Items]:
    """The benchmark in blocks of about ``max_words`` words at most."""
    rows = benchmark.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).filter(F.length("text") > 0)
    # a word is followed by at least one other character
    size = rows.agg(F.sum(F.length("text") / 2 + 1)).first()[0] or 0
    blocks = max(1, int(np.ceil(size / max_words)))
    for k in range(blocks):
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k) if blocks > 1 else rows
        yield Items(sorted((tuple(r) for r in part.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1])))


def matches(spark: SparkSession, items: Items, text: Column, id_type: str = "bigint", threshold: float = THRESHOLD) -> Column:
    """``array<struct<item_id, coverage, n_tiles, longest>>``: what a text column covers of ``items``."""
    small_batches(spark)
    shared = ship(spark, items)

    @F.pandas_udf(f"array<struct<item_id:{id_type},coverage:double,n_tiles:int,longest:int>>")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = ("item_id", "coverage", "n_tiles", "longest")
        known = shared()
        for t in texts:
            yield pd.Series([[dict(zip(names, m, strict=True)) for m in known.match(x, threshold)] for x in t], dtype=object)

    return run(text)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Pairs ``doc_id, item_id, coverage, n_tiles, longest`` with at least ``threshold`` coverage."""
    kind = benchmark.schema["item_id"].dataType.simpleString()
    spark = docs.sparkSession
    out = None
    for items in item_blocks(benchmark):
        found = docs.select(F.col(id_col).alias("doc_id"), F.explode(matches(spark, items, F.col(text_col), kind, threshold)).alias("m")).select("doc_id", "m.*")
        out = found if out is None else out.union(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are contaminated by no item."""
    kind = benchmark.schema["item_id"].dataType.simpleString()
    for items in item_blocks(benchmark):
        docs = docs.filter(F.size(matches(docs.sparkSession, items, F.col(text_col), kind, threshold)) == 0)
    return docs
