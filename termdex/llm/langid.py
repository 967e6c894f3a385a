"""Language identification by rank-order n-gram profiles.

A language's profile is the ranking of its ``PROFILE`` most frequent letter n-grams
(one to three letters, words padded with one blank, lower case) over all training texts.
A text gets the same ranking of its own n-grams; its out-of-place distance to a profile is
the sum over its ranked n-grams of the difference of the two ranks, or ``PROFILE`` for an
n-gram that the profile lacks. The nearest profile wins; equal distances go to the name
that sorts first.

``accepted`` keeps a text whose score reaches the bound of its language and length. Bounds come
from labelled texts held out of a second set of profiles, whole and cut to their first words:
for each language and number of ranked n-grams (in powers of two) the ``LOW`` quantile of
the scores, less ``MARGIN`` and a part that shrinks with the root of that number, since
the scores of short texts scatter more. A length with fewer than ``SUPPORT`` scores takes the
language's quantile over all lengths, shifted as far as that length lies off in all languages. ``MIN_SCORE`` is the least bound, and the only one
for a language with fewer than ``SUPPORT`` scores.

How it runs. Learning counts n-grams per task and language before the one shuffle by
(language, n-gram), so a language with most of the rows is no hot key; profiles are cut in
each task before they meet (Spark's group limit under the ranking window). The profiles
(``PROFILE`` rows for each of at most ``MAX_LANGS`` languages, checked) go to the workers,
and prediction is a map without a shuffle. Long texts are counted in windows.

Null texts, and texts without a letter (marks and emoji are none), are ``und`` with score 0; so is everything when
there is no training text. A null language takes no part in learning. Repeated rows count,
and are answered, each. A null id is hashed as the empty text.
"""

from __future__ import annotations

import math
import unicodedata
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termdex.llm.common import saved, ship, small_batches, split_of

# N-grams in a profile.
PROFILE = 400
# Letters in the longest n-gram (three code points of 21 bits fill a 63-bit key).
LONGEST = 3
# Languages a model may have: bounds what is sent to the workers. More is an error.
MAX_LANGS = 5_000
# Code points counted at once.
WINDOW_CHARS = 1 << 20
UNKNOWN = "und"
# A text whose best profile is farther than this share of the way to "nothing in common"
# is in none of the languages, whatever the bound (used by ``accepted``).
MIN_SCORE = 0.1
# Bounds: one labelled text in so many is held out, whole and cut to so many words.
HELD = 8
CUTS = (1, 2, 4, 8, 16, 32, 64)
# The quantile of held-out scores (mislabelled texts lie below it), scores it must rest on,
# and how far below it a text may lie.
LOW, SUPPORT = 0.05, 30
MARGIN, SCATTER = 0.2, 0.8
BLANK = 32


# Set on a mark: it belongs to the letter before it, but a text of marks alone has no letter.
MARK = np.uint32(1 << 31)


def _letters() -> np.ndarray:
    """Per code point: the lower-case letter it counts as, 0 if it is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            table[cp] = ord(low) if len(low) == 1 else cp
        elif unicodedata.category(c)[0] == "M":
            table[cp] = cp | int(MARK)
    return table


_TABLE: list[np.ndarray] = []


def _table() -> np.ndarray:
    if not _TABLE:
        _TABLE.append(_letters())
    return _TABLE[0]


def gram_counts(text: str | None, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct packed n-grams of a text in rising order, and how often each occurs."""
    if not text:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    cps = table[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    keep = cps > 0
    if not (cps[keep] < MARK).any():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    cps &= MARK - np.uint32(1)
    # one blank between words: a non-letter stays only after a letter
    keep[1:] |= cps[:-1] > 0
    cps = cps[keep].astype(np.uint64)
    cps[cps == 0] = BLANK
    ends = ([BLANK] if cps[-1] != BLANK else [])
    cps = np.concatenate([[BLANK], cps, ends]).astype(np.uint64)
    found = []
    for a in range(0, len(cps), WINDOW_CHARS):
        x = cps[a : a + WINDOW_CHARS + LONGEST - 1]
        keys = []
        key = x
        for n in range(1, LONGEST + 1):
            if n > 1:
                key = (key[: len(x) - n + 1] << np.uint64(21)) | x[n - 1 :]
            k = key[: min(WINDOW_CHARS, len(cps) - a)]
            keys.append(k[k != BLANK] if n == 1 else k)
        found.append(np.unique(np.concatenate(keys), return_counts=True))
    if len(found) == 1:
        return found[0]
    return _add(found)


def _add(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    u, inv = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
    n = np.zeros(len(u), np.int64)
    np.add.at(n, inv, np.concatenate([f[1] for f in found]))
    return u, n


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = _table()
    held: dict[str, list] = defaultdict(list)
    size: dict[str, int] = defaultdict(int)
    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
            u, n = gram_counts(text, table)
            held[lang].append((u, n))
            size[lang] += len(u)
            if size[lang] > 400_000:
                held[lang] = [_add(held[lang])]
                size[lang] = 0
    for lang, found in held.items():
        u, n = _add(found)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(u), pa.string()), pa.array(u.astype(np.int64)), pa.array(n)], ["lang", "gram", "n"])


def profiles(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", size: int = PROFILE) -> DataFrame:
    """Learn ``(lang, gram, place)``: the ``size`` most frequent n-grams of each language."""
    small_batches(docs.sparkSession)
    return _ranked(_counted(_labelled(docs, lang_col, text_col)), size)


def _labelled(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).filter("lang is not null and text is not null")


def _counted(rows: DataFrame) -> DataFrame:
    return rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _ranked(counts: DataFrame, size: int) -> DataFrame:
    by = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return counts.withColumn("place", F.row_number().over(by)).filter(F.col("place") <= size).select("lang", "gram", (F.col("place") - 1).alias("place"))


class Model:
    """Profiles side by side: ``places[g, l]`` is the place of n-gram g in language l."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int = PROFILE):
        self.size = size
        self.langs = sorted({r[0] for r in rows})
        if len(self.langs) > MAX_LANGS:
            raise ValueError(f"{len(self.langs)} languages; a model holds at most {MAX_LANGS}")
        #: Least accepted score by language and bits of the number of ranked n-grams.
        self.bounds: dict[tuple[str | None, int], float] = {}
        at = {x: i for i, x in enumerate(self.langs)}
        self.grams = np.unique(np.array([r[1] for r in rows], np.uint64))
        self.places = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int32)
        if rows:
            g = np.searchsorted(self.grams, np.array([r[1] for r in rows], np.uint64))
            self.places[g, [at[r[0]] for r in rows]] = [r[2] for r in rows]

    def predict(self, text: str | None, table: np.ndarray) -> tuple[str, float]:
        return self.judge(text, table)[:2]

    def bound(self, lang: str, ranked: int) -> float:
        """Least accepted score of a text with so many ranked n-grams."""
        get, bits = self.bounds.get, ranked.bit_length()
        low = get((lang, bits), get((lang, 0)))
        if low is not None and (lang, bits) not in self.bounds and (None, bits) in self.bounds:
            # the language's own level, and how all languages differ by length
            low += self.bounds[None, bits] - self.bounds[None, 0]
        return MIN_SCORE if low is None else max(MIN_SCORE, low - MARGIN - SCATTER / math.sqrt(ranked))

    def judge(self, text: str | None, table: np.ndarray) -> tuple[str, float, int]:
        """Language, score and number of ranked n-grams."""
        u, n = gram_counts(text, table)
        if not len(u) or not self.langs:
            return UNKNOWN, 0.0, 0
        if len(u) > self.size:  # the ranking needs only the most frequent and their ties
            least = np.partition(n, len(n) - self.size)[len(n) - self.size]
            u, n = u[n >= least], n[n >= least]
        ranked = u[np.lexsort((u, -n))][: self.size]
        at = np.searchsorted(self.grams, ranked)
        at[(at == len(self.grams)) | (self.grams[np.minimum(at, len(self.grams) - 1)] != ranked)] = len(self.grams)
        there = self.places[at]
        off = np.where(there < 0, self.size, np.abs(there - np.arange(len(ranked))[:, None])).sum(0)
        best = int(np.argmin(off))
        return self.langs[best], float(1 - off[best] / (self.size * len(ranked))), len(ranked)


def model(profile: DataFrame, size: int = PROFILE) -> Model:
    """Bring learned profiles to the driver: no more rows than ``MAX_LANGS`` profiles have."""
    rows = profile.limit(MAX_LANGS * size + 1).collect()
    if len(rows) > MAX_LANGS * size:
        raise ValueError(f"more than {MAX_LANGS} languages; a model holds at most as many")
    return Model([tuple(r) for r in rows], size)


def _held_scores(shared: Callable[[], Model]):
    """Labelled texts -> the score of each and of its cuts, where the language is the label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, known = _table(), shared()
        for b in batches:
            out = []
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
                words = text.split(None, max(CUTS))
                for x in [text, *(" ".join(words[:k]) for k in CUTS if k < len(words))]:
                    found, score, ranked = known.judge(x, table)
                    if found == lang:
                        out.append((lang, ranked.bit_length(), score))
            cols = list(zip(*out, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.float64())], ["lang", "bits", "score"])

    return run


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", size: int = PROFILE) -> Model:
    """A model of all labelled rows, with bounds from the held-out scores."""
    spark = docs.sparkSession
    small_batches(spark)
    held = F.pmod(F.xxhash64("text"), F.lit(HELD)) == 0
    rows = _labelled(docs, lang_col, text_col)
    # one pass counts both parts: the first letter of the key tells them apart
    parts = rows.select(F.concat(F.when(held, "h").otherwise("r"), "lang").alias("lang"), "text")
    counts = saved(_counted(parts), "gram-counts").withColumn("rest", F.col("lang").startswith("r")).withColumn("lang", F.expr("substr(lang, 2)"))
    m = model(_ranked(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")), size), size)
    rest = ship(spark, model(_ranked(counts.filter("rest").drop("rest"), size), size))
    scores = rows.filter(held).mapInArrow(_held_scores(rest), "lang string, bits int, score double")
    low = scores.cube("lang", "bits").agg(F.percentile_approx("score", F.lit(LOW), F.lit(10_000)).alias("low"), F.count("*").alias("n"))
    # a row for each language and at most ten lengths; no language is all of them, no bits are all lengths
    for r in low.filter(F.col("n") >= SUPPORT).collect():
        m.bounds[r.lang, r.bits or 0] = r.low
    return m


def predict(spark: SparkSession, m: Model, text: Column) -> Column:
    """``struct<lang_pred string, score double>`` of a text column."""
    small_batches(spark)
    shared = ship(spark, m)

    @F.pandas_udf("lang_pred string, score double")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table, known = _table(), shared()
        for t in texts:
            yield pd.DataFrame([known.predict(x, table) for x in t], columns=["lang_pred", "score"])

    return run(text)


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 4, held_fold: int = 2
) -> DataFrame:
    """Learn from the rows that are not held out and predict all: ``doc_id, held_out, lang_pred, score``."""
    held = F.coalesce(split_of(id_col, folds) == held_fold, F.lit(False))
    m = model(profiles(docs.filter(~held), lang_col, text_col))
    return docs.select(F.col(id_col).alias("doc_id"), held.alias("held_out"), predict(docs.sparkSession, m, F.col(text_col)).alias("p")).select(
        "doc_id", "held_out", "p.lang_pred", "p.score"
    )


def accepted(spark: SparkSession, m: Model, text: Column) -> Column:
    """True where a text is in one of the model's languages."""
    small_batches(spark)
    shared = ship(spark, m)

    @F.pandas_udf("boolean")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table, known = _table(), shared()
        for t in texts:
            judged = (known.judge(x, table) for x in t)
            yield pd.Series([bool(n) and score >= known.bound(lang, n) for lang, score, n in judged], dtype=bool)

    return run(text)
