"""Quality by hierarchical empirical Bayes over hosts and paths.

A document's quality estimate has two parts. *Evidence*: a logistic classifier on the form
of the text (mean word length, share of symbols, digits, repeated lines and words, ...),
as log odds against the base rate. *Prior*: the rate of good documents at its path,
shrunk towards its host's rate, which is shrunk towards the global rate. The estimate is
the posterior ``sigmoid(logit(prior) + evidence)``.

Levels are beta-binomial. At a level, ``n`` documents with ``k`` good ones in sum have the
posterior mean ``(k + m * parent) / (n + m)``: a sparse site stays near its parent. The
strength m of a level is estimated from the data by moments: how much more the level's
rates vary than their counts alone would make them. A labelled training document counts with its
label, any other with the classifier's probability. A document's own count is taken out of
its sites before they judge it, so a site of one document says nothing about it.

Where a table has a URL, host and path are its host and first path segment
(``url_levels``); ``documents`` has none, so its source is the host and the language
section within it the path.

How it runs. One map over the texts makes a numeric row for each document; a table of
these is kept, so the text is read once. Site counts are grouped sums with map-side
partial sums, one row per site; they return to the documents by a join dealt into
``SALTS`` salts, so a host with a third of the rows is spread over as many tasks. The
classifier is fitted on the driver on at most ``FIT_ROWS`` labelled rows, those whose id
hashes lowest; everything else covers all rows.

Null and empty texts have zero features. A null host or path is a site of its own. Without
labels of both classes the evidence is 0 and the rate 0.5. Repeated rows count, and are
answered, each; of several labels of an id the largest counts. A null id has no label.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termdex.llm.common import saved, small_batches, split_of

# Labelled rows that the classifier is fitted on.
FIT_ROWS = 20_000
# Documents below this are rejected by ``kept``.
MIN_SCORE = 0.5
SALTS = 32
# Bounds of a level's strength.
STRENGTH = (1.0, 10_000.0)

FEATURES = ("log_words", "word_length", "symbols", "digits", "capitals", "bars", "word_variety", "line_variety", "long_run", "blank")

# Classes of bytes: 0 other, 1 lower-case letter or part of a longer character, 2 capital, 3 digit, 4 blank, 5 usual punctuation, 6 bar
_CLASS = np.zeros(256, np.uint8)
_CLASS[[*range(97, 123), *range(128, 256)]] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[[32, 9, 10, 11, 12, 13]] = 4
_CLASS[[ord(c) for c in ".,;:'\"?-()"]] = 5
_CLASS[ord("|")] = 6


def features(text: str | None) -> list[float]:
    """The numbers of ``FEATURES`` for one text."""
    if not text or text.isspace():
        return [0.0] * (len(FEATURES) - 1) + [1.0]
    b = text.encode()
    n = np.bincount(_CLASS[np.frombuffer(b, np.uint8)], minlength=7) / len(b)
    words = b.lower().split()
    lines = [x for x in b.split(b"\n") if x]
    w = len(words)
    longest = run = 1
    before = None
    for x in words:
        run = run + 1 if x == before else 1
        before = x
        if run > longest:
            longest = run
    return [
        math.log1p(w),
        math.log(sum(map(len, words)) / w),
        float(n[0]),
        float(n[3]),
        float(n[2]),
        float(n[6]),
        len(set(words)) / w**0.9,
        len(set(lines)) / len(lines),
        math.log(longest),
        0.0,
    ]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _features(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for t in texts:
        yield pd.Series([features(x) for x in t], dtype=object)


class Classifier:
    """Logistic regression with squares of the standardised features; Newton steps, ridge."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0):
        self.rate = float((y.sum() + 0.5) / (len(y) + 1)) if len(y) else 0.5
        width = len(FEATURES)
        self.mean, self.scale = np.zeros(width), np.ones(width)
        self.weights = np.zeros(2 * width + 1)
        if not len(y) or y.min() == y.max():
            self.rate = 0.5
            return
        self.mean, self.scale = x.mean(0), np.maximum(x.std(0), 1e-6)
        z = self._expand(x)
        w = self.weights.copy()
        w[-1] = math.log(self.rate / (1 - self.rate))
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            g = z.T @ (y - p) - ridge * np.append(w[:-1], 0)
            h = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
            step = np.linalg.solve(h, g)
            w += step
            if np.abs(step).max() < 1e-8:
                break
        self.weights = w

    def _expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.concatenate([z, z * z, np.ones((len(z), 1))], 1)

    def evidence(self, f: Column) -> Column:
        """Log odds against the base rate, as an expression over the array of features."""
        if not self.weights.any():
            return F.lit(0.0)
        base = math.log(self.rate / (1 - self.rate))
        total = F.lit(float(self.weights[-1]) - base)
        width = len(FEATURES)
        for k in range(width):
            z = F.greatest(F.lit(-6.0), F.least(F.lit(6.0), (f[k] - float(self.mean[k])) / float(self.scale[k])))
            total = total + z * float(self.weights[k]) + z * z * float(self.weights[width + k])
        return F.greatest(F.lit(-12.0), F.least(F.lit(12.0), total))


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def url_levels(url: Column) -> tuple[Column, Column]:
    """Host, and first path segment, of a URL (null where there is none)."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]*)", 1)
    return F.nullif(host, F.lit("")), F.nullif(path, F.lit(""))


def strength(sites: DataFrame, parent: Column) -> float:
    """Strength m of a level from ``(n, k)`` of its sites, by moments.

    With rates spread by a beta law of mean p and strength m, the sum of ``n (k/n - p)^2``
    over sites is ``sum p(1-p) (1 + (n - 1) / (m + 1))`` in expectation.
    """
    p = F.greatest(F.lit(0.001), F.least(F.lit(0.999), parent))
    r = sites.filter("n > 0").agg(
        F.sum((F.col("k") / F.col("n") - p) ** 2 * F.col("n")).alias("spread"),
        F.sum(p * (1 - p)).alias("chance"),
        F.sum(p * (1 - p) * F.greatest(F.col("n") - 1, F.lit(0))).alias("more"),
    ).first()
    if not r["more"] or r["spread"] is None or r["spread"] <= r["chance"]:
        return STRENGTH[1]
    return float(min(STRENGTH[1], max(STRENGTH[0], r["more"] / (r["spread"] - r["chance"]) - 1)))


def _salted(rows: DataFrame, sites: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """Join ``sites`` to ``rows`` on null-safe ``keys``; a hot site is spread over salts."""
    rows = rows.withColumn("salt", F.pmod(F.hash(id_col), F.lit(SALTS)))
    copies = sites.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    on = [rows["salt"] == copies["salt"], *(rows[k].eqNullSafe(copies[k]) for k in keys)]
    return rows.join(copies, on).drop(copies["salt"], *(copies[k] for k in keys)).drop("salt")


def assess(
    docs: DataFrame,
    labels: DataFrame,
    host: Column,
    path: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    folds: int = 5,
    held_fold: int = 0,
) -> DataFrame:
    """Judge every document.

    Labels of ids whose ``crc32(id as text) mod folds`` is ``held_fold`` are not learned
    from. Returns ``doc_id, held_out, host, path, evidence, host_rate, path_rate, score,
    kept`` for every row of ``docs``.
    """
    small_batches(docs.sparkSession)
    marks = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id")).agg(F.max(label_col).cast("double").alias("label"))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), host.cast("string").alias("host"), path.cast("string").alias("path"),
        F.coalesce(split_of(id_col, folds) == held_fold, F.lit(False)).alias("held_out"), _features(F.col(text_col)).alias("f"),
    )
    rows = rows.join(marks, "doc_id", "left").withColumn("label", F.when(~F.col("held_out"), F.col("label")))
    rows = saved(rows, "quality-features")

    fit = rows.filter("label is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS).select("f", "label").collect()
    c = Classifier(np.array([r["f"] for r in fit]).reshape(-1, len(FEATURES)), np.array([r["label"] for r in fit]))
    rows = rows.withColumn("evidence", c.evidence(F.col("f"))).drop("f")
    rows = rows.withColumn("own", F.coalesce("label", _sigmoid(F.col("evidence") + math.log(c.rate / (1 - c.rate)))))

    paths = saved(rows.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("own").alias("k")), "quality-paths")
    whole = paths.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    rate = (whole["k"] + 0.5) / (whole["n"] + 1) if whole["n"] else 0.5
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    m_host = strength(hosts, F.lit(rate))
    h = hosts.select("host", F.col("n").alias("host_n"), F.col("k").alias("host_k"))
    sites = paths.join(h, paths["host"].eqNullSafe(h["host"])).drop(h["host"])
    m_path = strength(sites, (F.col("host_k") + m_host * rate) / (F.col("host_n") + m_host))

    # a document's own count leaves its sites before they judge it
    seen = _salted(rows, sites, ["host", "path"], "doc_id")
    host_rate = (F.col("host_k") - F.col("own") + m_host * rate) / (F.col("host_n") - 1 + m_host)
    path_rate = (F.col("k") - F.col("own") + m_path * F.col("host_rate")) / (F.col("n") - 1 + m_path)
    bounded = lambda p: F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return (
        seen.withColumn("host_rate", bounded(host_rate))
        .withColumn("path_rate", bounded(path_rate))
        .withColumn("score", _sigmoid(_logit(F.col("path_rate")) + F.col("evidence")))
        .select("doc_id", "held_out", "host", "path", "evidence", "host_rate", "path_rate", "score", (F.col("score") >= MIN_SCORE).alias("kept"))
    )
