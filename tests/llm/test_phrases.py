"""Collocations against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from termdex.llm import phrases, queries


def brute(rows, max_words=3, min_count=10, share=50, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for i in range(len(w)):
                for j in range(i + 1, min(i + max_words, len(w)) + 1):
                    f[lang, tuple(w[i:j])] += 1
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    gone = set()
    for (lang, p), a in found.items():
        for i in range(len(p)):
            for j in range(i + 2, len(p) + 1):
                inner = (lang, p[i:j])
                if j - i < len(p) and 100 * a >= share * found[inner]:
                    gone.add(inner)
    out = {}
    for (lang, p), a in found.items():
        if (lang, p) in gone:
            continue
        cuts = [(1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted(
        (lang, i, p.decode(), -a, left, right, n[lang], -s)
        for lang, x in out.items()
        for i, (s, a, p, left, right) in enumerate(sorted(x)[:top], 1)
    )


def texts(rng, n):
    words = ["the", "The", "a", "of", "état", "x\x00y", "\xa0", "b\x1cc", "中文", "in", "on", "'", "New", "York", "new", "city"]
    ends = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", "\r", "; ", "!?"]
    return "".join(rng.choices(words, range(len(words), 0, -1))[0] + rng.choice(ends) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = [(texts(rng, rng.randint(0, 120)), rng.choice(["en", "fr", "en", "und", None, ""])) for _ in range(120)]
    out += [(None, "en"), ("", None), ("...", "xx"), ("same passage in every text, again and again " * 30, "en")] + [out[0]] * 12
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string").withColumns({"chunk": F.lit(1), "f": F.lit("x"), "word": F.lit("w")})


@pytest.mark.parametrize("max_words,min_count,share,top,chunk,budget", [(3, 10, 50, 2000, 8 << 20, 2_000_000), (3, 10, 50, 2000, 300, 40), (4, 3, 80, 25, 1000, 8), (2, 2, 50, None, 50, 100)])
def test_equals_brute_force(spark, rows, max_words, min_count, share, top, chunk, budget):
    got = phrases.collocations(frame(spark, rows), max_words=max_words, min_count=min_count, share=share, top=top, chunk=chunk, budget=budget)
    want = brute(rows, max_words, min_count, share, top or 10**9)
    assert len(want) > 20
    assert sorted(tuple(r) for r in got.collect()) == want


def test_query_and_empty_tables(spark, rows, tmp_path):
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op11_collocations(spark, str(tmp_path))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {t for _, t in got.dtypes} == {"string", "bigint"}
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)
    assert phrases.collocations(frame(spark, rows).filter("false")).count() == 0
    assert phrases.collocations(frame(spark, [("a b", "en")])).count() == 0


def test_borders_hold_the_budget(spark, rows):
    """Groups are near the budget, heavy words are split, and every suffix has one group."""
    rng = np.random.default_rng(1)
    data = [np.minimum(rng.geometric(0.3, 400) - 2, 50).astype("<i4") for _ in range(40)]
    coded = spark.createDataFrame([(bytearray(x.tobytes()),) for x in data], "data binary")
    budget = 600
    edges = phrases.borders(coded, 3, budget)
    all_rows = Counter()
    for x in data:
        cols, counts = phrases.suffixes(x, 3)
        group = phrases.place(cols, list(edges)) - 1
        assert group.min() >= 0 and (np.diff(group) >= 0).all()
        tuples = list(zip(*(c.tolist() for c in cols), strict=True))
        assert tuples == sorted(tuples) and counts.sum() == (x >= 0).sum()
        borders = list(zip(*edges.tolist(), strict=True))
        assert all(borders[g] <= t and (g + 1 == len(borders) or t < borders[g + 1]) for t, g in zip(tuples, group.tolist(), strict=True))
        all_rows.update(group.tolist())
    assert max(all_rows.values()) <= budget * 5 // 4 + 40 and sum(all_rows.values()) / len(all_rows) > budget / 8


def test_one_huge_piece_and_cut_texts():
    text = b"one two " * 1000
    assert list(phrases._cut(text, 100)) == [text]
    parts = list(phrases._cut(b"a b. c d, e f" * 50, 100))
    assert b"".join(parts) == b"a b. c d, e f" * 50 and all(p[-1:] in b".," for p in parts[:-1])


def test_many_equal_suffixes_are_one_row_a_chunk():
    cols, counts = phrases.suffixes(np.array([1, 2, 3, -1] * 1000, "<i4"), 3)
    assert [c.tolist() for c in cols] == [[1, 2, 3], [2, 3, -1], [3, -1, -1]] and counts.tolist() == [1000] * 3
