"""Byte-level BPE against the library over whole texts."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from termdex.llm import byte_bpe, queries

SPACES = list(" \n\t\r\x0b\x0c\x85\xa0\u1680\u2000\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
ODD = SPACES + list("\x1c\x1f​'’-=_12é中\U0001f642́") + ["'s", "'LL", "ab", "the", "don't", "\r\n"]


@pytest.fixture(scope="module")
def coder():
    return byte_bpe.Coder(byte_bpe.public_ranks(), run=6, part=7)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(ODD), max_size=60).map("".join))
def test_cut_texts_have_the_ids_of_whole_texts(text):
    c = _small()
    whole = c.library.encode_ordinary(text)
    assert c.encode(text) == whole
    assert c.decode(whole) == text.encode()


_CACHE = []


def _small():
    if not _CACHE:
        _CACHE.append(byte_bpe.Coder(byte_bpe.public_ranks(), run=6, part=7))
    return _CACHE[0]


def test_parts_keep_every_character_and_cut_before_blanks(coder):
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice(ODD) for _ in range(rng.randint(0, 80)))
        got = list(byte_bpe.parts(text, 7))
        assert "".join(got) == text
        assert all(x.startswith(" ") and not y[-1].isspace() for y, x in zip(got, got[1:]))


def test_runs_that_stop_the_library():
    """A run of white space that overflows the library's matcher is one match here."""
    c = byte_bpe.Coder(byte_bpe.public_ranks())
    n = 1_500_000
    for run in (" ", "\n"):
        word = c.library.encode_ordinary(" x" if run == " " else "\nx")
        got = c.encode("a" + run * n + "x")
        assert got == [*c.library.encode_ordinary("a"), *c.library._encode_single_piece(run * (n - 1)), *word]
        assert c.decode(got) == ("a" + run * n + "x").encode()
    assert c.decode(c.encode("y" * n)) == b"y" * n


def test_query_gives_the_library_s_ids_and_the_text_s_bytes(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice(ODD) for _ in range(rng.randint(0, 200)))) for i in range(300)]
    rows += [(300, None), (301, ""), (3, "again"), (3, "again"), (None, "no id"), (302, "long text, " * 200_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit("x"), "n_tokens": F.lit(1)})
    df.write.parquet(str(tmp_path / "documents.parquet"))
    library = _small().library
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    got = queries.op12_byte_bpe(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_nulls_and_empty_tables(spark):
    ranks = byte_bpe.public_ranks()
    df = spark.createDataFrame([(None,), ("",), ("hi there",)], "text string")
    coded = df.withColumn("ids", byte_bpe.encode(spark, ranks, F.col("text")))
    got = coded.select("text", "ids", byte_bpe.decode(spark, ranks, F.col("ids")).alias("b"), byte_bpe.id_bytes(F.col("ids")).alias("raw")).collect()
    assert got[0].ids is None and got[0].b is None and got[0].raw is None
    assert got[1].ids == [] and bytes(got[1].b) == b"" and bytes(got[1].raw) == b""
    assert bytes(got[2].b) == b"hi there" and np.frombuffer(bytes(got[2].raw), "<u4").tolist() == got[2].ids
    assert coded.filter("false").count() == 0
