"""Cleaning, tokenising, query terms, file names (FIXTURES.md section 4)."""

import pytest
from pyspark.sql import functions as F

from termdex.functions.text import clean, doc_name, query_terms, term_array
from termdex.operators.search import parse_query


def _terms(spark, text):
    df = spark.createDataFrame([(text,)], "text string")
    return df.select(term_array("text").alias("t")).first()["t"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Cloud cloud, computing!\nIt's CLOUD-based.\n", ["cloud", "cloud", "computing", "it", "s", "cloud", "based"]),
        ("..., !!!\n\n", []),
        ("Città 2025 x_y", ["citt", "2025", "x", "y"]),
        ("cloud K İx", ["cloud", "x"]),  # N2: clean before lower
        ("a\x0bb", ["a", "b"]),  # vertical tab
        ("a\rb\r\nc", ["a", "b", "c"]),  # carriage returns
        ("  lead and trail  ", ["lead", "and", "trail"]),
        ("ÀB cd　EF", ["b", "cd", "ef"]),  # non-ASCII letters split, Unicode blanks split
        ("", []),
    ],
)
def test_term_array(spark, text, expected):
    assert _terms(spark, text) == expected


def test_null_text_gives_no_terms(spark):
    df = spark.createDataFrame([(None,)], "text string")
    assert df.select(F.explode(term_array("text"))).count() == 0


def test_clean_is_reference_p1(spark):
    df = spark.createDataFrame([("It's A-b\tc!",)], "text string")
    assert df.select(clean("text").alias("c")).first()["c"] == "it s a b\tc "


@pytest.mark.parametrize(
    "query, clean_query, expected",
    [
        ("cloud computing", False, ["cloud", "computing"]),
        ("  CLOUD   based ", False, ["cloud", "based"]),
        ("cloud cloud", False, ["cloud"]),
        ("", False, []),
        ("cloud-based", False, ["cloud-based"]),  # N4: not cleaned
        ("cloud-based", True, ["cloud", "based"]),
        ("città", False, ["città"]),
        ("a b\x1cc\x85d", False, ["a", "b", "c", "d"]),  # N9: Python whitespace
    ],
)
def test_query_terms_spark_and_driver_agree(spark, query, clean_query, expected):
    df = spark.createDataFrame([(query,)], "q string")
    got = df.select(query_terms("q", clean_query).alias("t")).first()["t"]
    assert got == expected
    assert parse_query(query, clean_query) == expected


@pytest.mark.parametrize(
    "path, expected",
    [
        ("file:/data/x/my%20doc.txt", "my doc.txt"),
        ("file:/data/a+b%20c%2520.txt", "a+b c%20.txt"),
        ("hdfs://nn/in/b.txt", "b.txt"),
        ("file:/x/a%zz.txt", "a%zz.txt"),
        ("file:/x/100%25.txt", "100%.txt"),
    ],
)
def test_doc_name_decodes(spark, path, expected):
    df = spark.createDataFrame([(path,)], "p string")
    assert df.select(doc_name("p").alias("d")).first()["d"] == expected


def test_whitespace_split_equals_python_for_every_bmp_char(spark):
    # N9: "a<c>b" splits exactly where Python's str.split() does, for every BMP character
    from termdex.functions.text import split_words

    chars = [c for c in range(1, 0x10000) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame([(c, f"a{chr(c)}b") for c in chars], "c int, s string")
    got = {r["c"]: r["w"] for r in df.select("c", split_words("s").alias("w")).collect()}
    bad = [c for c in chars if got[c] != f"a{chr(c)}b".split()]
    assert bad == []


def test_tokeniser_equals_reference_rule_on_random_text(spark):
    # Clean (keep [a-zA-Z0-9] and whitespace), lower, split -- as a Python rule
    import random
    import re

    rule = re.compile(r"[^a-zA-Z0-9\s]")
    alphabet = list("aZ09 x-_.,'!\t\n\r") + ["\x0b", "\x0c", "\x1c", "\x85", "\xa0", " ", "　",
                                            "é", "ß", "İ", "K", "ﬁ", "Ω", "ｆ", "😀", "�"]
    rng = random.Random(11)
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r["i"]: r["a"] for r in df.select("i", term_array("t").alias("a")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == rule.sub(" ", t).lower().split(), repr(t)


def test_query_lowering_matches_python_for_every_bmp_char(spark):
    # Queries are lower-cased like Python; any residual difference (characters newer
    # than the JVM's Unicode tables) stays non-ASCII, so it can never match a term
    from termdex.functions.text import lower_query

    chars = [c for c in range(1, 0x10000) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame([(c, f"A{chr(c)}I") for c in chars], "c int, s string")
    got = {r["c"]: r["l"] for r in df.select("c", lower_query("s").alias("l")).collect()}
    bad = [c for c in chars if got[c] != f"A{chr(c)}I".lower()]
    assert len(bad) < 20
    assert all(not chr(c).lower().isascii() and not got[c][1:-1].isascii() for c in bad)


def test_query_lowering_ignores_a_turkish_jvm_locale(tmp_path):
    # a separate JVM whose default locale lower-cases "I" to a dotless "ı"
    import os
    import subprocess
    import sys

    script = tmp_path / "tr.py"
    script.write_text(
        "import sys\n"
        f"sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})\n"
        "from pyspark.sql import SparkSession\n"
        "from termdex.functions.text import query_terms\n"
        "s = (SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false')\n"
        "     .config('spark.driver.extraJavaOptions', '-Duser.language=tr -Duser.country=TR').getOrCreate())\n"
        "df = s.createDataFrame([('IT \\u015f KELVIN \\u0130x',)], 'q string')\n"
        "print('RESULT', df.select(query_terms('q')).first()[0])\n"
        "s.stop()\n"
    )
    out = subprocess.run([sys.executable, str(script)], capture_output=True, text=True, timeout=300).stdout
    line = next(ln for ln in out.splitlines() if ln.startswith("RESULT"))
    assert line == "RESULT " + str("IT ş KELVIN İx".lower().split())
