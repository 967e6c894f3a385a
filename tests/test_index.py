"""Build, format, store and read the index."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import HAND_INDEX_TAB, SF_SMALL
from termdex.functions.text import SPACES_SEP
from termdex.operators.index import grouped, merge_postings, postings, stats, tokens
from termdex.operators.lines import format_lines, parse_lines
from termdex.session import shared_dir
from termdex.sources.files import from_table, read_table
from termdex.sources.index_io import read_index, read_text_index, read_text_lines, write_index, write_text_index


def _lines(df):
    return sorted(r["line"] for r in df.select("line").collect())


def _post_set(df):
    return sorted((r["term"], str(r["doc"]), r["tf"]) for r in df.select("term", "doc", "tf").collect())


def test_hand_index_tab(hand_docs):
    assert _lines(format_lines(postings(hand_docs))) == HAND_INDEX_TAB


def test_hand_index_spaces(hand_docs):
    want = [line.replace("\t", SPACES_SEP) for line in HAND_INDEX_TAB]
    assert _lines(format_lines(postings(hand_docs), SPACES_SEP)) == want


def test_hand_stats(hand_docs):
    post = postings(hand_docs)
    s = stats(post).first()
    assert (s["num_terms"], post.count(), s["tot_terms"]) == (11, 13, 15)


def test_stats_of_empty_index(spark):
    empty = spark.createDataFrame([], "term string, doc string, tf bigint")
    s = stats(empty).first()
    assert (s["num_terms"], s["tot_terms"]) == (0, 0)


def test_invariants_on_table(spark):
    docs = from_table(read_table(spark, SF_SMALL, "documents"))
    post = postings(docs, "auto")
    toks = tokens(docs)
    assert post.agg(F.sum("tf")).first()[0] == toks.count()
    assert post.groupBy("term", "doc").count().filter("count > 1").count() == 0
    assert post.filter("tf < 1").count() == 0
    assert post.filter(~F.col("term").rlike("^[a-z0-9]+$")).count() == 0
    s = stats(post).first()
    assert (post.count(), s["num_terms"], s["tot_terms"]) == (46720, 19010, 81395)


def test_lines_equal_whole_texts(spark):
    docs = from_table(read_table(spark, SF_SMALL, "documents"))
    lines = docs.select("doc", F.explode(F.split("text", "\n")).alias("text"))
    assert postings(lines).exceptAll(postings(docs)).count() == 0
    assert postings(docs).exceptAll(postings(lines)).count() == 0


def test_merge_of_halves_equals_whole(spark):
    conv = read_table(spark, SF_SMALL, "conversations")
    whole = postings(from_table(conv, "conv_id"))
    a = postings(from_table(conv.filter("turn % 2 = 0"), "conv_id"))
    b = postings(from_table(conv.filter("turn % 2 = 1"), "conv_id"))
    merged = merge_postings(a, b)
    assert merged.exceptAll(whole).count() == 0 and whole.exceptAll(merged).count() == 0
    # the halves do meet: some (term, doc) pairs are in both
    assert a.join(b, ["term", "doc"]).count() > 0


def test_merge_needs_input():
    with pytest.raises(ValueError):
        merge_postings()


def test_grouped_blocks_bound_rows(spark):
    docs = from_table(read_table(spark, SF_SMALL, "documents"))
    post = postings(docs)
    g = grouped(post, block_bits=4)
    assert g.select(F.max(F.size("postings"))).first()[0] <= 64
    # short lists are never cut
    assert g.groupBy("term").agg(F.count("*").alias("k"), F.sum(F.size("postings")).alias("n")).filter("n <= 16 and k > 1").count() == 0
    flat = g.select("term", F.explode("postings").alias("p")).select("term", "p.doc", "p.tf")
    assert flat.exceptAll(post).count() == 0 and post.exceptAll(flat).count() == 0
    # entries of a row are sorted by doc
    assert g.filter(F.col("postings") != F.sort_array("postings")).count() == 0


def test_blocked_lines_read_back(spark, tmp_path):
    docs = from_table(read_table(spark, SF_SMALL, "documents"))
    post = postings(docs)
    path = str(tmp_path / "idx")
    write_text_index(post, path, parts=3, block_bits=4)
    back = read_text_index(spark, path).select("term", F.col("doc").cast("bigint").alias("doc"), "tf")
    assert back.exceptAll(post).count() == 0 and post.exceptAll(back).count() == 0


@pytest.mark.parametrize("layout", ["hash", "round", "range"])
def test_text_round_trip_layouts(spark, hand_docs, tmp_path, layout):
    post = postings(hand_docs)
    path = str(tmp_path / f"idx-{layout}")
    write_text_index(post, path, parts=3, layout=layout)
    parts = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(parts) <= 3
    assert _post_set(read_text_index(spark, path)) == _post_set(post)
    if layout in ("hash", "range"):
        for f in parts:  # K2 / K4: terms sorted within each part
            terms = [ln.split("\t")[0] for ln in open(os.path.join(path, f)).read().splitlines()]
            assert terms == sorted(terms)
    if layout == "range":  # K4: parts hold contiguous term ranges
        spans = []
        for f in sorted(parts):
            terms = [ln.split("\t")[0] for ln in open(os.path.join(path, f)).read().splitlines()]
            if terms:
                spans.append((terms[0], terms[-1]))
        assert all(spans[i][1] < spans[i + 1][0] for i in range(len(spans) - 1))


def test_text_sink_refuses_existing_output(spark, hand_docs, tmp_path):
    path = str(tmp_path / "idx")
    write_text_index(postings(hand_docs), path)
    with pytest.raises(Exception):
        write_text_index(postings(hand_docs), path)


def test_text_sink_refuses_blank_in_doc_name(spark, tmp_path):
    docs = spark.createDataFrame([("my doc.txt", "cloud")], "doc string, text string")
    with pytest.raises(Exception):
        write_text_index(postings(docs), str(tmp_path / "idx"))
    # Parquet keeps such names
    path = str(tmp_path / "pq")
    write_index(postings(docs), path)
    assert read_index(spark, path).first()["doc"] == "my doc.txt"


def test_parse_lines_edge_cases(spark):
    lines = spark.createDataFrame(
        [("t\tf1:1",), ("t    f2:1",), ("",), ("   ",), ("u  a:b.txt:4",), ("v",), ("w x",), ("z d:abc",)],
        "value string",
    )
    got = sorted(tuple(r) for r in parse_lines(lines).collect())
    assert got == [("t", "f1", 1), ("t", "f2", 1), ("u", "a:b.txt", 4), ("w", "x", None), ("z", "d", None)]


def test_parquet_index_sorted_and_round_trip(spark, tmp_path):
    docs = from_table(read_table(spark, SF_SMALL, "documents"))
    post = postings(docs)
    path = shared_dir(spark, "test-pq")
    write_index(post, path, parts=4)
    back = read_index(spark, path)
    assert back.exceptAll(post).count() == 0 and post.exceptAll(back).count() == 0
    # each file is sorted by (term, doc) and files cover disjoint term ranges
    files = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))
    import pyarrow.parquet as pq

    spans = []
    for f in files:
        t = pq.read_table(os.path.join(path, f)).to_pylist()
        keys = [(r["term"], r["doc"]) for r in t]
        assert keys == sorted(keys)
        if keys:
            spans.append((keys[0], keys[-1]))
    assert all(spans[i][1] < spans[i + 1][0] for i in range(len(spans) - 1))


def test_text_lines_reader_reads_all_parts(spark, hand_docs, tmp_path):
    path = str(tmp_path / "idx")
    write_text_index(postings(hand_docs), path, parts=2)
    assert read_text_lines(spark, path).count() == 11


def test_long_lists_are_cut_whatever_the_key(spark, tmp_path):
    for kind, name in (("string", lambda i: f"f{i}.txt"), ("bigint", lambda i: i << 40)):
        docs = spark.createDataFrame([(name(i), "cloud computing") for i in range(100)], f"doc {kind}, text string")
        post = postings(docs)
        lines = format_lines(post, block_bits=4).select("line").collect()
        sizes = [len(r["line"].split("\t")) - 1 for r in lines if r["line"].startswith("cloud\t")]
        assert sum(sizes) == 100 and 3 <= len(sizes) <= 7
        path = str(tmp_path / f"idx-{kind}")
        write_text_index(post, path, block_bits=4)
        assert read_text_index(spark, path).count() == 200
        # one line per term up to the block's size
        assert format_lines(post).count() == 2


def test_lines_depend_on_no_partitioning(spark):
    docs = spark.createDataFrame([(f"f{i}", "cloud x" if i % 2 else "cloud y") for i in range(60)], "doc string, text string")
    want = None
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        for aqe, parts in (("true", "8"), ("false", "1"), ("false", "40")):
            spark.conf.set("spark.sql.adaptive.enabled", aqe)
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got = sorted(r["line"] for r in format_lines(postings(docs.repartition(7)), block_bits=5).collect())
            want = want or got
            assert got == want and len(got) == 4
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_empty_corpus_through_every_operator(spark, tmp_path):
    from termdex.operators.search import search_all, search_all_intersect, search_batch, search_stored

    docs = spark.createDataFrame([(1, "..."), (2, "")], "doc bigint, text string")
    post = postings(docs)
    assert post.count() == 0
    assert format_lines(post).count() == 0 and grouped(post).count() == 0
    path = str(tmp_path / "txt")
    write_text_index(post, path)
    assert read_text_index(spark, path).count() == 0
    pq = str(tmp_path / "pq")
    write_index(post, pq)
    assert search_stored(spark, pq, "a b").count() == 0
    assert search_all(post, "a").count() == 0 and search_all_intersect(post, "a b").count() == 0
    qs = spark.createDataFrame([(1, "a"), (2, "a b")], "query_id bigint, query string")
    assert search_batch(post, qs).count() == 0


def test_parse_lines_with_unicode_blanks(spark):
    # An index line may separate its words with any whitespace Python's split() knows
    lines = spark.createDataFrame([("t f1:2　f2:1",), (" u\u0085f3:4",)], "value string")
    got = sorted(tuple(r) for r in parse_lines(lines).collect())
    assert got == [("t", "f1", 2), ("t", "f2", 1), ("u", "f3", 4)]


def test_common_term_lines_spread_over_parts(spark, tmp_path):
    # 64 documents all holding "cloud", blocks of 4 -> 16 lines for one term
    docs = spark.createDataFrame([(i, "cloud") for i in range(64)], "doc bigint, text string")
    path = str(tmp_path / "idx")
    write_text_index(postings(docs), path, parts=4, block_bits=2)
    holding = [f for f in os.listdir(path) if f.startswith("part-") and open(os.path.join(path, f)).read()]
    assert len(holding) > 1
    assert read_text_index(spark, path).count() == 64


def test_text_sink_refuses_null_doc_key(spark, tmp_path):
    docs = spark.createDataFrame([(None, "cloud"), (1, "cloud")], "doc bigint, text string")
    with pytest.raises(Exception):
        write_text_index(postings(docs), str(tmp_path / "idx"))
    with pytest.raises(Exception):
        write_index(postings(docs), str(tmp_path / "pq"))
    names = spark.createDataFrame([(None, "cloud"), ("a", "cloud")], "doc string, text string")
    with pytest.raises(Exception):
        write_text_index(postings(names), str(tmp_path / "names"))


def test_text_form_round_trips_random_string_names(spark):
    # doc names may hold colons and non-ASCII letters (not whitespace): format -> parse is exact
    import random

    rng = random.Random(5)
    alphabet = list("abcXYZ019_-.:") + ["é", "ß", "ü", "中"]
    names = list({"".join(rng.choice(alphabet) for _ in range(rng.randint(1, 8))) for _ in range(60)})
    terms = [f"t{i}" for i in range(15)]
    rows = {(rng.choice(terms), rng.choice(names)): rng.randint(1, 9) for _ in range(400)}
    post = spark.createDataFrame([(t, d, n) for (t, d), n in rows.items()], "term string, doc string, tf bigint")
    lines = format_lines(post, block_bits=3).select(F.col("line").alias("value"))
    back = parse_lines(lines)
    assert sorted(map(tuple, back.collect())) == sorted((t, d, n) for (t, d), n in rows.items())
