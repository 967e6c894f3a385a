"""File sources, document names, hidden files."""

from termdex.operators.index import postings
from termdex.operators.lines import format_lines
from termdex.sources.files import read_lines, read_whole

from conftest import HAND_INDEX_TAB


def _lines(df):
    return sorted(r["line"] for r in format_lines(df).select("line").collect())


def test_whole_files_give_hand_index(spark, corpus_dir):
    assert _lines(postings(read_whole(spark, corpus_dir))) == HAND_INDEX_TAB


def test_lines_give_same_index(spark, corpus_dir):
    assert _lines(postings(read_lines(spark, corpus_dir, partitions=3))) == HAND_INDEX_TAB


def test_encoded_names_are_decoded(spark, tmp_path):
    d = tmp_path / "c"
    d.mkdir()
    (d / "my doc.txt").write_text("alpha")
    (d / "a+b c%20.txt").write_text("beta")
    names = sorted(r["doc"] for r in read_whole(spark, str(d)).collect())
    assert names == ["a+b c%20.txt", "my doc.txt"]
    names = sorted({r["doc"] for r in read_lines(spark, str(d)).collect()})
    assert names == ["a+b c%20.txt", "my doc.txt"]


def test_same_basename_is_one_document(spark, tmp_path):
    for sub in ("x", "y"):
        (tmp_path / "in" / sub).mkdir(parents=True)
        (tmp_path / "in" / sub / "b.txt").write_text("cloud")
    rows = postings(read_lines(spark, str(tmp_path / "in"))).collect()
    assert [(r["term"], r["doc"], r["tf"]) for r in rows] == [("cloud", "b.txt", 2)]


def test_hidden_files_skipped_and_recursive(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "_h.txt").write_text("hidden")
    (tmp_path / "in" / "top.txt").write_text("top")
    (tmp_path / "in" / "sub" / "deep.txt").write_text("deep")
    docs = sorted(r["doc"] for r in read_whole(spark, str(tmp_path / "in")).collect())
    assert docs == ["deep.txt", "top.txt"]
    flat = sorted(r["doc"] for r in read_whole(spark, str(tmp_path / "in" / "*.txt"), recursive=False).collect())
    assert flat == ["top.txt"]


def test_several_input_paths(spark, tmp_path):
    for sub, text in (("p", "one"), ("q", "two")):
        (tmp_path / sub).mkdir()
        (tmp_path / sub / f"{sub}.txt").write_text(text)
    docs = sorted(r["doc"] for r in read_lines(spark, [str(tmp_path / "p"), str(tmp_path / "q")]).collect())
    assert docs == ["p.txt", "q.txt"]


def test_bad_utf8_bytes_become_separators(spark, tmp_path):
    d = tmp_path / "bad"
    d.mkdir()
    (d / "x.txt").write_bytes(bytes([0x64, 0xFF, 0x20, 0x65]))
    terms = sorted(r["term"] for r in postings(read_whole(spark, str(d))).collect())
    assert terms == ["d", "e"]


def test_table_written_as_files_gives_same_stats(spark, tmp_path):
    # the reference's input shape: a folder of text files, scanned line by line
    from pyspark.sql import functions as F

    from conftest import SF_SMALL
    from termdex.operators.index import stats
    from termdex.sources.files import from_table, read_table

    docs = from_table(read_table(spark, SF_SMALL, "documents"))
    corpus = str(tmp_path / "corpus")
    docs.select("text").repartition(4).write.text(corpus)
    by_file = postings(read_lines(spark, corpus))
    assert by_file.select("doc").distinct().count() == 4
    want, got = stats(postings(docs)).first(), stats(by_file).first()
    assert (got["num_terms"], got["tot_terms"]) == (want["num_terms"], want["tot_terms"])
    # per term, the counts summed over files equal the counts summed over documents
    a = postings(docs).groupBy("term").agg(F.sum("tf").alias("n"))
    b = by_file.groupBy("term").agg(F.sum("tf").alias("n"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
