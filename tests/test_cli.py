"""The command line runs the reference's jobs: build, search, batch, stats."""

import contextlib
import io

from conftest import HAND_INDEX_TAB
from termdex.__main__ import main


def _out(args):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        assert main(args) == 0
    return buf.getvalue().split()


def test_cli_build_search_batch_stats(spark, corpus_dir, tmp_path):
    text = str(tmp_path / "text")
    _out(["build", corpus_dir, text, "--parts", "2"])
    lines = sorted(r["value"] for r in spark.read.text(text).collect())
    assert lines == HAND_INDEX_TAB

    minus_one = str(tmp_path / "text-1")
    _out(["build", corpus_dir, minus_one, "--parts", "-1", "--sep", "spaces"])
    assert sorted(r["value"] for r in spark.read.text(minus_one).collect()) == [
        ln.replace("\t", "    ") for ln in HAND_INDEX_TAB
    ]

    pq = str(tmp_path / "pq")
    _out(["build", corpus_dir, pq, "--format", "parquet", "--whole"])
    assert sorted(_out(["search", pq, "cloud computing"])) == ["a.txt", "b.txt"]
    assert _out(["search", text, "citt 2025", "--format", "text"]) == ["d.txt"]
    assert _out(["stats", pq]) == ["num_terms=11", "tot_terms=15"]

    qfile = tmp_path / "queries.txt"
    qfile.write_text("cloud computing\ncloud missing\nCLOUD based\n")
    out = str(tmp_path / "batch")
    _out(["batch", pq, str(qfile), out])
    queries = {r["query_id"]: r["query"] for r in spark.read.parquet(f"{out}/queries").collect()}
    answers = sorted((queries[r["query_id"]], r["doc"]) for r in spark.read.parquet(f"{out}/answers").collect())
    assert answers == [("CLOUD based", "a.txt"), ("cloud computing", "a.txt"), ("cloud computing", "b.txt")]
    # the shared test session is still usable afterwards
    assert spark.range(3).count() == 3


def test_search_writes_its_answer_and_parts_are_shown(spark, corpus_dir, tmp_path, capsys):
    out = str(tmp_path / "index")
    assert main(["build", corpus_dir, out, "--layout", "exact", "--parts", "4"]) == 0
    size = sum(len(x) + 1 for x in HAND_INDEX_TAB)
    assert capsys.readouterr().out == f"terms=11 occurrences=15 postings=13 lines=11 bytes={size}\n"
    assert main(["search", out, "cloud computing", "--format", "text", "--out", str(tmp_path / "answer")]) == 0
    assert capsys.readouterr().out == ""
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "answer")).collect()) == ["a.txt", "b.txt"]
    assert main(["parts", out]) == 0
    rows = [x.split("\t") for x in capsys.readouterr().out.splitlines()]
    assert [(r[1], r[3], r[4], r[5]) for r in rows] == [("3", "2025", "based", "True"), ("3", "citt", "computing", "True"), ("3", "it", "s", "True"), ("2", "x", "y", "True")]
