"""Incremental indexing with Structured Streaming: partials per micro-batch, merged on read."""

import os

from termdex.operators.index import postings
from termdex.sources.files import read_lines
from termdex.streaming.ingest import compact, index_stream, read_merged, read_partials, stream_text_files
from termdex.sources.index_io import read_index


def _set(df):
    return sorted((r["term"], r["doc"], r["tf"]) for r in df.select("term", "doc", "tf").collect())


def test_two_waves_merge_like_batch(spark, tmp_path):
    src = tmp_path / "in"
    (src / "w1").mkdir(parents=True)
    (src / "w1" / "a.txt").write_text("cloud cloud computing")
    (src / "w1" / "b.txt").write_text("on a cloud")
    idx, cp = str(tmp_path / "idx"), str(tmp_path / "cp")

    index_stream(stream_text_files(spark, str(src / "*")), idx, cp).awaitTermination()
    assert _set(read_merged(spark, idx)) == _set(postings(read_lines(spark, str(src))))

    # second wave: a new file, and more text for an existing document name
    (src / "w2").mkdir()
    (src / "w2" / "c.txt").write_text("computing grid")
    (src / "w2" / "a.txt").write_text("cloud")
    index_stream(stream_text_files(spark, str(src / "*")), idx, cp).awaitTermination()
    merged = read_merged(spark, idx)
    assert _set(merged) == _set(postings(read_lines(spark, str(src))))
    assert ("cloud", "a.txt", 3) in _set(merged)
    assert read_partials(spark, idx).select("epoch").distinct().count() == 2

    # a restart with nothing new indexes nothing again
    index_stream(stream_text_files(spark, str(src / "*")), idx, cp).awaitTermination()
    assert _set(read_merged(spark, idx)) == _set(merged)

    out = str(tmp_path / "compact")
    compact(spark, idx, out)
    assert _set(read_index(spark, out)) == _set(merged)


def test_one_file_per_trigger(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for i in range(3):
        (src / f"f{i}.txt").write_text(f"shared word{i}")
    idx = str(tmp_path / "idx")
    index_stream(stream_text_files(spark, str(src), max_files=1), idx, str(tmp_path / "cp")).awaitTermination()
    assert len([d for d in os.listdir(idx) if d.startswith("epoch=")]) == 3
    assert _set(read_merged(spark, idx)) == _set(postings(read_lines(spark, str(src))))


def test_restart_without_explicit_checkpoint_resumes(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("cloud cloud")
    idx = str(tmp_path / "idx")
    index_stream(stream_text_files(spark, str(src)), idx).awaitTermination()
    (src / "b.txt").write_text("cloud")
    index_stream(stream_text_files(spark, str(src)), idx).awaitTermination()
    assert _set(read_merged(spark, idx)) == [("cloud", "a.txt", 2), ("cloud", "b.txt", 1)]
    assert os.path.isdir(os.path.join(idx, "_checkpoint"))


def test_continuous_trigger_indexes_new_files(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("cloud computing")
    idx = str(tmp_path / "idx")
    q = index_stream(stream_text_files(spark, str(src)), idx, available_now=False, processing_time="1 second")
    try:
        q.processAllAvailable()
        (src / "b.txt").write_text("cloud")
        q.processAllAvailable()
    finally:
        q.stop()
    assert _set(read_merged(spark, idx)) == [("cloud", "a.txt", 1), ("cloud", "b.txt", 1), ("computing", "a.txt", 1)]


def test_streams_with_their_own_checkpoints_add_up(spark, tmp_path):
    for name, text in (("a", "cloud cloud"), ("b", "cloud grid")):
        (tmp_path / name).mkdir()
        (tmp_path / name / f"{name}.txt").write_text(text)
    idx = str(tmp_path / "idx")
    for name in ("a", "b"):
        index_stream(stream_text_files(spark, str(tmp_path / name)), idx, str(tmp_path / f"cp-{name}")).awaitTermination()
    assert set(_set(read_merged(spark, idx))) == {("cloud", "a.txt", 2), ("cloud", "b.txt", 1), ("grid", "b.txt", 1)}
