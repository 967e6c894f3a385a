"""Near duplicates, components and top-k search against brute force; the pipeline."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from termdex.llm import neardup, topk
from termdex.llm.components import components


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_groups(rows):
    """Component and size of every row by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            same = rows[i][0] is not None and rows[i][0] == rows[j][0]
            if same or (a and b and 100 * len(a & b) >= 75 * len(a | b)):
                up[top(i)] = top(j)
    best = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            best[top(i)] = min(best.get(top(i), doc), doc)
    return sorted(((-1 if d is None else d, len(s), best.get(top(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10**6)}"
    return " ".join(out)


def sample_rows():
    rng = random.Random(11)
    texts = []
    for group in range(12):
        words = [f"g{group}x{rng.randrange(400)}" for _ in range(rng.choice([30, 80, 150]))]
        texts += [edited(rng, words, rng.randrange(5)) for _ in range(rng.choice([1, 3, 12]))]
    chain = [f"c{k}" for k in range(60)]
    for _ in range(8):  # each close to the next, the ends far apart
        texts.append(" ".join(chain))
        chain[rng.randrange(60)] = f"d{rng.randrange(10**6)}"
    texts += ["one two", "ONE two", "two one", "one two three four", "one two three four five", "", None, "   ", "the " * 5000, "the " * 4000]
    rng.shuffle(texts)
    return [(i, t) for i, t in enumerate(texts)]


def answers(df):
    return sorted(((-1 if r.doc_id is None else r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


@pytest.mark.parametrize("chunk", [1024, 3])
def test_near_duplicates_match_all_pairs(spark, monkeypatch, chunk):
    monkeypatch.setattr(neardup, "CHUNK", chunk)
    rows = sample_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("node", "label", "band", "kept", "sig")})
    got = neardup.near_duplicates(docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert answers(got) == brute_groups(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.collect())


def test_repeated_and_missing_ids(spark):
    a, b = " ".join(f"a{k}" for k in range(20)), " ".join(f"b{k}" for k in range(20))
    rows = [(5, a), (5, b), (7, b), (2, a), (2, a), (None, b), (None, "alone in the world here"), (None, None), (9, None)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    want = [(5, 16, 2), (5, 16, 2), (7, 16, 2), (2, 16, 2), (2, 16, 2), (-1, 16, 2), (-1, 1, None), (-1, 0, None), (9, 0, 9)]
    assert answers(got) == sorted(want, key=str)
    assert neardup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_least_matches_bounds_the_miss():
    rng = np.random.default_rng(0)
    least = neardup.LEAST[64]
    assert (rng.binomial(64, 0.75, 200_000) < least).mean() < 1e-4
    assert neardup.least_matches(64, 0.75, 0.5) > least


def test_components_of_random_edges(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1060)] + [(5, 5), (None, 4)]
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = top(a), top(b)
            up[max(a, b)] = min(a, b)
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: top(x) for x in up}


def brute_top(rows, k=5, every=50):
    v = [(i, np.floor(256 * np.array(x, float)).astype(object)) for i, x in rows if x is not None and all(c is not None and np.isfinite(c) for c in x)]
    out = set()
    for q, a in v:
        if q is None or q % every:
            continue
        found = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), (2**63 if i is None else i), i) for i, b in v if i != q)[:k]
        out |= {(q, r, i, int(-s)) for r, (s, _, i) in enumerate(found, 1)}
    return out


def test_top_k_matches_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 8)]) for i in range(700)]
    rows += [(1000 + i, rows[50][1]) for i in range(9)]  # ties
    rows += [(2000, None), (2050, []), (2100, [0.5, None]), (2150, [float("nan")] * 8), (2200, [float("inf")] * 8), (2250, [1.0, 2.0]), (None, [9.0] * 8), (2300, [1e5] * 8), (2301, [1e5] * 8), (2301, [1e5] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"score": F.lit(1), "q": F.lit(1), "v": F.lit(2)})
    want = brute_top(rows)
    for block, chunk, held in ((256, 4096, 32 << 20), (16, 5, 32 << 20), (16, 7, 4000)):
        monkeypatch.setattr(topk, "BLOCK", block)
        monkeypatch.setattr(topk, "HELD", held)
        got = topk.top_k(df, chunk=chunk)
        assert {tuple(r) for r in got.collect()} == want
    assert topk.top_k(df.filter("false")).count() == 0


def test_scores_beyond_doubles_stay_exact():
    a = np.array([[2**40, 3]], np.int64)
    b = np.array([[2**22, 1]], np.int64)
    assert topk._product(a, b)[0, 0] == 2**62 + 3
    with pytest.raises(OverflowError):
        topk._product(a, a)


def test_pruning_skips_blocks():
    rng = np.random.default_rng(1)
    near = rng.integers(50, 60, (20, 4))
    far = rng.integers(-60, -50, (topk.BLOCK * 30, 4))
    import pyarrow as pa

    v = np.concatenate([near, far])
    q = topk.Queries([(-1, [1, 1, 1, 1])])
    calls = []
    real = topk._product
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(len(v))), pa.array(v.tolist(), pa.list_(pa.int64()))], ["vec_id", "v"])
    topk._product = lambda a, b: calls.append(b.shape) or real(a, b)
    try:
        list(topk._search(lambda: q, 5, lambda: np.full(1, topk._Best.NONE), False)(iter([batch])))
    finally:
        topk._product = real
    assert len(calls) == 3  # two for the bounds, one block scored


def test_pipeline_effects(spark):
    import corpus_pipeline
    from termdex.llm.common import saved

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    extra = [(9001, "4111111111111111 12345 !!!", "en", "s", 1), (9002, None, "en", "s", 1), (9003, "", None, None, None)]
    docs = docs.union(spark.createDataFrame(extra, docs.schema)).union(docs.filter("doc_id = 1"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name != "sentencepiece":
            assert out.columns == columns
            docs = saved(out, name)
            kept[name] = {r.doc_id: r.text for r in docs.collect()}
            assert len(kept[name]) == docs.count() or name == "language_id"
    assert not {9001, 9002, 9003} & set(kept["language_id"])
    assert len(kept["near_dedup"]) < len(kept["language_id"])
    assert set(kept["decontamination"]) < set(kept["near_dedup"])
    assert set(kept["personal_data"]) == set(kept["decontamination"])
    assert any("<PHONE>" in t for t in kept["personal_data"].values()) and not any("@mail" in t for t in kept["personal_data"].values())
    assert {r.doc_id for r in out.collect()} == set(kept["personal_data"])


def test_pipeline_runs_whole(spark):
    import corpus_pipeline

    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert got.count() > 100 and got.filter("n_pieces <> size(ids)").count() == 0


def test_top_k_matches_its_sql(spark):
    import duckdb

    from termdex.llm.queries import ORACLE_SQL, QUERIES

    con = duckdb.connect()
    con.sql("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.001/embeddings.parquet'")
    want = con.sql(ORACLE_SQL["op8_top_k"])
    got = QUERIES["op8_top_k"](spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())
