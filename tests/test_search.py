
import random

import pytest
from pyspark.sql import functions as F

from termdex.operators.index import postings
from termdex.operators.search import search_all, search_all_intersect, search_batch, search_stored
from termdex.sources.index_io import write_index, write_text_index

HAND_QUERIES = [
    ("cloud computing", ["a.txt", "b.txt"]),
    ("  CLOUD   based ", ["a.txt"]),
    ("cloud cloud", ["a.txt", "b.txt"]),
    ("cloud missing", []),
    ("", []),
    ("cloud-based", []),
    ("città", []),
    ("citt 2025", ["d.txt"]),
]


def _docs(df):
    return sorted(r["doc"] for r in df.collect())


@pytest.fixture()
def hand_post(hand_docs):
    return postings(hand_docs).cache()


@pytest.mark.parametrize("query, expected", HAND_QUERIES)
def test_search_all(hand_post, query, expected):
    assert _docs(search_all(hand_post, query)) == expected


@pytest.mark.parametrize("query, expected", HAND_QUERIES)
def test_search_all_intersect_twin(hand_post, query, expected):
    assert _docs(search_all_intersect(hand_post, query)) == expected


@pytest.mark.parametrize("query, expected", HAND_QUERIES)
@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_rarest_first_with_and_without_broadcast(hand_post, query, expected, limit):
    assert _docs(search_all(hand_post, query, rarest_first=True, max_broadcast_bytes=limit)) == expected


def test_rarest_first_drops_hits_before_the_shuffle(hand_post):
    from termdex.plans import inspect

    # the documents themselves, or above the limit the bitmap of their hashes
    for limit in (1 << 20, 0):
        plan = inspect.plan_string(search_all(hand_post, "a cloud", rarest_first=True, max_broadcast_bytes=limit))
        assert "BroadcastHashJoin" in plan and plan.index("REPARTITION_BY_COL") < plan.index("BroadcastHashJoin")
        assert ("bitmap_construct_agg" in plan) == (limit == 0)


def test_search_batch_matches_hand_table(spark, hand_post):
    qs = spark.createDataFrame([(i, q) for i, (q, _) in enumerate(HAND_QUERIES)], "query_id bigint, query string")
    got = {}
    for r in search_batch(hand_post, qs).collect():
        got.setdefault(r["query_id"], []).append(r["doc"])
    for i, (_, expected) in enumerate(HAND_QUERIES):
        assert sorted(got.get(i, [])) == expected


def test_search_batch_without_broadcast(spark, hand_post):
    qs = spark.createDataFrame([(i, q) for i, (q, _) in enumerate(HAND_QUERIES)], "query_id bigint, query string")
    want = sorted(map(tuple, search_batch(hand_post, qs).collect()))
    got = search_batch(hand_post, qs, max_broadcast_terms=0, max_broadcast_query_terms=0)
    assert sorted(map(tuple, got.collect())) == want
    got = search_batch(hand_post, qs, max_broadcast_terms=0, max_broadcast_query_terms=0, max_broadcast_probes=0)
    assert sorted(map(tuple, got.collect())) == want


def test_foreign_duplicates_on_shuffled_path(spark):
    post = spark.createDataFrame([("a", "d1", 1), ("a", "d1", 1), ("b", "d2", 1)], "term string, doc string, tf bigint")
    qs = spark.createDataFrame([(1, "a b"), (2, "a")], "query_id bigint, query string")
    got = search_batch(post, qs, max_broadcast_terms=0, max_broadcast_query_terms=0, max_broadcast_probes=0)
    assert sorted(map(tuple, got.collect())) == [(2, "d1")]


def test_search_batch_all_empty_queries(spark, hand_post):
    qs = spark.createDataFrame([(1, ""), (2, "   ")], "query_id bigint, query string")
    assert search_batch(hand_post, qs).count() == 0


def test_clean_query_option(hand_post):
    assert _docs(search_all(hand_post, "cloud-based", clean_query=True)) == ["a.txt"]


@pytest.mark.parametrize("fmt", ["parquet", "text"])
@pytest.mark.parametrize("query, expected", HAND_QUERIES)
def test_search_stored(spark, hand_post, tmp_path_factory, fmt, query, expected):
    path = str(tmp_path_factory.mktemp("idx") / "index")
    if fmt == "parquet":
        write_index(hand_post, path)
    else:
        write_text_index(hand_post, path, parts=2)
    assert _docs(search_stored(spark, path, query, fmt)) == expected


def test_stored_text_unions_repeated_term(spark, tmp_path):
    d = tmp_path / "idx"
    d.mkdir()
    (d / "part1.txt").write_text("t    f1:1\nu    f1:2")
    (d / "part2.txt").write_text("t\tf2:1\n\nu\tf2:5\n")
    assert _docs(search_stored(spark, str(d), "t", "text")) == ["f1", "f2"]
    assert _docs(search_stored(spark, str(d), "t u", "text")) == ["f1", "f2"]


def test_foreign_duplicate_pairs_counted_once(spark):
    # the same (term, doc) twice, as a hand-made text index could hold
    post = spark.createDataFrame([("a", "d1", 1), ("a", "d1", 1), ("b", "d2", 1)], "term string, doc string, tf bigint")
    assert _docs(search_all(post, "a b")) == []
    qs = spark.createDataFrame([(1, "a b"), (2, "a")], "query_id bigint, query string")
    assert sorted(map(tuple, search_batch(post, qs).collect())) == [(2, "d1")]


def test_random_corpora_against_brute_force(spark):
    rng = random.Random(7)
    vocab = [f"w{i}" for i in range(12)]
    docs = [(d, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 15)))) for d in range(60)]
    queries = [(q, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 4)))) for q in range(80)]
    post = postings(spark.createDataFrame(docs, "doc bigint, text string")).cache()
    qs = spark.createDataFrame(queries, "query_id bigint, query string")

    def brute(q):
        terms = set(q.split())
        if not terms:
            return []
        return sorted(d for d, t in docs if terms <= set(t.split()))

    got = {}
    for r in search_batch(post, qs).collect():
        got.setdefault(r["query_id"], []).append(r["doc"])
    for qid, q in queries:
        assert sorted(got.get(qid, [])) == brute(q), q
    for qid, q in queries[:6]:
        assert _docs(search_all(post, q)) == brute(q)


@pytest.mark.parametrize("fmt", ["parquet", "text"])
def test_resident_index_answers_like_stored(spark, hand_post, tmp_path, fmt):
    from termdex.operators.search import resident_index

    path = str(tmp_path / "index")
    (write_index if fmt == "parquet" else write_text_index)(hand_post, path)
    res = resident_index(spark, path, fmt)
    for query, expected in HAND_QUERIES:
        assert _docs(search_all(res, query)) == expected
    res.unpersist()


def test_stored_indexes_are_searched_rarest_first(spark, hand_docs, tmp_path):
    from termdex.plans import inspect
    from termdex.sources.index_io import read_index

    path = str(tmp_path / "index")
    write_index(postings(hand_docs), path)
    build, stored, cached = postings(hand_docs), read_index(spark, path), postings(hand_docs).cache()
    for post, first in ((build, False), (stored, True), (cached, True)):
        got = search_all(post, "a cloud")
        assert ("BroadcastHashJoin" in inspect.plan_string(got)) == first
        assert _docs(got) == ["b.txt"]
    cached.unpersist()


def test_bitmap_keeps_the_rarest_words_documents_and_few_others(spark, monkeypatch):
    from termdex.operators import search

    hits = spark.range(5000).selectExpr("'common' AS term", "concat('d', id) AS doc")
    docs = spark.range(0, 5000, 100).selectExpr("concat('d', id) AS doc")
    inside = search._in_bitmap(hits, docs, search.bitmap_bits(50))
    got = {r.doc for r in inside.collect()}
    want = {r.doc for r in docs.collect()}
    assert want <= got and len(got) < 70
    # a full bitmap lets everything through, and the answer is still exact
    post = hits.union(docs.selectExpr("'rare' AS term", "doc"))
    monkeypatch.setattr(search, "bitmap_bits", lambda n: 16)
    assert set(_docs(search_all(post, "common rare", rarest_first=True, max_broadcast_bytes=0))) == want


@pytest.mark.parametrize("n_docs, bits", [(0, 1 << 15), (1, 1 << 15), (4096, 1 << 15), (4097, 1 << 16), (10**12, 1 << 30)])
def test_bitmap_sizes(n_docs, bits):
    from termdex.operators.search import bitmap_bits

    assert bitmap_bits(n_docs) == bits


@pytest.mark.parametrize("n", [1, 12, 63, 64, 70, 127])
def test_intersect_by_masks(spark, n):
    from termdex.plans import inspect

    words = [f"w{k}" for k in range(n)]
    rows = [(w, d) for d in ("all", "also") for w in words] + [(w, "but one") for w in words[1:]] + [(w, "last") for w in words[-1:]] + [("other", "all")]
    post = spark.createDataFrame(rows + rows[:3], "term string, doc string")
    got = search_all_intersect(post, " ".join(words))
    plan = inspect.plan_string(got)
    # one exchange with a combine below it; no join and no table or checkpoint in between
    assert plan.count("Exchange hash") == 1 and inspect.partial_aggregate_below_exchange(got)
    assert "Join" not in plan and "parquet" not in plan.lower() and "Scan ExistingRDD" in plan
    assert _docs(got) == sorted(["all", "also"] + (["last"] if n == 1 else []))
    assert _docs(search_all_intersect(post, " ".join(words) + " absent")) == []


def batch_frame(spark, rng, n_docs=400):
    """Postings with a word in every document, and queries that all hold it; one query has only that word."""
    vocab = [f"w{i}" for i in range(30)]
    docs = [(d, " ".join(["hot"] + rng.choices(vocab, k=rng.randint(0, 10)))) for d in range(n_docs)]
    queries = [(q, " ".join(["hot"] + rng.choices(vocab, k=rng.randint(0, 2)))) for q in range(60)] + [(60, "hot"), (61, "hot absent"), (62, "HOT  hot")]
    return docs, queries


@pytest.mark.parametrize("limit", [0, 1 << 27])
def test_batch_with_a_hot_word_and_a_hot_query(spark, limit):
    docs, queries = batch_frame(spark, random.Random(9))
    post = postings(spark.createDataFrame(docs, "doc bigint, text string")).cache()
    qs = spark.createDataFrame(queries, "query_id bigint, query string")
    want = sorted((q, d) for q, text in queries for d, words in docs if set(text.lower().split()) <= set(words.split()))
    got = search_batch(post, qs, max_broadcast_terms=limit, max_broadcast_query_terms=limit, max_broadcast_probes=limit, salt_rows=25)
    assert sorted(map(tuple, got.collect())) == want


def test_salts_deal_a_hot_key(spark):
    """No key of a salted join has much more than ``salt_rows`` rows, and each row meets its partner once."""
    from termdex.operators import search

    post = spark.range(10_000).selectExpr("if(id % 3 = 0, 'hot', concat('t', id % 100)) AS term", "id AS doc")
    dfreq = post.groupBy("term").agg(F.count("doc").alias("df"))
    hot = search.hot_terms(dfreq, 200)
    assert [(r.term, r.salts) for r in hot.collect()] == [("hot", 17)]
    dealt = post.join(hot, "term", "left").select("term", "doc", search._salt(F.col("salts")))
    assert dealt.groupBy("term", "salt").count().agg(F.max("count")).first()[0] < 270
    other = post.select("term").distinct().join(hot, "term", "left").select("term", search._all_salts(F.col("salts")))
    assert dealt.join(other, ["term", "salt"]).count() == 10_000


def test_hot_terms_are_bounded(spark, monkeypatch):
    from termdex.operators import search

    monkeypatch.setattr(search, "MAX_HOT_TERMS", 3)
    dfreq = spark.range(50).selectExpr("concat('t', id) AS term", "id AS df")
    assert search.hot_terms(dfreq, 1).count() <= 3


def tables_of_a_shuffled_batch(spark, monkeypatch, post, queries):
    """The answers of a batch with nothing broadcast, and the tables it stored by name."""
    from termdex.operators import search

    stored = {}
    monkeypatch.setattr(search, "staged", lambda df, name, f=search.staged: stored.setdefault(name, f(df, name)))
    qs = spark.createDataFrame(queries, "query_id bigint, query string")
    got = search_batch(post, qs, max_broadcast_terms=0, max_broadcast_query_terms=0, max_broadcast_probes=0, salt_rows=25)
    return got, stored


def test_shuffled_batch_asks_each_candidate_for_its_other_words_only(spark, monkeypatch):
    from termdex.plans import inspect

    docs, queries = batch_frame(spark, random.Random(11))
    post = postings(spark.createDataFrame(docs, "doc bigint, text string"))
    got, stored = tables_of_a_shuffled_batch(spark, monkeypatch, post, queries)
    # candidates and answers do not move by their query, but for the answers of three words and more
    moved = [x for x in inspect.exchanges(got) if "hashpartitioning(query_id" in x]
    assert len(moved) == 1 and "salt" not in moved[0]
    want = sorted((q, d) for q, text in queries for d, words in docs if set(text.lower().split()) <= set(words.split()))
    assert sorted(map(tuple, got.collect())) == want
    held = [set(words.split()) for _, words in docs]
    probes = 0
    for _, text in queries:
        words = set(text.lower().split())
        probes += min(sum(w in h for h in held) for w in words) * max(len(words) - 1, 1)
    assert stored["probes"].count() == probes


def test_shuffled_batch_stores_a_build_once_in_order_of_terms(spark, monkeypatch):
    docs, queries = batch_frame(spark, random.Random(12), n_docs=50)
    post = postings(spark.createDataFrame(docs, "doc bigint, text string"))
    _, stored = tables_of_a_shuffled_batch(spark, monkeypatch, post, queries)
    assert sorted(stored["build-postings"].collect()) == sorted(post.select("term", "doc").collect())
    for path in stored["build-postings"].inputFiles():
        terms = [r.term for r in spark.read.parquet(path).coalesce(1).collect()]
        assert terms == sorted(terms)


def test_shuffled_batch_absorbs_repeats_for_any_number_of_words(spark, monkeypatch):
    rows = [(w, d) for d in range(40) for w in "abcd" if (d + ord(w)) % 3]
    post = spark.createDataFrame(rows + rows[::2], "term string, doc bigint")
    queries = [(1, "a"), (2, "a b"), (3, "a b d"), (4, "a b c d"), (5, "a x")]
    held = {d: {w for w, e in rows if e == d} for d in range(40)}
    want = sorted((q, d) for q, text in queries for d in held if set(text.split()) <= held[d])
    for p in (post, post.repartition(3)):
        got, _ = tables_of_a_shuffled_batch(spark, monkeypatch, p, queries)
        assert sorted(map(tuple, got.collect())) == want


def test_stored_steps_leave_no_shuffle_files(spark):
    import time

    from termdex.session import SHUFFLE_CLEANUP, staged

    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        found = files.getAllFiles()
        return {f for f in (found.apply(k).getName() for k in range(found.size())) if f.startswith("shuffle_")}

    before, was = shuffles(), spark.conf.get(SHUFFLE_CLEANUP, None)
    df = spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count()
    table = staged(df, "test-shuffles")
    for _ in range(50):
        if not (left := shuffles() - before):
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(SHUFFLE_CLEANUP, None) == was
    # the frame can be run again, and other executions keep theirs
    assert sorted(df.collect()) == sorted(table.collect()) and shuffles() - before


def test_null_queries_have_no_answer(spark, hand_post):
    qs = spark.createDataFrame([(1, None), (2, "cloud computing"), (3, None)], "query_id bigint, query string")
    got = sorted(map(tuple, search_batch(hand_post, qs).collect()))
    assert got == [(2, "a.txt"), (2, "b.txt")]
    assert _docs(search_all(hand_post, None)) == []


def test_batch_ids_must_name_one_query(spark, hand_post):
    for rows in ([(1, "cloud"), (1, "x")], [(None, "cloud")]):
        with pytest.raises(ValueError):
            search_batch(hand_post, spark.createDataFrame(rows, "query_id bigint, query string"))


def test_batch_keeps_the_type_of_ids(spark, hand_post):
    for text in ("cloud", ""):
        got = search_batch(hand_post, spark.createDataFrame([("q", text)], "query_id string, query string"))
        assert dict(got.dtypes)["query_id"] == "string"


def test_searches_refuse_null_keys(spark):
    post = spark.createDataFrame([("cloud", None, 1), ("x", None, 1), ("cloud", "a", 1), ("x", "a", 1)], "term string, doc string, tf bigint")
    for search in (search_all, search_all_intersect):
        with pytest.raises(Exception):
            search(post, "cloud x").collect()


def test_cluster_without_a_shared_folder_raises():
    from unittest.mock import MagicMock

    from termdex.session import checkpoint_base

    spark = MagicMock()
    spark.conf.get.side_effect = lambda k, d=None: "yarn" if k == "spark.master" else None
    spark.sparkContext.getCheckpointDir.return_value = None
    with pytest.raises(ValueError):
        checkpoint_base(spark)


def test_passage_queries_keep_every_passage_and_word(spark, tmp_path):
    from termdex.plans.registry import passage_queries

    rows = [(4, "Rrquell.\nDe la la Citt\u00e0  vieja"), (5, " "), (6, "one")]
    spark.createDataFrame(rows, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.query_id: r.query for r in passage_queries(spark, str(tmp_path)).collect()}
    assert {k: v for k, v in got.items() if k.endswith(":0")} == {f"{i}:0": t for i, t in rows}
    assert {k: v for k, v in got.items() if not k.endswith(":0")} == {"4:1": "Rrquell. De", "4:2": "la la", "4:3": "Citt\u00e0 vieja", "6:1": "one"}
