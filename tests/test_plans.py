
from conftest import SF_SMALL
from termdex.operators.index import merge_postings, postings, stats
from termdex.operators.lines import format_lines
from termdex.operators.search import search_all, search_stored
from termdex.plans import inspect
from termdex.plans.registry import QUERIES
from termdex.session import shared_dir
from termdex.sources.files import from_table, read_table
from termdex.sources.index_io import write_index


def _docs(spark):
    return from_table(read_table(spark, SF_SMALL, "documents"))


def test_postings_combine_map_side(spark):
    # A2 / A4: a partial count below the one shuffle of the build
    post = postings(_docs(spark))
    assert inspect.partial_aggregate_below_exchange(post)
    assert len(inspect.exchanges(post)) == 1


def test_merge_combines_map_side(spark):
    post = postings(_docs(spark))
    assert inspect.partial_aggregate_below_exchange(merge_postings(post, post))


def test_scan_reads_two_columns(spark):
    plan = inspect.plan_string(postings(_docs(spark)))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_no_python_worker_anywhere(spark):
    for name, fn in QUERIES.items():
        if name.startswith(("search_stored", "parse_index", "read_index", "search_batch")):
            continue  # these run actions while building; checked below on their parts
        assert inspect.python_nodes(fn(spark, SF_SMALL)) == [], name
    post = postings(_docs(spark))
    assert inspect.python_nodes(format_lines(post)) == []
    assert inspect.python_nodes(stats(post)) == []


def test_term_filter_pushed_to_parquet_index(spark):
    path = shared_dir(spark, "test-plan")
    write_index(postings(_docs(spark)), path)
    plan = inspect.plan_string(search_stored(spark, path, "the of", "parquet"))
    assert "PushedFilters: [In(term, [of,the])" in plan or "PushedFilters: [In(term, [the,of])" in plan
    # only the two columns the search needs are read; tf is pruned
    assert "ReadSchema: struct<term:string,doc:bigint>" in plan


def test_search_filter_below_postings_aggregate(spark):
    # the IN filter is applied to tokens before they are counted and shuffled
    plan = inspect.plan_string(search_all(postings(_docs(spark)), "the of"))
    lines = [ln for ln in plan.splitlines() if "Filter" in ln or "Generate" in ln or "Exchange hash" in ln]
    i_filter = next(i for i, ln in enumerate(lines) if "IN (the,of)" in ln)
    i_first_exchange = next(i for i, ln in enumerate(lines) if "Exchange hash" in ln)
    assert i_filter > i_first_exchange  # deeper in the tree than the first exchange


def test_no_pairwise_join_in_any_query(spark):
    # no cross product or nested-loop join anywhere, and no Python worker
    for name, fn in QUERIES.items():
        plan = inspect.plan_string(fn(spark, SF_SMALL))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan, (name, bad)
        assert not any(n in plan for n in inspect.PYTHON_NODES), name


def test_spread_only_when_scan_is_narrow(spark):
    from termdex.operators.index import spread

    narrow = _docs(spark)  # one row group -> fewer splits than task slots
    assert "RoundRobinPartitioning" in inspect.plan_string(spread(narrow, "auto"))
    shuffled = narrow.repartition(spark.sparkContext.defaultParallelism * 2)
    assert inspect.plan_string(spread(shuffled, None)).count("RoundRobinPartitioning") == 1
    assert "RoundRobinPartitioning" not in inspect.plan_string(spread(narrow, None))


def test_long_splits_are_spread_whatever_their_number(spark):
    # a task combines about SPREAD_BYTES of a scan, though there are as many splits as slots
    from termdex.operators.index import SPREAD_BYTES, spread, split_bytes

    slots, key = spark.sparkContext.defaultParallelism, "spark.sql.files.maxPartitionBytes"
    many, was = _docs(spark).repartition(slots + 1), spark.conf.get(key)
    try:
        for value, n in ((str(4 * SPREAD_BYTES), 4), ("40m", 3), (f"{SPREAD_BYTES}b", 1), ("1KB", 1)):
            spark.conf.set(key, value)
            assert split_bytes(spark) > (n - 1) * SPREAD_BYTES
            assert spread(many, "auto").rdd.getNumPartitions() == n * (slots + 1), value
    finally:
        spark.conf.set(key, was)


def test_lists_are_collected_after_their_postings_move(spark):
    # no list is gathered below the exchange that deals postings to their blocks
    from termdex.operators.index import grouped

    for bits in (3, 20):
        for df in (format_lines(postings(_docs(spark)), block_bits=bits), grouped(postings(_docs(spark)), bits)):
            lines = inspect.plan_string(df).splitlines()
            below = lines[next(i for i, ln in enumerate(lines) if "Exchange" in ln) :]
            assert not any("collect_list" in ln for ln in below)
            assert len(inspect.exchanges(df)) == 1


def test_batch_search_of_a_build_stores_the_words_lists_once(spark):
    # the answer reads stored lists: no token is made again by it
    from termdex.operators.search import search_batch

    qs = read_table(spark, SF_SMALL, "benchmark").selectExpr("item_id AS query_id", "text AS query")
    for limit in (0, 1 << 20):
        plan = inspect.plan_string(search_batch(postings(_docs(spark)), qs, True, limit, limit, limit))
        assert "Generate explode(regexp_extract_all" not in plan and "batch-postings" in plan


def test_batch_search_broadcasts_only_small_sides(spark):
    from termdex.operators.search import search_batch

    post = postings(_docs(spark))
    qs = read_table(spark, SF_SMALL, "benchmark").selectExpr("item_id AS query_id", "text AS query")
    small = inspect.plan_string(search_batch(post, qs, clean_query=True))
    assert "BroadcastExchange" in small
    big = inspect.plan_string(
        search_batch(post, qs, True, max_broadcast_terms=0, max_broadcast_query_terms=0, max_broadcast_probes=0)
    )
    # when every counted size is over its limit, nothing is broadcast: all joins shuffle
    assert "BroadcastExchange" not in big
    assert big.count("SortMergeJoin") >= 2


def test_a_build_moves_texts_and_not_postings(spark):
    # the texts go to their document's task; with many rows a document, counts are combined first
    from termdex.operators.index import few_rows

    rows = [(k % 5, f"Alpha beta {k} beta") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc long, text string").repartition(3)
    assert few_rows(docs) and few_rows(docs, 8) and not few_rows(docs, 7)
    shuffles = [x for x in inspect.exchanges(postings(docs, by_doc=True)) if "hashpartitioning" in x]
    assert len(shuffles) == 1 and "hashpartitioning(doc" in shuffles[0]
    assert sorted(postings(docs, by_doc=True).collect()) == sorted(postings(docs).collect())
    build = QUERIES["postings"](spark, SF_SMALL)
    assert len(inspect.exchanges(build)) == 1 and "hashpartitioning(doc" in inspect.exchanges(build)[0]


def test_a_build_is_stored_before_its_ranges_are_drawn(spark, tmp_path, monkeypatch):
    # the pass that draws the ranges reads a table: nothing is counted twice
    from termdex.sources import index_io

    seen = []
    monkeypatch.setattr(index_io, "staged", lambda df, name, f=index_io.staged: (seen.append(name), f(df, name))[1])
    index_io.write_index(postings(_docs(spark)), str(tmp_path / "a"))
    assert seen == ["postings"]
    index_io.write_index(spark.read.parquet(str(tmp_path / "a")), str(tmp_path / "b"))
    assert seen == ["postings"]
    assert sorted(index_io.read_index(spark, str(tmp_path / "b")).collect()) == sorted(postings(_docs(spark)).collect())


def test_tasks_of_a_stored_build_hold_bounded_rows(spark, tmp_path, monkeypatch):
    from termdex.operators import index

    path = str(tmp_path / "post")
    postings(_docs(spark)).write.parquet(path)
    post = spark.read.parquet(path)
    n = post.count()
    assert index.task_count(post) is None
    want = sorted(format_lines(post, block_bits=3).collect())
    monkeypatch.setattr(index, "TASK_POSTINGS", n // 40)
    assert index.task_count(post) == -(-n // (n // 40))
    for bits in (3, 20):
        lines = format_lines(post, block_bits=bits, stored=True)
        assert lines.rdd.getNumPartitions() == index.task_count(post)
    assert sorted(format_lines(post, block_bits=3).collect()) == want
