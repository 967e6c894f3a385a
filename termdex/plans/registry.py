"""Registered queries over the driver's tables, each with its DuckDB oracle.

Every query reads whole tables (``documents``, ``conversations``, ``pages``,
``benchmark``); nothing is sampled or capped. Queries that store an index write it
under the session's shared checkpoint folder and then read it back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termdex.functions.text import NON_TERM_RUN, SPACES_SEP, TAB_SEP, WHITESPACE_RUN, doc_name
from termdex.operators.index import DEFAULT_BLOCK_BITS, few_rows, grouped, merge_postings, postings, stats, tokens
from termdex.operators.lines import format_lines
from termdex.operators.search import (
    batch_terms,
    parse_query,
    resident_index,
    search_all,
    search_all_intersect,
    search_batch,
    search_stored,
)
from termdex.session import shared_dir
from termdex.sources.files import from_table, read_lines, read_table, read_whole
from termdex.sources.index_io import inspect_parts, read_index, read_text_index, write_index, write_text_index
from termdex.streaming.ingest import index_stream, read_merged, stream_table
from termdex.streaming.levels import append, compact_levels, read_live

# Search parameters of the registered queries (constants of the query, not data).
SEARCH_QUERY = "The  of AND"
STORED_QUERY = "with from that"

# Scan spreading used by every registered query (see operators.index.spread).
SPREAD = "auto"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_table(read_table(spark, sf_dir, "documents"), "doc_id", "text")


def documents_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings(documents(spark, sf_dir), SPREAD)


def documents_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings of all words, for what stores or lists them: texts of a document move to one task if its rows are few."""
    docs = documents(spark, sf_dir)
    return postings(docs, SPREAD, by_doc=few_rows(docs))


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


# ---------------------------------------------------------------- queries

def q_tokens(spark, sf):
    return tokens(documents(spark, sf), SPREAD)


def q_postings(spark, sf):
    return documents_build(spark, sf)


def q_postings_lines(spark, sf):
    # One row per line of each document gives the same postings as whole texts.
    lines = documents(spark, sf).select("doc", F.explode(F.split("text", "\n")).alias("text"))
    return postings(lines, SPREAD)


def q_postings_conversations(spark, sf):
    # Many rows per document: turns of one conversation add up.
    conv = from_table(read_table(spark, sf, "conversations"), "conv_id", "text")
    return postings(conv, SPREAD)


def q_postings_pages(spark, sf):
    pages = from_table(read_table(spark, sf, "pages"), "page_id", "html")
    return postings(pages, SPREAD)


def q_index_stats(spark, sf):
    return stats(documents_build(spark, sf))


def q_index_lines_tab(spark, sf):
    # no list is longer than the table has rows, a count that reads footers only
    n = documents(spark, sf).count()
    return format_lines(documents_build(spark, sf), TAB_SEP, max_docs=n).select("line")


def q_index_lines_files(spark, sf):
    # The reference's shape: documents named like files, one line per term.
    docs = documents(spark, sf).withColumn("doc", F.concat(F.lit("file-"), F.col("doc").cast("string")))
    return format_lines(postings(docs, SPREAD), TAB_SEP).select("line")


def q_grouped(spark, sf):
    # A3 as an array: every posting of every term, taken out of its row again.
    g = grouped(documents_build(spark, sf))
    return g.select("term", F.size("postings").cast("bigint").alias("df"), F.explode("postings").alias("p")).select("term", "df", "p.doc", "p.tf")


def q_doc_names(spark, sf):
    # S5 + N1 over the pages' URLs: the decoded last part of each path.
    return read_table(spark, sf, "pages").select("page_id", doc_name("url").alias("name"))


def q_index_lines_spaces(spark, sf):
    return format_lines(documents_build(spark, sf), SPACES_SEP).select("line")


# Small blocks for the cut of long lists: about 2**6 = 64 postings per line.
SMALL_BLOCK_BITS = 6


def q_index_lines_blocked(spark, sf):
    # Lists of more than 64 documents cut into lines of about 64 each.
    return format_lines(documents_build(spark, sf), TAB_SEP, block_bits=SMALL_BLOCK_BITS).select("line")


def q_parse_index_lines(spark, sf):
    path = shared_dir(spark, "text-index")
    write_text_index(documents_build(spark, sf), path)
    return read_text_index(spark, path)


def q_read_index_parquet(spark, sf):
    path = shared_dir(spark, "parquet-index")
    write_index(documents_build(spark, sf), path)
    return read_index(spark, path)


def q_query_terms(spark, sf):
    return batch_terms(benchmark_queries(spark, sf)).select("query_id", "term")


def q_search_all(spark, sf):
    return search_all(documents_postings(spark, sf), SEARCH_QUERY)


def q_search_all_intersect(spark, sf):
    return search_all_intersect(documents_postings(spark, sf), SEARCH_QUERY)


def q_search_batch(spark, sf):
    return search_batch(documents_postings(spark, sf), passage_queries(spark, sf, by=3))


def passage_queries(spark: SparkSession, sf: str, by: int = 2) -> DataFrame:
    """Each whole raw passage (``item:0``), and all its words, two by two or ``by`` by ``by`` (``item:1`` and on)."""
    qs = benchmark_queries(spark, sf)
    words = F.filter(F.split("query", WHITESPACE_RUN), lambda w: w != "")
    pairs = F.transform(F.sequence(F.lit(1), F.size("w"), F.lit(by)), lambda i: F.array_join(F.slice("w", i, by), " "))
    pairs = qs.withColumn("w", words).filter(F.size("w") > 0).select("query_id", F.posexplode(pairs).alias("k", "query"))
    named = lambda k: F.concat(F.col("query_id").cast("string"), F.lit(":"), k.cast("string")).alias("query_id")
    return qs.select(named(F.lit(0)), "query").union(pairs.select(named(F.col("k") + 1), "query"))


def q_search_batch_passages(spark, sf):
    return search_batch(documents_postings(spark, sf), passage_queries(spark, sf))


def q_search_batch_clean(spark, sf):
    return search_batch(documents_postings(spark, sf), benchmark_queries(spark, sf), clean_query=True)


def q_search_stored_parquet(spark, sf):
    path = shared_dir(spark, "parquet-index")
    write_index(documents_build(spark, sf), path)
    return search_stored(spark, path, STORED_QUERY, "parquet")


def q_search_stored_text(spark, sf):
    path = shared_dir(spark, "text-index")
    write_text_index(documents_build(spark, sf), path, layout="range")
    return search_stored(spark, path, STORED_QUERY, "text").select(F.col("doc").cast("bigint").alias("doc"))


def q_search_stored_manifest(spark, sf):
    # S7 + Q3: the manifest beside the parts names those that can hold a word; K4's cut.
    path = shared_dir(spark, "text-index")
    write_text_index(documents_build(spark, sf), path, parts=16, layout="exact")
    return search_stored(spark, path, STORED_QUERY, "text").select(F.col("doc").cast("bigint").alias("doc"))


def q_search_all_bitmap(spark, sf):
    # Q1 with the rarest word above the broadcast limit: its documents travel as a bitmap.
    path = shared_dir(spark, "parquet-index")
    write_index(documents_build(spark, sf), path)
    return search_all(read_index(spark, path), SEARCH_QUERY, rarest_first=True, max_broadcast_bytes=0)


def q_search_batch_shuffled(spark, sf):
    # Q6 with nothing broadcast, and a salt for every thousand rows of a hot word or query.
    # All words' postings move to the batch's words, so they do not move before that.
    return search_batch(
        documents_build(spark, sf), passage_queries(spark, sf),
        max_broadcast_terms=0, max_broadcast_query_terms=0, max_broadcast_probes=0, salt_rows=1000,
    )


def q_search_stored_blocks(spark, sf):
    # Q5: common words on several lines of several parts; the answer unions them.
    path = shared_dir(spark, "text-index")
    write_text_index(documents_build(spark, sf), path, parts=5, block_bits=SMALL_BLOCK_BITS)
    return search_stored(spark, path, STORED_QUERY, "text").select(F.col("doc").cast("bigint").alias("doc"))


def q_search_resident(spark, sf):
    # Q2: the stored index is loaded once and cached; searches run over the cache.
    path = shared_dir(spark, "parquet-index")
    write_index(documents_build(spark, sf), path)
    return search_all(resident_index(spark, path), SEARCH_QUERY, rarest_first=True)


def _read_parts(spark, sf, layout: str):
    path = shared_dir(spark, "text-index")
    write_text_index(documents_build(spark, sf), path, parts=5, layout=layout)
    return read_text_index(spark, path)


def q_read_parts_hash(spark, sf):
    # K1: five parts, hashed on (term, block).
    return _read_parts(spark, sf, "hash")


def q_read_parts_round(spark, sf):
    # K3: five parts, lines dealt round-robin.
    return _read_parts(spark, sf, "round")


# Parts of the exact cut, as many as the largest of the reference's runs.
EXACT_PARTS = 15


def _part_number(col: str):
    return F.regexp_extract(col, "part-([0-9]+)", 1).cast("bigint")


def q_read_parts_exact(spark, sf):
    # K4: the sorted lines cut after every ceil(lines / parts): what each part file holds.
    path = shared_dir(spark, "text-index")
    write_text_index(documents_build(spark, sf), path, parts=EXACT_PARTS, layout="exact")
    parts = inspect_parts(spark, path)
    return parts.select(_part_number("file").alias("part"), "lines", "bytes", F.col("first").alias("first_term"), F.col("last").alias("last_term"))


def q_parts_sorted(spark, sf):
    # K2 + K6: hashed parts, proved to be in order from the files themselves.
    path = shared_dir(spark, "text-index")
    write_text_index(documents_build(spark, sf), path, parts=5, layout="hash")
    parts = inspect_parts(spark, path)
    return parts.agg(F.count(F.lit(1)).alias("parts"), F.sum("lines").alias("num_lines"), F.sum("bytes").alias("num_bytes"), F.bool_and("in_order").alias("in_order"))


def q_build_observed(spark, sf):
    # The build's own numbers, observed by the job that writes it (with cut lists).
    path = shared_dir(spark, "text-index")
    report = write_text_index(documents_build(spark, sf), path, block_bits=SMALL_BLOCK_BITS)
    return spark.createDataFrame([tuple(report)], "num_terms bigint, tot_terms bigint, num_postings bigint, num_lines bigint, num_bytes bigint")


def q_postings_compacted(spark, sf):
    # A5: ten small indexes by document, levels merged under one manifest, then read.
    path, slices = shared_dir(spark, "levels"), shared_dir(spark, "slices")
    docs = documents(spark, sf).withColumn("k", F.pmod(F.xxhash64("doc"), F.lit(10)))
    # a folder for each slice, so that not every slice reads the whole table
    docs.write.partitionBy("k").parquet(slices)
    docs = spark.read.schema(docs.schema).parquet(slices)
    for k in range(10):
        append(spark, path, postings(docs.filter(F.col("k") == k), SPREAD), f"slice-{k}", fanout=3)
    compact_levels(spark, path, fanout=3)
    return read_live(spark, path)


def q_merge_postings(spark, sf):
    # A5: index the user turns and all other turns apart, then merge the two indexes.
    conv = read_table(spark, sf, "conversations")
    is_user = F.col("role").eqNullSafe("user")
    a = postings(from_table(conv.filter(is_user), "conv_id", "text"), SPREAD)
    b = postings(from_table(conv.filter(~is_user), "conv_id", "text"), SPREAD)
    return merge_postings(a, b)


def q_file_corpus_terms(spark, sf):
    # S1 + S5 on the reference's input shape: Spark writes the documents table as 10 text
    # files in the shared folder, and the line scan indexes them (doc = file basename).
    # How rows fall into files is not fixed, so the result is each term's total count.
    corpus = shared_dir(spark, "file-corpus")
    documents(spark, sf).select("text").repartition(10).write.text(corpus)
    return _occurrences(read_lines(spark, corpus))


def _occurrences(docs: DataFrame) -> DataFrame:
    return postings(docs, SPREAD).groupBy("term").agg(F.sum("tf").cast("bigint").alias("occurrences"))


# Documents per file of the corpora that are read whole: more documents are more files.
FILE_DOCUMENTS = 100


def q_file_corpus_whole(spark, sf):
    # One row per file.
    corpus = shared_dir(spark, "file-corpus")
    documents(spark, sf).select("text").write.option("maxRecordsPerFile", FILE_DOCUMENTS).text(corpus)
    return _occurrences(read_whole(spark, corpus))


def q_file_corpus_flat(spark, sf):
    # The folder's own files only; the conversations in a folder inside it stay out.
    corpus = shared_dir(spark, "file-corpus")
    documents(spark, sf).select("text").write.text(corpus)
    read_table(spark, sf, "conversations").select("text").write.text(f"{corpus}/inside")
    return _occurrences(read_lines(spark, corpus, recursive=False))


def q_postings_streamed(spark, sf):
    # Structured Streaming over the documents table: postings per micro-batch, merged
    # on read. The brace glob names exactly documents.parquet (a stream source needs
    # a folder or a glob, not a file).
    schema = read_table(spark, sf, "documents").schema
    src = stream_table(spark, f"{sf.rstrip('/')}/{{documents}}.parquet", schema, "doc_id", "text", max_files=1)
    path = shared_dir(spark, "stream-index")
    index_stream(src, path).awaitTermination()
    return read_merged(spark, path)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "tokens": q_tokens,
    "postings": q_postings,
    "postings_lines": q_postings_lines,
    "postings_conversations": q_postings_conversations,
    "postings_pages": q_postings_pages,
    "index_stats": q_index_stats,
    "index_lines_tab": q_index_lines_tab,
    "index_lines_files": q_index_lines_files,
    "grouped": q_grouped,
    "doc_names": q_doc_names,
    "index_lines_spaces": q_index_lines_spaces,
    "index_lines_blocked": q_index_lines_blocked,
    "parse_index_lines": q_parse_index_lines,
    "read_index_parquet": q_read_index_parquet,
    "query_terms": q_query_terms,
    "search_all": q_search_all,
    "search_all_intersect": q_search_all_intersect,
    "search_batch": q_search_batch,
    "search_batch_passages": q_search_batch_passages,
    "search_batch_clean": q_search_batch_clean,
    "search_stored_parquet": q_search_stored_parquet,
    "search_stored_text": q_search_stored_text,
    "search_stored_manifest": q_search_stored_manifest,
    "search_all_bitmap": q_search_all_bitmap,
    "search_batch_shuffled": q_search_batch_shuffled,
    "search_stored_blocks": q_search_stored_blocks,
    "search_resident": q_search_resident,
    "read_parts_hash": q_read_parts_hash,
    "read_parts_round": q_read_parts_round,
    "read_parts_exact": q_read_parts_exact,
    "parts_sorted": q_parts_sorted,
    "build_observed": q_build_observed,
    "postings_compacted": q_postings_compacted,
    "merge_postings": q_merge_postings,
    "postings_streamed": q_postings_streamed,
    "file_corpus_terms": q_file_corpus_terms,
    "file_corpus_whole": q_file_corpus_whole,
    "file_corpus_flat": q_file_corpus_flat,
}


# ---------------------------------------------------------------- DuckDB oracles

def _tok_sql(table: str, doc: str, text: str) -> str:
    return (
        f"SELECT {doc} AS doc, unnest(string_split(lower(regexp_replace({text}, '{NON_TERM_RUN}', ' ', 'g')), ' ')) AS term "
        f"FROM {table}"
    )


def _post_cte(table: str = "documents", doc: str = "doc_id", text: str = "text") -> str:
    return (
        f"WITH tok AS ({_tok_sql(table, doc, text)}), "
        "post AS (SELECT term, doc, count(*) AS tf FROM tok WHERE term <> '' GROUP BY term, doc) "
    )


# Whitespace class of queries in RE2 syntax (same set as functions.text.WHITESPACE_CLASS).
_WS_RE2 = "[\\s\\x0b\\p{Z}\\x1c-\\x1f\\x{85}]+"


def _sql_terms(terms: list[str]) -> str:
    return ", ".join("'" + t.replace("'", "''") + "'" for t in terms)


def _qt_cte(clean: bool, text: str = "text", table: str = "benchmark") -> str:
    if clean:
        split = f"string_split(lower(regexp_replace(text, '{NON_TERM_RUN}', ' ', 'g')), ' ')"
    else:
        split = f"regexp_split_to_array(lower({text}), '{_WS_RE2}')"
    return (
        f"qw AS (SELECT item_id AS query_id, unnest({split}) AS term FROM {table}), "
        "qt AS (SELECT DISTINCT query_id, term FROM qw WHERE term <> ''), "
        "qn AS (SELECT query_id, count(*) AS n FROM qt GROUP BY query_id) "
    )


def _batch_sql(clean: bool, text: str = "text", table: str = "benchmark", before: str = "") -> str:
    return (
        _post_cte() + ", " + before + _qt_cte(clean, text, table)
        + "SELECT qt.query_id AS query_id, post.doc AS doc FROM qt JOIN post ON qt.term = post.term "
        "JOIN qn ON qt.query_id = qn.query_id GROUP BY qt.query_id, post.doc, qn.n HAVING count(*) = qn.n"
    )


def _asked_cte(by: int) -> str:
    """The queries of passage_queries."""
    return (
        f"words AS (SELECT item_id, list_filter(regexp_split_to_array(text, '{_WS_RE2}'), lambda x: x <> '') AS w FROM benchmark), "
        "asked AS (SELECT item_id || ':0' AS item_id, text FROM benchmark UNION ALL "
        f"SELECT item_id || ':' || k, array_to_string(w[{by} * (k - 1) + 1 : {by} * k], ' ') "
        f"FROM (SELECT item_id, w, unnest(range(1, (len(w) + {by - 1}) // {by} + 1)) AS k FROM words)), "
    )


def _search_sql(query: str) -> str:
    terms = parse_query(query)
    return (
        _post_cte() + f"SELECT doc FROM post WHERE term IN ({_sql_terms(terms)}) "
        f"GROUP BY doc HAVING count(DISTINCT term) = {len(terms)}"
    )


def _lines_sql(sep_sql: str, bits: int = DEFAULT_BLOCK_BITS, doc: str = "doc") -> str:
    size = 1 << bits
    return (
        _post_cte()
        + f", named AS (SELECT term, {doc} AS doc, tf, CAST(ceil(count(*) OVER (PARTITION BY term) / {size}) AS BIGINT) AS parts FROM post) "
        + f"SELECT term || {sep_sql} || string_agg(CAST(doc AS VARCHAR) || ':' || CAST(tf AS VARCHAR), {sep_sql} ORDER BY doc) AS line "
        + "FROM named GROUP BY term, CASE WHEN parts = 1 THEN 0 ELSE CAST('0x' || substr(md5(CAST(doc AS VARCHAR)), 1, 8) AS BIGINT) % parts END"
    )


_OCCURRENCES_SQL = _post_cte() + "SELECT term, CAST(sum(tf) AS BIGINT) AS occurrences FROM post GROUP BY term"

ORACLE_SQL: dict[str, str] = {
    "tokens": f"SELECT doc, term FROM ({_tok_sql('documents', 'doc_id', 'text')}) WHERE term <> ''",
    "postings": _post_cte() + "SELECT term, doc, tf FROM post",
    "postings_lines": _post_cte() + "SELECT term, doc, tf FROM post",
    "postings_conversations": _post_cte("conversations", "conv_id", "text") + "SELECT term, doc, tf FROM post",
    "postings_pages": _post_cte("pages", "page_id", "html") + "SELECT term, doc, tf FROM post",
    "index_stats": _post_cte() + "SELECT count(DISTINCT term) AS num_terms, CAST(sum(tf) AS BIGINT) AS tot_terms FROM post",
    "index_lines_tab": _lines_sql("chr(9)"),
    "index_lines_files": _lines_sql("chr(9)", doc="'file-' || doc"),
    "grouped": _post_cte() + "SELECT term, count(*) OVER (PARTITION BY term) AS df, doc, tf FROM post",
    "doc_names": "SELECT page_id, url_decode(replace(list_last(string_split(url, '/')), '+', '%2B')) AS name FROM pages",
    "index_lines_spaces": _lines_sql("'    '"),
    "index_lines_blocked": _lines_sql("chr(9)", SMALL_BLOCK_BITS),
    "parse_index_lines": _post_cte() + "SELECT term, CAST(doc AS VARCHAR) AS doc, tf FROM post",
    "read_index_parquet": _post_cte() + "SELECT term, doc, tf FROM post",
    "query_terms": "WITH " + _qt_cte(False) + "SELECT query_id, term FROM qt",
    "search_all": _search_sql(SEARCH_QUERY),
    "search_all_intersect": _search_sql(SEARCH_QUERY),
    "search_batch": _batch_sql(False, table="asked", before=_asked_cte(3)),
    "search_batch_passages": _batch_sql(False, table="asked", before=_asked_cte(2)),
    "search_batch_clean": _batch_sql(True),
    "search_stored_parquet": _search_sql(STORED_QUERY),
    "search_stored_text": _search_sql(STORED_QUERY),
    "search_stored_manifest": _search_sql(STORED_QUERY),
    "search_all_bitmap": _search_sql(SEARCH_QUERY),
    "search_batch_shuffled": _batch_sql(False, table="asked", before=_asked_cte(2)),
    "search_stored_blocks": _search_sql(STORED_QUERY),
    "search_resident": _search_sql(SEARCH_QUERY),
    "read_parts_hash": _post_cte() + "SELECT term, CAST(doc AS VARCHAR) AS doc, tf FROM post",
    "read_parts_round": _post_cte() + "SELECT term, CAST(doc AS VARCHAR) AS doc, tf FROM post",
    "read_parts_exact": (
        f"WITH line AS ({_lines_sql('chr(9)')}), "
        f"placed AS (SELECT line, split_part(line, chr(9), 1) AS term, (row_number() OVER (ORDER BY split_part(line, chr(9), 1)) - 1) "
        f"// ((count(*) OVER () + {EXACT_PARTS - 1}) // {EXACT_PARTS}) AS part FROM line) "
        "SELECT part, count(*) AS lines, CAST(sum(strlen(line) + 1) AS BIGINT) AS bytes, min(term) AS first_term, max(term) AS last_term FROM placed GROUP BY part"
    ),
    "parts_sorted": (
        f"SELECT CAST(5 AS BIGINT) AS parts, count(*) AS num_lines, CAST(sum(strlen(line) + 1) AS BIGINT) AS num_bytes, true AS in_order FROM ({_lines_sql('chr(9)')})"
    ),
    "build_observed": (
        f"WITH line AS ({_lines_sql('chr(9)', SMALL_BLOCK_BITS)}) SELECT count(DISTINCT split_part(line, chr(9), 1)) AS num_terms, "
        "(SELECT CAST(sum(tf) AS BIGINT) FROM (" + _post_cte() + "SELECT tf FROM post)) AS tot_terms, "
        "(SELECT count(*) FROM (" + _post_cte() + "SELECT tf FROM post)) AS num_postings, "
        "count(*) AS num_lines, CAST(sum(strlen(line) + 1) AS BIGINT) AS num_bytes FROM line"
    ),
    "postings_compacted": _post_cte() + "SELECT term, doc, tf FROM post",
    "merge_postings": _post_cte("conversations", "conv_id", "text") + "SELECT term, doc, tf FROM post",
    "postings_streamed": _post_cte() + "SELECT term, doc, tf FROM post",
    "file_corpus_terms": _OCCURRENCES_SQL,
    "file_corpus_whole": _OCCURRENCES_SQL,
    "file_corpus_flat": _OCCURRENCES_SQL,
}
