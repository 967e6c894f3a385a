"""All-words search over postings (Q1-Q6): documents holding every query term.

Single query (Q1, Q3): the terms are literals, so ``term IN (...)`` reaches the
Parquet scan of a stored index (S7) and only the posting lists of the query terms
are read. The answer is a relational division: group the hits by document and keep
documents that hold all distinct terms.

Many queries (Q6): joining every query term with every posting of that term would
emit (queries holding t) x (documents holding t) rows for a common term t. Instead
each query is seeded with its rarest term, whose posting list bounds the answer, and
each candidate (query, doc) then checks the query's terms against the postings on
(term, doc). Work is at most n_terms x df(rarest term) per query, and exact. The
bytes of such probes are counted from tables first: few probes are broadcast
and looked up without moving the postings; many probes use a shuffled semi-join.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termdex.functions.text import NON_TERM_RUN, query_terms
from termdex.operators.index import MAX_BROADCAST_BYTES, ROW_BYTES, keyed
from termdex.plans.inspect import exchanges
from termdex.session import staged
from termdex.sources.index_io import filter_text_lines, manifest_files, parse_lines, read_index, read_text_lines

# Rows of one term or query that a shuffled join of the batch gives to one task.
SALT_ROWS = 1_000_000
# Terms that get salts of their own, at most (a row of each is broadcast).
MAX_HOT_TERMS = 1_000_000
# Salts of each of the batch's terms while no frequency is known.
VOCABULARY_SALTS = 16

_PY_NON_TERM = re.compile(NON_TERM_RUN)


def parse_query(query: str | None, clean_query: bool = False) -> list[str]:
    """P11 on the driver for one query line: lower, split on whitespace, distinct.

    Matches ``functions.text.query_terms``; first-seen order is kept.
    """
    if not query:
        return []
    words = _PY_NON_TERM.sub(" ", query).lower().split() if clean_query else query.lower().split()
    return list(dict.fromkeys(words))


def _empty_docs(post: DataFrame) -> DataFrame:
    return post.select("doc").filter(F.lit(False))


def _divide(hits: DataFrame, n_terms: int) -> DataFrame:
    """Documents whose hits cover ``n_terms`` distinct terms.

    Repartitioning by doc first lets both steps of the distinct count run without a
    second exchange; the hits are the query terms' postings, already distinct pairs
    in a well-formed index, so a map-side combine would save nothing.
    """
    return (
        hits.select("term", keyed("doc").alias("doc"))
        .repartition("doc")
        .groupBy("doc")
        .agg(F.count_distinct("term").alias("n"))
        .filter(F.col("n") == n_terms)
        .select("doc")
    )


def _list_sizes(hits: DataFrame) -> dict[str, tuple[int, int]]:
    """Rows and about the bytes of each query term's list (one row per term reaches the driver)."""
    bytes_ = F.sum(F.octet_length(F.col("doc").cast("string")) + 16)
    return {r["term"]: (r["n"], r["b"]) for r in hits.groupBy("term").agg(F.count(F.lit(1)).alias("n"), bytes_.alias("b")).collect()}


# Bits of a bitmap of hashed documents, at most: 128 MB.
MAX_BITMAP_BITS = 1 << 30
# Bits for each document in it, as long as they fit: one in eight other documents passes.
BITMAP_BITS_PER_DOC = 8


def bitmap_bits(n_docs: int) -> int:
    """Bits of the bitmap for ``n_docs`` documents: a power of two, one of Spark's buckets at least."""
    return min(MAX_BITMAP_BITS, max(1 << 15, 1 << (BITMAP_BITS_PER_DOC * n_docs - 1).bit_length()))


def _in_bitmap(hits: DataFrame, docs: DataFrame, bits: int) -> DataFrame:
    """Hits whose hashed document is in the bitmap of ``docs``, some others among them.

    The bitmap is built by the tasks, in buckets of 2**15 bits, and has a fixed size
    whatever the number of documents. Of a bucket only the byte of the hit's bit is looked at.
    """
    place = F.pmod(F.xxhash64("doc"), F.lit(bits))
    at = docs.select(place.alias("p"))
    made = at.groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bitmap"))
    bit = F.bitmap_bit_position("p")
    byte = F.conv(F.hex(F.substring("bitmap", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    placed = hits.withColumn("p", place).withColumn("bucket", F.bitmap_bucket_number("p"))
    inside = placed.join(F.broadcast(made), "bucket")
    return inside.filter(F.getbit(byte, (bit % 8).cast("int")) == 1).select(*hits.columns)


def _divide_rarest_first(hits: DataFrame, terms: list[str], max_broadcast_bytes: int) -> DataFrame:
    """``_divide`` of the hits that lie in the rarest term's documents.

    The rarest term's documents are broadcast if their counted bytes are within the limit,
    else as a bitmap of their hashes, of a fixed size. Either way the common terms' other hits
    are dropped before anything is shuffled; the few that a bitmap lets through fail the
    division, which is exact.
    """
    hits = hits.select("term", keyed("doc").alias("doc"))
    sizes = _list_sizes(hits)
    if len(sizes) < len(terms):
        return _empty_docs(hits)
    rarest = min(terms, key=lambda t: sizes[t])
    if len(terms) > 1:
        docs = hits.filter(F.col("term") == rarest).select("doc")
        if sizes[rarest][1] <= max_broadcast_bytes:
            hits = hits.join(F.broadcast(docs), "doc", "left_semi")
        else:
            others = _in_bitmap(hits.filter(F.col("term") != rarest), docs, bitmap_bits(sizes[rarest][0]))
            hits = others.union(hits.filter(F.col("term") == rarest))
    return _divide(hits, len(terms))


def search_all(
    post: DataFrame,
    query: str,
    clean_query: bool = False,
    rarest_first: bool | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Q1 (+Q2 when ``post`` is cached): documents containing every query term.

    ``rarest_first`` counts the terms' lists first and moves only hits in the rarest
    one's documents. Unless it is given, that is done for an index which is cheap to read
    twice: a cached one, or one whose plan has no shuffle (a stored table).
    """
    terms = parse_query(query, clean_query)
    if not terms:
        return _empty_docs(post)
    if rarest_first is None:
        rarest_first = post.is_cached or not exchanges(post)
    hits = post.filter(F.col("term").isin(terms))
    return _divide_rarest_first(hits, terms, max_broadcast_bytes) if rarest_first else _divide(hits, len(terms))


# Words whose bits share one number (its sign stays unused).
MASK_WORDS = 63


def search_all_intersect(post: DataFrame, query: str, clean_query: bool = False) -> DataFrame:
    """Q4 twin of ``search_all``: intersect the document sets of the terms.

    Each hit carries the bit of its term; the bits of a document's hits are or-ed, and the
    documents in every set have all bits. The hits move once, combined map-side, whatever
    the number of terms; more than ``MASK_WORDS`` terms take several masks.
    """
    terms = parse_query(query, clean_query)
    if not terms:
        return _empty_docs(post)
    hits = post.filter(F.col("term").isin(terms)).select("term", keyed("doc").alias("doc"))
    groups = [terms[a : a + MASK_WORDS] for a in range(0, len(terms), MASK_WORDS)]

    def mask(group: list[str]) -> Column:
        bit = F.create_map(*(F.lit(x) for k, t in enumerate(group) for x in (t, 1 << k)))
        return F.bit_or(F.coalesce(F.try_element_at(bit, F.col("term")), F.lit(0)).cast("bigint"))

    found = hits.groupBy("doc").agg(*(mask(g).alias(f"m{k}") for k, g in enumerate(groups)))
    for k, g in enumerate(groups):
        found = found.filter(F.col(f"m{k}") == F.lit((1 << len(g)) - 1).cast("bigint"))
    return found.select("doc")


def resident_index(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Q2: load a stored index once and keep ``(term, doc)`` cached on the executors.

    Counts are dropped, as the resident reader does; ``search_all`` over the result
    answers each later query from memory (a lost block is recomputed from storage).
    """
    if fmt == "parquet":
        post = read_index(spark, path)
    elif fmt == "text":
        post = parse_lines(read_text_lines(spark, path))
    else:
        raise ValueError("fmt must be 'parquet' or 'text'")
    return post.select("term", "doc").cache()


def stored_text_lines(spark: SparkSession, path: str, terms: list[str]) -> DataFrame:
    """S7 for text: the lines of some terms, from the parts that can hold them if there is a manifest."""
    files = manifest_files(spark, path, terms)
    if files == []:
        return spark.createDataFrame([], "value string")
    lines = read_text_lines(spark, path) if files is None else spark.read.text(files)
    return filter_text_lines(lines, terms)


def search_stored(spark: SparkSession, path: str, query: str, fmt: str = "parquet", clean_query: bool = False) -> DataFrame:
    """Q3 + S7 + Q5: search an index on storage, reading only the query terms.

    Parquet: the ``In(term, ...)`` filter is pushed to the scan and skips row groups
    of a term-sorted index; the lists are counted first, and only hits in the rarest
    term's documents are shuffled. Text (read once): a manifest names the parts that can
    hold the terms; only lines whose first word is a query term are split; a term spread
    over several lines or parts unions its documents.
    """
    terms = parse_query(query, clean_query)
    if fmt == "parquet":
        post = read_index(spark, path)
    elif fmt == "text":
        post = parse_lines(stored_text_lines(spark, path, terms or [""]))
    else:
        raise ValueError("fmt must be 'parquet' or 'text'")
    if not terms:
        return _empty_docs(post)
    hits = post.filter(F.col("term").isin(terms))
    return _divide_rarest_first(hits, terms, MAX_BROADCAST_BYTES) if fmt == "parquet" else _divide(hits, len(terms))


def _side(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df.hint("merge")


def _bytes(*cols: str) -> Column:
    """Bytes of broadcast rows with these columns."""
    return F.sum(sum((F.octet_length(F.col(c).cast("string")) for c in cols), F.lit(0)) + ROW_BYTES).cast("bigint")


def batch_terms(queries: DataFrame, clean_query: bool = False) -> DataFrame:
    """P11 for a table of queries -> ``(query_id, term, n)``, n = distinct terms of the query."""
    arr = query_terms(F.col("query"), clean_query)
    return queries.select("query_id", arr.alias("ts")).select(
        "query_id", F.size("ts").alias("n"), F.explode("ts").alias("term")
    )


def _salt(salts: Column) -> Column:
    """One of ``salts`` salts for a row, by its document."""
    return F.pmod(F.xxhash64("doc"), F.coalesce(salts, F.lit(1))).cast("int").alias("salt")


def _all_salts(salts: Column) -> Column:
    """A row for each salt: the other side of a salted join."""
    return F.explode(F.sequence(F.lit(0), F.coalesce(salts, F.lit(1)).cast("int") - 1)).alias("salt")


def hot_terms(dfreq: DataFrame, salt_rows: int) -> DataFrame:
    """``(term, salts)`` of terms with more than ``salt_rows`` documents: a salt for each that many.

    At least so many rows a salt that no more than ``MAX_HOT_TERMS`` terms are hot.
    """
    total = dfreq.agg(F.sum("df")).first()[0] or 0
    rows = max(salt_rows, -(-total // MAX_HOT_TERMS))
    return dfreq.filter(F.col("df") > rows).select("term", F.ceil(F.col("df") / rows).cast("int").alias("salts"))


def _shuffled_probes(rel: DataFrame, qt: DataFrame, rare: DataFrame, hot: DataFrame) -> DataFrame:
    """``(query_id, doc, n, term)``: the candidates of each query with its ``n`` words besides the rarest, by shuffles.

    The rarest word is known to be in its own list, so it is asked only by a query without another.
    Lists of ``hot`` terms are dealt over their salts, and meet the other words of their queries there:
    candidates do not move by query. A list follows the query and word that ask it, so neighbouring
    rows differ by their document and pack well when they move.
    """
    hot = F.broadcast(hot)
    lists = rel.join(hot, "term", "left").select("term", "doc", _salt(F.col("salts")))
    words = qt.select("query_id", F.col("term").alias("word")).join(rare.hint("merge"), "query_id").filter("n = 1 or word <> term")
    asked = words.join(hot, "term", "left").select("query_id", "word", "term", "n", _all_salts(F.col("salts")))
    return (
        asked.hint("merge")
        .join(lists, ["term", "salt"])
        .select("query_id", "doc", F.greatest(F.col("n") - 1, F.lit(1)).alias("n"), F.col("word").alias("term"))
    )


def search_batch(
    post: DataFrame,
    queries: DataFrame,
    clean_query: bool = False,
    max_broadcast_terms: int = MAX_BROADCAST_BYTES,
    max_broadcast_query_terms: int = MAX_BROADCAST_BYTES,
    max_broadcast_probes: int = MAX_BROADCAST_BYTES,
    salt_rows: int = SALT_ROWS,
) -> DataFrame:
    """Q6: answer a table ``queries(query_id, query)`` -> ``(query_id, doc)``.

    Empty queries and queries with a term absent from the index have no answer. Ids name
    the answers, so a null or repeated ``query_id`` raises. The postings are read three
    times (frequencies of the batch's words, the rarest words' lists, the probes), each
    time pruned to what is needed. Of a build (postings whose plan has a shuffle), and where the batch's
    words are not broadcast, the lists of the batch's words are written to a table first, so that
    the corpus is tokenised and moved to the words once.

    The limits are counted bytes; beyond them a side is joined by a shuffle, in which the
    rows of a hot term or query are dealt over a salt for every ``salt_rows`` of them (a query's
    candidates are its rarest term's list, and have its salts).
    """
    if not queries.groupBy("query_id").count().filter("count > 1 or query_id is null").isEmpty():
        raise ValueError("query_id must be unique and not null")
    qt = staged(batch_terms(queries, clean_query), "query-terms")
    term_bytes, qt_bytes = qt.agg(_bytes("term"), _bytes("term", "query_id")).first()
    if not qt_bytes:
        kind = queries.schema["query_id"].dataType
        return post.select(F.lit(None).cast(kind).alias("query_id"), "doc").filter(F.lit(False))

    # Counted bytes decide every join strategy on the query side: broadcast below the
    # limits, a forced shuffle (sort-merge) join above them, whatever the planner
    # estimates.
    terms_small = term_bytes <= max_broadcast_terms
    qt_small = qt_bytes <= max_broadcast_query_terms
    vocab = qt.select("term").distinct()

    # Postings of the batch's terms only: a broadcast semi-join is pushed below a postings
    # aggregate, and a stored index is read for these columns alone.
    rel = post.select("term", keyed("doc").alias("doc"))
    build = not post.is_cached and bool(exchanges(post))
    if terms_small:
        rel = rel.join(F.broadcast(vocab), "term", "left_semi")
    else:
        if build:
            # stored in order of terms, so that neighbouring rows differ by their document and pack well when they move
            rel = staged(rel.sortWithinPartitions("term"), "build-postings")
        # no frequency is known yet: every term gets the same salts; no column moves for them
        sought = vocab.select(F.col("term").alias("word"), _all_salts(F.lit(VOCABULARY_SALTS)))
        rel = rel.join(sought.hint("merge"), (F.col("term") == F.col("word")) & (_salt(F.lit(VOCABULARY_SALTS)) == F.col("salt")), "left_semi")

    if build or not terms_small:
        rel = staged(rel, "batch-postings")

    # Rarest term of each query (one row per query); a term missing from the index rules
    # the query out.
    dfreq = staged(rel.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "term-counts")
    rare = (
        qt.join(_side(dfreq, terms_small), "term", "left")
        .groupBy("query_id")
        .agg(
            F.min(F.struct(F.coalesce(F.col("df"), F.lit(0)).alias("df"), F.col("term"))).alias("r"),
            F.max("n").alias("n"),
        )
        .filter(F.col("r.df") > 0)
        .select("query_id", F.col("r.term").alias("term"), "n")
    )
    rare = staged(rare, "rarest-terms")

    # Probes: a candidate, and a word that it must have; ``n`` of them for each candidate.
    if qt_small:
        # Only the rarest words' lists are kept (a table); stop words stay in place.
        cand = staged(rel.join(F.broadcast(rare), "term").select("query_id", "doc", "n"), "candidates")
        # Exact bytes of all (query, candidate, query term) probes, from a row per query.
        lists = cand.groupBy("query_id").agg(F.count(F.lit(1)).alias("c"), _bytes("doc", "query_id").alias("b"))
        words = F.broadcast(qt.groupBy("query_id").agg(F.max("n").alias("n"), F.sum(F.octet_length("term")).alias("t")))
        probe_bytes = lists.join(words, "query_id").agg(F.sum(F.col("b") * F.col("n") + F.col("c") * F.col("t"))).first()[0] or 0
        probes = cand.join(F.broadcast(qt.select("query_id", "term")), "query_id").select("query_id", "doc", "n", "term")
    else:
        probes = staged(_shuffled_probes(rel, qt, rare, hot_terms(dfreq, salt_rows)), "probes")
        probe_bytes = probes.agg(_bytes("query_id", "doc", "term")).first()[0] or 0
    if probe_bytes <= max_broadcast_probes:
        # the probes are few: look them up in the postings without moving the postings
        hits = rel.join(F.broadcast(probes), ["term", "doc"])
    else:
        hits = probes.join(rel.hint("merge"), ["term", "doc"], "left_semi")
    # a distinct count keeps the answer exact if a foreign index repeats a (term, doc) pair
    hits = hits.select("query_id", "doc", "n", "term")
    more = hits if qt_small else hits.filter("n > 1")
    found = more.groupBy("query_id", "doc", "n").agg(F.count_distinct("term").alias("k")).filter(F.col("k") == F.col("n")).select("query_id", "doc")
    if qt_small:
        return found
    # with one word left to ask, a hit is the answer: it has moved to its word and document, where repeats meet
    return found.union(hits.filter("n = 1").distinct().select("query_id", "doc"))
