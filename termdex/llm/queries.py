"""Registered queries of this package, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termdex.llm import byte_bpe, chat, decontaminate, langid, lm_score, neardup, phrases, pieces, pii, quality, token_files, topk, variants
from termdex.sources.files import read_table


def op1_lm_score(spark: SparkSession, sf: str) -> DataFrame:
    return lm_score.score(read_table(spark, sf, "documents"), order=lm_score.ORDER)


def op2_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return langid.identify(read_table(spark, sf, "documents"))


def op3_quality(spark: SparkSession, sf: str) -> DataFrame:
    # the table has no URL: its source is the host, the language section in it the path
    return quality.assess(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"), F.col("source"), F.col("lang"))


def op4_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    model = pieces.public_model()
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    coded = docs.withColumn("ids", pieces.encode(spark, model, F.col("text")))
    coded = coded.withColumn("decoded", pieces.decode(spark, model, F.col("ids")))
    bytes_used = F.size(F.filter("ids", lambda i: i.between(int(model.byte_id.min()), int(model.byte_id.max()))))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        bytes_used.cast("long").alias("n_bytes"),
        token_files.ids_crc32("ids").alias("ids_crc32"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


def op5_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))


def op6_pii(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    return pii.find(docs, pii.fit(docs))


def op7_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return neardup.near_duplicates(read_table(spark, sf, "documents"))


def op8_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf, "embeddings"))


def op9_chat(spark: SparkSession, sf: str) -> DataFrame:
    return chat.format_conversations(read_table(spark, sf, "conversations"))


def op10_token_files(spark: SparkSession, sf: str) -> DataFrame:
    segments = token_files.write(read_table(spark, sf, "documents"), token_files.public_tokenizer())
    return token_files.digests(segments)


def op11_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf, "documents"))


def op12_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    ranks = byte_bpe.public_ranks()
    docs = read_table(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    coded = docs.select("doc_id", byte_bpe.encode(spark, ranks, F.col("text")).alias("ids"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(byte_bpe.id_bytes(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2(byte_bpe.decode(spark, ranks, F.col("ids")), 256).alias("decoded_sha256"),
    )


def op13_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return variants.group(variants.words(read_table(spark, sf, "documents"), delete_every=199))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_score": op1_lm_score,
    "op2_language_id": op2_language_id,
    "op3_quality": op3_quality,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_decontaminate": op5_decontaminate,
    "op6_pii": op6_pii,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_top_k": op8_top_k,
    "op9_chat": op9_chat,
    "op10_token_files": op10_token_files,
    "op11_collocations": op11_collocations,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_spelling_variants": op13_spelling_variants,
}

# Inner products of every query with every other vector; counts of all phrases of 1 to 3 words. The
# other operators are models, codings or iterations that SQL can't state; their tests compare
# with brute force.
ORACLE_SQL: dict[str, str] = {
    "op8_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(q.w) + 1), lambda i: q.w[i] * c.w[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op11_collocations": r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL
), t AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w FROM p),
g AS (
  SELECT lang, unnest(flatten(list_transform(range(1, len(w) + 1), lambda i:
    list_transform(range(i, least(i + 3, len(w) + 1)), lambda j: w[i:j])))) AS ids FROM t
), f AS (SELECT lang, ids, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE len(ids) = 1 GROUP BY ALL),
c AS (SELECT lang, ids, f AS a FROM f WHERE len(ids) > 1 AND f >= 10),
k AS (SELECT lang, ids, a, unnest(range(1, len(ids))) AS k FROM c),
s AS (
  SELECT k.lang, k.ids, a, k, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.ids = k.ids[1:k] JOIN f y ON y.lang = k.lang AND y.ids = k.ids[k + 1:]
), b AS (SELECT *, row_number() OVER (PARTITION BY lang, ids ORDER BY score, k) AS cut FROM s),
d AS (
  SELECT DISTINCT c.lang, c.ids FROM c JOIN (
    SELECT lang, ids[1:2] AS ids, a FROM c WHERE len(ids) = 3 UNION ALL SELECT lang, ids[2:3], a FROM c WHERE len(ids) = 3
  ) x ON x.lang = c.lang AND x.ids = c.ids WHERE 100 * x.a >= 50 * c.a
), r AS (
  SELECT b.lang, array_to_string(b.ids, ' ') AS phrase, a, l, r, n.n, score FROM b JOIN n ON n.lang = b.lang
  WHERE cut = 1 AND NOT EXISTS (SELECT 1 FROM d WHERE d.lang = b.lang AND d.ids = b.ids)
), o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM r)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM o WHERE rank <= 2000
""",
}
