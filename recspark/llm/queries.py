"""Registered queries of this subpackage and, where SQL can express them, their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.llm.divergence import oracle as divergence_oracle
from recspark.llm.licences import oracle as licence_oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op10_minhash_near_dedup")
def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recspark.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op6_bpe_pair_index")
def bpe_pair_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recspark.llm.bpe import decode, encode

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = encode(docs, vocabulary_path())
    # both digests come from one pass: the ids travel on beside the id into the decoder
    text = decode(ids.select(F.struct("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256")).alias("doc_id"), "ids"), vocabulary_path())
    return text.select("doc_id.*", F.sha2("text", 256).alias("decoded_sha256"))


@query("op7_mixture_packing")
def mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recspark.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), vocabulary_path())


@query("op5_crf_language_id")
def crf_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recspark.llm.crf import fit, held_out, identify

    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out(F.col("doc_id")))
    model = fit(docs.where(~F.col("held_out")))
    return identify(docs, model, keep=["doc_id", "held_out"]).select("doc_id", "held_out", "lang_pred", "score", "n_words", "n_switches")


@query("op1_kneser_ney_quality")
def kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recspark.llm.kneser_ney import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_suffix_dedup")
def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recspark.llm.suffix_dedup import remove_repeats

    out = remove_repeats(table(spark, sf_dir, "documents"), ["doc_id"])
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


TOP_K_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op4_pivot_top_k", TOP_K_SQL)
def pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recspark.llm.pivots import quantised_top_k

    return quantised_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op9_cross_polytope_ann")
def cross_polytope_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recspark.llm.cross_polytope import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op2_licence_sentences", licence_oracle())
def licence_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recspark.llm.licences import scan

    return scan(table(spark, sf_dir, "documents")).drop("hits")


CHAT_SQL = """
WITH t AS (SELECT *, last_value(CASE WHEN role = 'system' THEN turn END IGNORE NULLS) OVER w AS system, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER w AS "user"
           FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT conv_id, turn, conv_id || '-' || turn AS call_id, CASE WHEN role = 'user' AND system IS NOT NULL THEN 1 ELSE 0 END AS level, text IS NULL AS bad,
        CASE WHEN role = 'system' THEN '{"arguments":{' || coalesce('"settings":' || CAST(to_json(text) AS VARCHAR), '') || '},"id":"' || conv_id || '-' || turn || '","name":"configure"}'
             ELSE '{"arguments":{' || coalesce('"prompt":' || CAST(to_json(text) AS VARCHAR) || ',', '') || '"turn":' || turn || '},"id":"' || conv_id || '-' || turn || '","name":"reply"}' END AS line,
        CASE WHEN text IS NULL THEN 'missing ' || CASE WHEN role = 'system' THEN 'settings' ELSE 'prompt' END END AS missing
      FROM t WHERE role IN ('system', 'user')),
r AS (SELECT conv_id, turn, CASE WHEN "user" IS NOT NULL THEN conv_id || '-' || "user" END AS call_id,
        '{' || coalesce('"content":' || CAST(to_json(text) AS VARCHAR), '') || CASE WHEN text IS NOT NULL AND "user" IS NOT NULL THEN ',' ELSE '' END
            || coalesce('"tool_call_id":"' || conv_id || '-' || "user" || '"', '') || '}' AS line
      FROM t WHERE role IS NULL OR role NOT IN ('system', 'user')),
a AS (SELECT conv_id, turn, 0 AS part, CAST(NULL AS BIGINT) AS since, 'call' AS kind, call_id, level,
        concat_ws(';', missing, CASE WHEN call_id NOT IN (SELECT call_id FROM r WHERE call_id IS NOT NULL) THEN 'no result' END) AS errors, line FROM c
      UNION ALL
      SELECT r.conv_id, c.turn, 1, r.turn, CASE WHEN c.call_id IS NULL THEN 'orphan' ELSE 'result' END, r.call_id, c.level, '', r.line FROM r LEFT JOIN c ON c.call_id = r.call_id)
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY kind = 'orphan', level NULLS LAST, turn NULLS LAST, call_id, part, since, line) AS INTEGER) AS position,
       kind, call_id, CAST(level AS INTEGER) AS level, errors, line FROM a
"""


@query("op8_tool_call_linking", CHAT_SQL)
def tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recspark.llm.chat import conversation_calls, conversation_schemas, formatted

    calls, results = conversation_calls(table(spark, sf_dir, "conversations"))
    return formatted(calls, results, conversation_schemas(spark)).withColumn("errors", F.array_join("errors", ";"))


@query("op13_cross_tokenizer_alignment")
def cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from recspark.llm.alignment import aligned

    return aligned(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op11_source_divergence", divergence_oracle())
def source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recspark.llm.divergence import audit

    return audit(table(spark, sf_dir, "documents"))


@query("op12_katz_backoff")
def katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recspark.llm.katz import score

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    out = score(table(spark, sf_dir, "documents"), ~held)
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
