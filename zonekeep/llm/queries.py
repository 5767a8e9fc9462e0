"""Driver queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonekeep.llm import bpe, chat, dedup, fingerprints, html_text, lm, mixing, quality, secrets, topk


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(_table(spark, sf_dir, "documents"), vocabulary(), ids=False)


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", topk.whole_numbers(F.col("embedding")).alias("v"))
    return topk.top_k(vectors, F.col("vec_id") % 100 == 0)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_documents(_table(spark, sf_dir, "documents"), secrets.train(secrets.labelled_findings()))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.conversation_digests(chat.format_conversations(turns.unionByName(extra)))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(_table(spark, sf_dir, "pages"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.fit_on(docs, _table(spark, sf_dir, "labels")))


def op9_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(_table(spark, sf_dir, "documents"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_bpe": op2_bpe,
    "op3_top_k": op3_top_k,
    "op4_secrets": op4_secrets,
    "op5_chat_format": op5_chat_format,
    "op6_html_text": op6_html_text,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_quality": op8_quality,
    "op9_imatch": op9_imatch,
    "op10_lm_score": op10_lm_score,
}

ORACLES: dict[str, str] = {
    "op3_top_k": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        pairs AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
                  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0)
        SELECT query_id, rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM pairs) WHERE rank <= 10""",
    "op5_chat_format": r"""
        WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        e AS (SELECT *, length(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g')) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + 23 AS written FROM t)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(written)::BIGINT AS formatted_chars
        FROM e GROUP BY conv_id""",
}
