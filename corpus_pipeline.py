"""From raw documents to token ids: five stages, each a written table that the next one reads.

Defined results: the columns of documents may hold nulls and stand beside other
columns, whatever their names, up to the last stage, which returns its own.  A
null or empty text is scored like any other by the quality classifier, is a near
duplicate of every text without words, has no secrets, stays once in the mix
if it stays at all, and has no ids.  Rows that repeat an id and text are one
document after the near-duplicate stage.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zonekeep.llm import bpe, dedup, mixing, quality, secrets
from zonekeep.llm.queries import vocabulary
from zonekeep.store import discard, stage


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled rows, does not reject."""
    model = quality.fit_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return dedup.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced by a mark."""
    return secrets.redact_documents(docs, secrets.train(secrets.labelled_findings()))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that the sources come in their target shares."""
    return mixing.repeat_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and the token ids of every document of the mix."""
    return bpe.encode_documents(docs, vocabulary(), keep=("doc_id", "lang", "source"), ids=True, digests=False)


STAGES = [
    ("quality classifier", keep_good),
    ("near duplicates", drop_near_duplicates),
    ("secret scan", redact_secrets),
    ("source mix", mix),
    ("encoding", encode),
]

#: SQL expresses neither the fitted models nor the encoding; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        before, docs = docs, stage(step(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
