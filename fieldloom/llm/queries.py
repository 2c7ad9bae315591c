"""The registered queries: each applies its operator to its whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, chat, language, merkle, mixing, oracles, personal, quality_rules, secrets, simhash, spelling,
               tiling, toxicity,
               warc_zip)
from .common import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return add


TOKENIZER = "byte_bpe_50k.json"
PLANTED = r"\### Assistant: </turn> ok"


@query("op1_chat_format", oracles.CHAT)
def chat_format(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PLANTED).alias("text"))
    return chat.chat_digest(chat.read_back(chat.formatted(rows.unionByName(planted))))


@query("op2_decontamination")
def decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return tiling.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op4_mixing", oracles.MIXING)
def mixing_sources(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mixture(table(spark, sf, "documents")).drop("source")


@query("op5_simhash")
def simhash_groups(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf, "documents"))


@query("op6_quality_rules")
def quality(spark: SparkSession, sf: str) -> DataFrame:
    found = quality_rules.quality_verdicts(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        "n_repeat_words", "base_failed", "kept")


@query("op7_secrets")
def secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.secret_digest(secrets.secrets(table(spark, sf, "documents")))


@query("op10_personal_data")
def personal_data(spark: SparkSession, sf: str) -> DataFrame:
    return personal.personal_digest(personal.personal_data(table(spark, sf, "documents")))


@query("op3_toxicity")
def toxic_documents(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op8_warc_zip", oracles.DIGESTS)
def warc_packages(spark: SparkSession, sf: str) -> DataFrame:
    return warc_zip.archived(table(spark, sf, "pages"))


@query("op9_language")
def language_of_documents(spark: SparkSession, sf: str) -> DataFrame:
    return language.languages(table(spark, sf, "documents"))


@query("op13_merkle_manifest", oracles.MERKLE)
def merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.proof_digest(merkle.audit(table(spark, sf, "documents")))


@query("op12_spelling_groups", oracles.SPELLING)
def spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf, "documents"))


@query("op11_bpe_coding")
def bpe_coding(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return bpe.token_digest(bpe.decoded(bpe.encoded(docs, path).select("doc_id", "ids"), path))
