"""The registered queries of the operators: their contracts' columns over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import chat, decontam, jaccard, langid, licences, mixing, neighbours, pii, quality, simhash, toxicity, variants, whitening
from ledgerloom.llm.shared import table


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec"))
    return neighbours.nearest(rows, F.col("vec_id") % 20 == 0, top=20)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def op3_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.positions(mixing.plan(table(spark, sf_dir, "documents")))
    return mixing.in_order(planned.select("doc_id", "size", "source_size", "target", "taken", "position"), "doc_id")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.with_probe(spark, table(spark, sf_dir, "conversations"))
    return chat.digest(chat.format_conversations(rows))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rated = table(spark, sf_dir, "labels").select("doc_id", quality.rating().alias("grade"))
    found = quality.classify(docs, quality.fit(docs, rated))
    tails = [found.tails[k].alias(f"p_at_least_{k + 1}") for k in range(2)]
    return found.select("doc_id", "expected_grade", *tails, "selected")


def op6_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=2)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"), size=5, percent=80)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_nearest_neighbours": op1_nearest_neighbours,
    "op2_pii": op2_pii,
    "op3_curriculum_mix": op3_curriculum_mix,
    "op4_chat_format": op4_chat_format,
    "op5_quality": op5_quality,
    "op6_licence_scan": op6_licence_scan,
    "op7_decontaminate": op7_decontaminate,
    "op8_toxicity": op8_toxicity,
    "op9_simhash_dedup": op9_simhash_dedup,
    "op10_language_id": op10_language_id,
    "op11_jaccard_join": op11_jaccard_join,
    "op12_whitening": op12_whitening,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE_SQL: dict[str, str] = {
    "op1_nearest_neighbours": neighbours.ORACLE,
    "op3_curriculum_mix": mixing.ORACLE,
    "op4_chat_format": chat.ORACLE,
    "op6_licence_scan": licences.oracle(),
    "op11_jaccard_join": jaccard.ORACLE,
}
