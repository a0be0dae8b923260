"""The operators as queries over the public tables, with SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.llm import (
    byte_bpe,
    conversations,
    decontamination,
    filter_audit,
    language,
    licenses,
    toxicity,
    warc,
)
from vitalgrid.llm.common import table
from vitalgrid.llm.fingerprints import classed_fingerprints
from vitalgrid.llm.mixing import mix_sources
from vitalgrid.llm.nearest import nearest_by_inner_product
from vitalgrid.llm.ngram_join import ngram_classes
from vitalgrid.llm.oracles import ORACLES  # noqa: F401
from vitalgrid.llm.passages import remove_repeats


def toxic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(documents, model)
    return scored.select("doc_id", (toxicity.fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest_by_inner_product(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_rows(table(spark, sf_dir, "documents"), digests=True)


def warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def language_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.predict_language(documents, language.fit(documents))
    return found.select("doc_id", (toxicity.fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classed_fingerprints(table(spark, sf_dir, "documents"))


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(documents).select("doc_id", "text", "n_removed", "removed_bytes", "removed")


def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_classes(table(spark, sf_dir, "documents"))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversations.damage(table(spark, sf_dir, "conversations"))
    return conversations.repair_conversations(damaged, copies="copies")


def benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.contamination(documents, table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(ids, 256).alias("items_sha256"), "contaminated")


def filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1}
    failed = filter_audit.failures(table(spark, sf_dir, "documents"))
    rows = filter_audit.labelled(failed, table(spark, sf_dir, "labels"), marks)
    return filter_audit.audit_filters(rows, "ABCDE", list(marks))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": toxic_documents,
    "op2_nearest": nearest_vectors,
    "op3_mixing": mixing,
    "op4_byte_bpe": bpe_round_trip,
    "op5_warc": warc_round_trip,
    "op6_language": language_of_documents,
    "op7_minhash": minhash,
    "op8_substring_dedup": substring_dedup,
    "op9_ngram_jaccard_join": ngram_jaccard,
    "op10_licenses": license_scan,
    "op11_conversation_repair": conversation_repair,
    "op12_decontamination": benchmark_leaks,
    "op13_filter_audit": filter_interactions,
}