"""The registered queries of the operators, each over whole tables with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from starledger.llm import byte_bpe, collocations, decontamination, language_id, near_duplicates, norm_search, oracles, packing
from starledger.llm import quality_classifier, quality_rules, repeated_text, sharding, token_counts, warc
from starledger.llm.common import held_out, ship, table
from starledger.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def _op1_warc_shards(spark: SparkSession, folder: str) -> DataFrame:
    archive = shared_folder(spark, "warc")
    warc.write_archives(table(spark, folder, "pages"), archive)
    return warc.read_archives(spark, archive).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def _op2_attention_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder)
    model = quality_classifier.train(docs, table(spark, folder, "labels"))
    scored = quality_classifier.classify(docs, model)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted", "n_passages")


def _op3_power_of_two_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack(_documents(spark, folder))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def _op4_weak_supervision_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(_documents(spark, folder))
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", "posterior")


def _op5_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.report(_documents(spark, folder), table(spark, folder, "benchmark"))


def _op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(_documents(spark, folder))


def _op7_repeated_text(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_text.report(_documents(spark, folder))


def _op8_ppm_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder)
    found = language_id.identify(docs, language_id.train(docs))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "bits_per_byte")


def _op9_karmarkar_karp_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(_documents(spark, folder))


def _op10_minhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates.near_duplicates(_documents(spark, folder), words=3, similarity_pct=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def _op11_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    decoded = byte_bpe.decode(byte_bpe.encode(_documents(spark, folder)))
    return decoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def _op12_norm_bucket_search(spark: SparkSession, folder: str) -> DataFrame:
    return norm_search.search(_documents(spark, folder), table(spark, folder, "benchmark"))


def _op13_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_documents(spark, folder))


_QUERIES: dict[str, Query] = {
    "op1_warc_shards": _op1_warc_shards,
    "op2_attention_quality": _op2_attention_quality,
    "op3_power_of_two_packing": _op3_power_of_two_packing,
    "op4_weak_supervision_rules": _op4_weak_supervision_rules,
    "op5_benchmark_decontamination": _op5_benchmark_decontamination,
    "op6_token_counts": _op6_token_counts,
    "op7_repeated_text": _op7_repeated_text,
    "op8_ppm_language_id": _op8_ppm_language_id,
    "op9_karmarkar_karp_shards": _op9_karmarkar_karp_shards,
    "op10_minhash_near_duplicates": _op10_minhash_near_duplicates,
    "op11_byte_bpe": _op11_byte_bpe,
    "op12_norm_bucket_search": _op12_norm_bucket_search,
    "op13_phrase_collocations": _op13_phrase_collocations,
    "pipeline": corpus_pipeline.run,
}


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return query(spark, folder)

    return run


def queries() -> dict[str, Query]:
    return {name: _shipped(query) for name, query in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_warc_shards": oracles.WARC,
        "op5_benchmark_decontamination": oracles.DECONTAMINATION,
        "op7_repeated_text": oracles.REPEATED_TEXT,
        "op10_minhash_near_duplicates": oracles.NEAR_DUPLICATES,
        "op12_norm_bucket_search": oracles.NORM_SEARCH,
        "op13_phrase_collocations": oracles.COLLOCATIONS,
    }
