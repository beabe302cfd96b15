"""One query per operator, over whole tables with production parameters, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    exact_dedup, jaccard_join, licenses, mixing, neighbours, orchard, packing, positional_index, quality, token_counts, token_links, toxicity, url_filter,
)

VOCABULARY = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_length_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"))


def op2_recurrent_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classify(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, folder, "pages"))


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Place of a public vocabulary file on the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, folder, "documents"), vocabulary_path())


def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(_table(spark, folder, "documents"))
    best = F.array_max(F.transform("hits", lambda h: h["coverage"]))
    return found.select(
        "doc_id",
        F.size("hits").alias("n_hits"),
        F.array_join(F.array_sort(F.array_distinct("hits.template")), ",").alias("licenses"),
        F.get("hits.begin", F.lit(0)).alias("first_word"),
        best.alias("best_coverage"),
    )


def op6_chosen_path(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.similar_classes(_table(spark, folder, "documents"))


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    sha = exact_dedup.text_sha256(F.col("text"))
    found = exact_dedup.exact_groups(docs, carry={"text_sha256": sha})
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_quality_machine(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op9_cross_polytope(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    return neighbours.nearest(vectors, F.col("vec_id") % 50 == 0)


def op10_curriculum_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Documents in training order, by their first use; those the mix does not take come last."""
    mixed = mixing.mix(_table(spark, folder, "documents"))
    first = F.get("placements", F.lit(0))["position"]
    order = [first.asc_nulls_last(), F.col("doc_id")]
    ordered = mixed.repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.select(
        "doc_id", "size", "source_size", "target", "taken", F.round(first, 9).alias("first_position"),
    )


def op11_token_links(spark: SparkSession, folder: str) -> DataFrame:
    return token_links.aligned_tokens(_table(spark, folder, "documents"), vocabulary_path(), vocabulary_path(PIECES))


def op12_positional_index(spark: SparkSession, folder: str) -> DataFrame:
    found = positional_index.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op13_orchard_codes(spark: SparkSession, folder: str) -> DataFrame:
    return orchard.compress(_table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_length_buckets, op2_recurrent_toxicity, op3_url_filter, op4_token_counts, op5_license_scan, op6_chosen_path, op7_exact_dedup, op8_quality_machine, op9_cross_polytope, op10_curriculum_mix,
        op11_token_links, op12_positional_index, op13_orchard_codes,
    )
}
