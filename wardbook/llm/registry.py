"""The subpackage's registered queries, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardbook.llm import collocations, decontamination, extraction, language, mixing, ngram_join, oracle, packing, pii, quality, substrings, token_alignment, toxicity, url_filters

Query = Callable[[SparkSession, str], DataFrame]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def crc_of_id() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string"))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.leaks(documents, read(spark, sf_dir, "benchmark"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_of_id() % 4 == 2, F.lit(False))
    model = language.trained(documents.where(~held_out).select("doc_id", "text", "lang"))
    return language.identified(documents.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


#: The key of the registered query; a production run passes its own secret.
PII_KEY = "registered query"


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymised(read(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mixed(documents).select("doc_id", "size", "source_size", "target", "taken")


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicated(read(spark, sf_dir, "documents").select("doc_id", "text"))


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as captures: fetched some hours after the start of 2024, by page_id."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    hours = F.pmod(F.col("page_id") * 7919, F.lit(8784))
    return pages.withColumn("fetched_at", F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'") + _hours(hours))


def _hours(n: F.Column) -> F.Column:
    return F.make_dt_interval(hours=n.cast("int"))


def url_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dated list made from the pages' own hosts: some hosts, parent domains and folders
    are added in the year's first half, some of them removed and added again later."""
    hosts = read(spark, sf_dir, "pages").select(url_filters.host_of(F.col("url")).alias("host"), "url")
    parent = F.concat_ws(".", F.slice(F.split("host", r"\."), -3, 3))
    folder = F.regexp_extract(F.lower("url"), r"^[a-z]+://[^/?#]*/([^/?#]+)/", 1)
    patterns = (
        hosts.where("host IS NOT NULL")
        .select(
            F.explode(
                F.array(
                    F.struct(F.col("host").alias("pattern"), F.lit("host").alias("category")),
                    F.struct(F.when(F.size(F.split("host", r"\.")) > 3, parent).alias("pattern"), F.lit("domain").alias("category")),
                    F.struct(F.when(folder != "", F.concat("host", F.lit("/"), folder)).alias("pattern"), F.lit("folder").alias("category")),
                )
            ).alias("entry")
        )
        .select("entry.*")
        .where("pattern IS NOT NULL")
        .groupBy("pattern")
        .agg(F.max("category").alias("category"))
        .withColumn("code", F.conv(F.substring(F.md5("pattern"), 1, 8), 16, 10).cast("long"))
    )
    start = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'")

    def change(action: str, hours: F.Column, category: F.Column) -> F.Column:
        return F.struct(F.lit(action).alias("action"), (start + _hours(hours)).alias("listed_at"), category.alias("category"))

    first = F.pmod("code", F.lit(4000))
    changes = F.array(
        F.when(F.pmod("code", F.lit(3)) < 2, change("add", first, F.col("category"))),
        F.when(F.pmod("code", F.lit(2)) == 0, change("remove", first + 1500, F.lit(None).cast("string"))),
        F.when(F.pmod("code", F.lit(5)) == 0, change("add", first + 3000, F.lit("again"))),
    )
    return (
        patterns.select("pattern", F.explode(F.filter(changes, lambda x: x.isNotNull())).alias("c"))
        .select("pattern", "c.action", "c.listed_at", "c.category")
    )


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.filtered(captures(spark, sf_dir), url_list(spark, sf_dir)).select(
        "page_id", "url", "fetched_at", "host", "blocked", "pattern", "category", "valid_from"
    )


def op8_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extracted(read(spark, sf_dir, "pages"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.measured(documents).select(
        "doc_id",
        *[
            f"quality.{c}"
            for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
        ],
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(crc_of_id() % 5 == 0, F.lit(False))
    labels = read(spark, sf_dir, "labels").where(~held_out)
    model = toxicity.trained(documents, labels.select("doc_id", "toxic"))
    return toxicity.scored(documents, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    return token_alignment.alignment_scores(documents).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps", "n_shared"
    )


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_pieces(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_decontamination": op1_decontamination,
    "op2_language": op2_language,
    "op3_pii": op3_pii,
    "op4_mixing": op4_mixing,
    "op5_ngram_join": op5_ngram_join,
    "op6_substrings": op6_substrings,
    "op7_url_filters": op7_url_filters,
    "op8_extraction": op8_extraction,
    "op9_quality": op9_quality,
    "op10_toxicity": op10_toxicity,
    "op11_token_alignment": op11_token_alignment,
    "op12_packing": op12_packing,
    "op13_collocations": op13_collocations,
}


def statements() -> dict[str, str]:
    return oracle.statements()
