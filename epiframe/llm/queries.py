"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epiframe.llm import decontaminate, language_id, line_dedup, media, mixing, quality, secret_scan, simhash, substring_dedup, token_counts
from epiframe.llm.common import documents, fold

TOKENIZER = "byte_bpe_50k.json"


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(documents(spark, sf_dir))


def op2_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.text_media(documents(spark, sf_dir))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(fold(F.col("doc_id"), 3) != 1)
    scored = quality.scores(docs, quality.train(docs, labels))
    return scored.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash.near_components(documents(spark, sf_dir))
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["end"] - h["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language_id.train(docs.where(fold(F.col("doc_id"), 4) != 2))
    found = language_id.predict(docs, model)
    return found.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counts = token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))
    return counts.select("*", (F.col("n_tokens") > 512).alias("over_limit"))


def _joined(findings: Column) -> Column:
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")


def _of_kinds(*kinds: str) -> Column:
    return F.filter("findings", lambda f: f["kind"].isin(*kinds))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(documents(spark, sf_dir), secret_scan.fresh_ledger(spark))
    base = tuple(r.kind for r in secret_scan.RULES)
    counts = [F.size(_of_kinds(k)).cast("long").alias(f"n_{k}") for k in base]
    return found.select("doc_id", *counts, F.sha2(_joined(_of_kinds(*base)), 256).alias("base_sha256"), _joined(F.col("findings")).alias("spans"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_substring_dedup": op1_substring_dedup,
        "op2_media": op2_media,
        "op3_quality": op3_quality,
        "op4_simhash": op4_simhash,
        "op5_decontamination": op5_decontamination,
        "op6_language_id": op6_language_id,
        "op7_token_counts": op7_token_counts,
        "op8_secret_scan": op8_secret_scan,
        "op9_mixing": op9_mixing,
        "op10_line_dedup": op10_line_dedup,
    }
