"""One query per operator, over the whole of its table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    chat,
    classifier,
    common,
    decontamination,
    jaccard,
    licenses,
    lm,
    merkle,
    packing,
    quality_rules,
    search,
    sharding,
    substrings,
    urls,
)

# The rules that every URL is judged by.
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
SEQUENCE = 4096
SHARDS = 8
GOOD_SCORE = 0.3
# Fixed value: a conversation of control strings alone.
CONTROL_TURNS = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, directory: str) -> DataFrame:
    templates = spark.createDataFrame(list(licenses.TEMPLATES), "license_id string, text string")
    return licenses.license_scan(common.documents(spark, directory), templates)


def op2_decontamination(spark: SparkSession, directory: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{directory}/benchmark.parquet")
    judged = decontamination.contamination(common.documents(spark, directory), benchmark, keep=["doc_id"])
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op3_url_filter(spark: SparkSession, directory: str) -> DataFrame:
    pages = spark.read.parquet(f"{directory}/pages.parquet")
    return urls.filter_urls(pages, urls.rule_table(spark, URL_RULES), "page_id")


def op4_ngram_jaccard(spark: SparkSession, directory: str) -> DataFrame:
    docs = common.documents(spark, directory).select("doc_id", "text")
    return jaccard.jaccard_join(docs).rows.select("doc_id", "n_shingles", "component_id")


def op5_best_fit_packing(spark: SparkSession, directory: str) -> DataFrame:
    return packing.pack_documents(common.documents(spark, directory), vocabulary(), SEQUENCE)


def op6_substring_dedup(spark: SparkSession, directory: str) -> DataFrame:
    docs = common.documents(spark, directory).select("doc_id", "text")
    cleaned = substrings.substring_dedup(docs)
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op7_sharding(spark: SparkSession, directory: str) -> DataFrame:
    rows = sharding.shard_documents(common.documents(spark, directory), SHARDS)
    return rows.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op8_quality_rules(spark: SparkSession, directory: str) -> DataFrame:
    return quality_rules.quality_rules(common.documents(spark, directory), with_text=False)


def op9_lm_scoring(spark: SparkSession, directory: str) -> DataFrame:
    scored = lm.score_documents(common.documents(spark, directory))
    mean = F.when(F.col("n_words") > 0, F.round(F.col("log_score") / F.col("n_words"), 6))
    return scored.withColumns({"log_score": F.round("log_score", 6), "mean_log_score": mean})


def op10_quality_classifier(spark: SparkSession, directory: str) -> DataFrame:
    docs = common.documents(spark, directory).select("doc_id", "text")
    labels = spark.read.parquet(f"{directory}/labels.parquet")
    scored = classifier.quality_scores(docs, labels, keep_text=False)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= GOOD_SCORE).cast("int").alias("predicted"))


def op11_merkle_manifest(spark: SparkSession, directory: str) -> DataFrame:
    docs = common.documents(spark, directory)
    lowered = {name: common.ascii_lower(docs["text"]) if name == "text" else docs[name] for name in merkle.FIELDS}
    chosen = F.pmod(F.crc32(docs["doc_id"].cast("string").cast("binary")), F.lit(5)) == 0
    tampered = F.when(chosen, merkle.leaf_digest(lowered))
    proven = merkle.manifest(docs, {"tampered": tampered})
    folded = merkle.folded(F.coalesce("tampered", "leaf"), F.col("path"))
    return proven.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_ranked_search(spark: SparkSession, directory: str) -> DataFrame:
    return search.ranked_search(common.documents(spark, directory), spark.read.parquet(f"{directory}/benchmark.parquet"))


def op13_chat_formatting(spark: SparkSession, directory: str) -> DataFrame:
    turns = spark.read.parquet(f"{directory}/conversations.parquet").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame(CONTROL_TURNS, "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.chat_windows(turns.unionByName(control), vocabulary()))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_license_scan": op1_license_scan,
        "op2_decontamination": op2_decontamination,
        "op3_url_filter": op3_url_filter,
        "op4_ngram_jaccard": op4_ngram_jaccard,
        "op5_best_fit_packing": op5_best_fit_packing,
        "op6_substring_dedup": op6_substring_dedup,
        "op7_sharding": op7_sharding,
        "op8_quality_rules": op8_quality_rules,
        "op9_lm_scoring": op9_lm_scoring,
        "op10_quality_classifier": op10_quality_classifier,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_ranked_search": op12_ranked_search,
        "op13_chat_formatting": op13_chat_formatting,
    }
