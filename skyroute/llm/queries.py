"""The registered queries of this subpackage."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyroute.llm import (
    audit,
    chat,
    crf,
    decontaminate,
    licenses,
    lines,
    packing,
    recompress,
    rules,
    search,
    simhash,
    sql,
    suffixes,
    tokens,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers look for this package where the driver has it, besides --py-files.
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("row.doc_id", *(f"figures.{c}" for c in counts), "base_failed", "kept")


def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return chat.digests(chat.format_chats(rows.unionByName(probe)))


def power_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    pieces = packing.pack(docs, packing.default_vocabulary(), with_ids=False)
    return pieces.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def minhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_item", "n_shared", "containment")


def fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(table(spark, sf_dir, "documents"))


def line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = crf.score(docs, crf.fit(docs, table(spark, sf_dir, "labels")))
    scored = scored.select("row.doc_id", crf.held_out("row.doc_id").alias("held_out"), "score")
    return scored.withColumn("predicted", (F.col("score") >= crf.THRESHOLD).cast("int"))


_CUT = ("doc_id", "n_words", "n_removed", "kept_sha256")


def recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompress.dedup(table(spark, sf_dir, "documents")).select(*_CUT)


def suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.dedup(table(spark, sf_dir, "documents")).select(*_CUT)


def gray_code_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokens.prefix_counts(table(spark, sf_dir, "documents"), tokens.default_vocabulary())
    return counted.select("doc_id", "n_bytes", "n_tokens", tokens.over_limit().alias("over_limit"))


QUERIES = {
    "op1_license_scan": license_scan,
    "op2_quality_rules": quality_rules,
    "op3_line_crf": line_crf,
    "op4_minhash_decontamination": minhash_decontamination,
    "op5_recompression": recompression,
    "op6_chat_formatting": chat_formatting,
    "op7_power_packing": power_packing,
    "op8_fuzzy_lines": fuzzy_lines,
    "op9_simhash_components": simhash_components,
    "op10_suffix_array": suffix_array,
    "op11_gray_code_audit": gray_code_audit,
    "op12_reversed_search": reversed_search,
    "op13_prefix_token_counts": prefix_token_counts,
}
ORACLES = {
    "op1_license_scan": sql.license_sql(),
    "op2_quality_rules": sql.QUALITY_RULES,
    "op4_minhash_decontamination": sql.CONTAINMENT,
    "op5_recompression": sql.REPEATS,
    "op6_chat_formatting": sql.CHAT_FORMATTING,
    "op10_suffix_array": sql.REPEATS,
    "op11_gray_code_audit": sql.filter_audit_sql(),
    "op12_reversed_search": sql.RANKED_SEARCH,
}
