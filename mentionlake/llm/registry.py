"""The registered queries of the operators here, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionlake.llm import classlm, conversations, decontamination, lines, mixing, multiset, oracle, phrases, quality, sharding, simhash, toxicity, urls, warc
from mentionlake.llm.common import table, word_count

Query = Callable[[SparkSession, str], DataFrame]


def op1_nnpu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.classify(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"), keep=["doc_id"])
    return found.select("doc_id", "held_out", "score", "predicted")


def op2_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op3_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all pages to archives in the shared folder and reads these back."""
    records = warc.read_archives(warc.write_archives(table(spark, sf_dir, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 15 by law ``key``; a text's bytes are none where it is null."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.lit("key").alias("law"))
    placed = sharding.place(docs, tie=[F.col("text_crc32"), F.col("size")])
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op5_wu_manber_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc_id", "n_words", decontamination.n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), decontamination.contaminated().alias("contaminated"))


def op6_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = multiset.edited_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = rows.withColumn("edited_fp", multiset.fingerprint(F.col("edited")))
    fp, edited, following = F.col("fp"), F.col("edited_fp"), F.col("next_fp")
    return rows.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        multiset.to_hex(fp).alias("fingerprint"), multiset.to_hex(edited).alias("edited_fingerprint"),
        multiset.likeness(fp, edited).alias("near_edited"), multiset.likeness(fp, following).alias("near_next"))


def op7_line_edit_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, those that dedup removes (places from 0), and the links of its lines to other lines."""
    found = lines.duplicate_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), F.array_join("removed", ",").alias("removed"), "n_links")


def op8_path_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "template", "purity")


def op9_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity.classify(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"), keep=["doc_id"])
    return found.select("doc_id", "held_out", "score", "predicted")


def op10_curriculum_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents, in the order of their first training position."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.curriculum(docs, word_count(F.col("text")))
    first = F.get("positions", F.lit(0))
    return mixed.select(
        "doc_id", "size", "source_size", "target", "taken", F.size("positions").alias("copies"), first.alias("position"),
    ).orderBy(F.col("position").asc_nulls_last(), "doc_id")


def op11_auction_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(table(spark, sf_dir, "conversations"))


def op12_phrase_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_brown_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classlm.log_probabilities(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_nnpu_quality": op1_nnpu_quality,
    "op2_golay_simhash": op2_golay_simhash,
    "op3_warc_zstd": op3_warc_zstd,
    "op4_rendezvous_sharding": op4_rendezvous_sharding,
    "op5_wu_manber_decontamination": op5_wu_manber_decontamination,
    "op6_multiset_hash": op6_multiset_hash,
    "op7_line_edit_join": op7_line_edit_join,
    "op8_path_templates": op8_path_templates,
    "op9_counterfactual_toxicity": op9_counterfactual_toxicity,
    "op10_curriculum_mixing": op10_curriculum_mixing,
    "op11_auction_repair": op11_auction_repair,
    "op12_phrase_growth": op12_phrase_growth,
    "op13_brown_class_lm": op13_brown_class_lm,
}
ORACLES: dict[str, str] = {name: sql for name, sql in oracle.SQL.items() if name in QUERIES}
