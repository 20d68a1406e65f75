"""One query for each operator of this package over the given tables, and the SQL it must agree with."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from growthlab.llm import (
    archives,
    ctw,
    licences,
    mixing,
    neardup,
    pii,
    preferences,
    quality,
    repair,
    sql,
    substrings,
    tiling,
    tokens,
    trie,
)
from growthlab.llm.storage import forget_folders, stored
from growthlab.session import fresh_folder


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return tiling.find_leaks(docs, _table(spark, folder, "benchmark"))


def op2_private_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = pii.find_private(docs)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS)],
        F.sha2(pii.span_text("base"), 256).alias("base_sha256"),
        pii.span_text("spans").alias("spans"),
    )


#: whole-number weights of the source tree by path; the top level is read off the source
WEIGHTS = {"web": 5, "forum": 2, "books": 3, "web/en": 4, "forum/en": 3, "books/en": 2, "web/en/src0": 3}
WEB, FORUM = [f"src{k}" for k in range(5)], [f"src{k}" for k in range(5, 10)]


def source_tree() -> dict[str, Column]:
    source = F.col("source")
    domain = F.when(source.isin(WEB), "web").when(source.isin(FORUM), "forum").when(source.isNotNull(), "books")
    return {"domain": domain, "lang": F.col("lang"), "source": source}


def op3_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    mixed = mixing.mix_sources(docs, source_tree(), WEIGHTS, share_percent=80, max_epochs=2, seed="7")
    return mixed.select("doc_id", "epoch", "domain", "lang", "source", "n_tokens", "budget")


def op4_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return neardup.near_duplicates(docs, shingle=2, percent=80)


def op5_language_model(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return ctw.score_texts(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 2)


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    trusted = _table(spark, folder, "labels").where("quality = 1 AND toxic = 0")
    return quality.quality_rules(docs, trusted)


def op7_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = licences.scan_licences(docs)
    names = F.array_sort(F.array_distinct(F.transform("licences", lambda x: x["licence"])))
    places = F.transform("licences", lambda x: F.concat_ws(":", x["licence"], x["start"].cast("string"), x["end"].cast("string")))
    return found.select(
        "doc_id",
        F.size("sentences").cast("long").alias("n_sentences"),
        F.array_join(names, ",").alias("licences"),
        F.array_join(places, ",").alias("places"),
    )


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    kept = substrings.remove_repeats(docs, length=20)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return tokens.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def op10_preference_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations 2k (chosen) and 2k + 1 (rejected)."""
    turns = _table(spark, folder, "conversations")
    side = lambda odd: F.max(F.when(F.col("conv_id").bitwiseAND(1) == odd, F.col("conv_id")))
    pairs = turns.where("conv_id IS NOT NULL").groupBy(F.shiftright("conv_id", 1).alias("pair_id"))
    pairs = pairs.agg(side(0).alias("chosen_id"), side(1).alias("rejected_id"))
    made = preferences.preference_records(turns, pairs)
    return made.withColumns({c: preferences.span_text(c) for c in ("chosen_train", "rejected_train")})


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with rows dropped, emptied, cut short, repeated or given another role, by crc32 of conv_id:turn."""
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select("conv_id", "turn", known("role").alias("role"), known("text").alias("text"))
    rows = rows.withColumn("fate", F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % 20).where("fate <> 0")
    fate = F.col("fate")
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(fate == 4, "user").otherwise(F.col("role"))
    times = F.when(fate == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy"))


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    report = repair.repair_report(damaged(turns))
    ids = turns.select("conv_id").distinct().withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    empty = {**dict.fromkeys(counts, 0), "audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    return ids.join(report, "conv", "left").fillna(empty).select("conv_id", *counts, "audit", "repaired_sha256")


def op12_warc_records(spark: SparkSession, folder: str) -> DataFrame:
    """Pages written as legacy archives of both versions, converted to WARC and read back."""
    legacy = archives.write_arc(_table(spark, folder, "pages").select("page_id", "url", "html"))
    warc = fresh_folder(spark, "warc")
    archives.convert(spark, legacy, warc, rank_head="X-Page-Id")
    forget_folders(spark, legacy)
    records = archives.read_warc(spark, warc, payloads=False).where("type <> 'warcinfo'")
    records = records.withColumn("page_id", F.try_element_at("http", F.lit("x-page-id")).cast("long"))
    first = records.where("type = 'response'")
    later = records.where("type = 'revisit'").select("page_id", "declared_digest", "type", F.col("refers_to").alias("record_id"))
    sizes = first.select("record_id", "payload_bytes", F.col("page_id").alias("refers_to"))
    later = later.join(sizes, "record_id").select("page_id", "payload_bytes", "declared_digest", "type", "refers_to")
    kept = first.select("page_id", "payload_bytes", "payload_digest", "type", F.lit(None).cast("long").alias("refers_to"))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    out = stored(kept.toDF(*names).unionByName(later.toDF(*names)), "page_records")
    forget_folders(spark, warc)
    return out


def with_shared_heads(paths: DataFrame) -> DataFrame:
    """Each conversation's first h turns replaced by those of the conversation that opens its twenty; h is crc32 of
    its number modulo 4."""
    h = (F.crc32(F.col("conv_id").cast("string")) % 4).cast("int")
    heads = paths.where("conv_id % 20 = 0").select(F.col("conv_id").alias("opening"), F.slice("turns", 1, 3).alias("head"))
    rows = paths.withColumns({"opening": F.expr("conv_id - conv_id % 20"), "h": h}).join(heads, "opening", "left")
    head = F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), F.col("h"))).otherwise(F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("h") + 1, F.size("turns") + 1)
    return rows.select("conv_id", F.concat(head, rest).alias("turns"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    paths = trie.paths_of(_table(spark, folder, "conversations"), "conv_id", "turn", "role", "text")
    return trie.prefix_trie(with_shared_heads(paths))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_benchmark_leaks": op1_benchmark_leaks,
    "op2_private_data": op2_private_data,
    "op3_source_mix": op3_source_mix,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_language_model": op5_language_model,
    "op6_quality_rules": op6_quality_rules,
    "op7_licence_scan": op7_licence_scan,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_token_counts": op9_token_counts,
    "op10_preference_pairs": op10_preference_pairs,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_warc_records": op12_warc_records,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE_SQL: dict[str, str] = {**sql.ALL, "op3_source_mix": sql.source_mix(WEIGHTS, WEB, FORUM)}
