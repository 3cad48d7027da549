"""Registered queries: each applies one operator, with production parameters, to its whole table.

The columns are digests of what the operators return; texts, spans and files are theirs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landfall.llm import (credentials, license_index, mixing, neighbour_quality, ngram_ratio, prefix_trie, reply_trees, reversed_search, sharding, superminhash,
                          toxicity, warc, winnowing)
from landfall.sources.staging import scratch_root, stage


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(column: str, parts: int) -> Column:
    """The remainder of the checksum of an id as text."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % parts


def op1_reply_trees(spark: SparkSession, folder: str) -> DataFrame:
    """A conversation is a tree in which each row answers the one before; the longest branch is the best."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(control).alias("text"))
    numbered = rows.unionByName(extra).withColumn("id", F.row_number().over(
        Window.partitionBy("conv_id").orderBy("turn", "role", "text")))
    messages = numbered.select(F.col("conv_id").alias("tree"), "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"),
                               "role", "text", F.lit(1.0).alias("score"))
    formatted = reply_trees.format_conversations(messages)
    turns = reply_trees.read_turns(F.col("formatted"))
    read = formatted.select("tree", "formatted", "loss_spans", turns.alias("turns"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("loss_spans", lambda s: reply_trees.unescape(
        F.substring(F.col("formatted"), s["start"] + 1, s["length"]))), "")
    return read.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("bigint").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))


def op2_jump_shards(spark: SparkSession, folder: str) -> DataFrame:
    shards = sharding.shard_documents(table(spark, folder, "documents"), 16)
    return shards.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = f"{scratch_root(spark)}/warc-{uuid.uuid4().hex}"
    manifest = warc.write_archives(table(spark, folder, "pages"), archives)
    return warc.read_archives(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_credential_links(spark: SparkSession, folder: str) -> DataFrame:
    return credentials.summarize(credentials.find_secrets(table(spark, folder, "documents")))


def op5_neighbour_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    space = neighbour_quality.fit(documents.select("doc_id", "text"), labels.where(fold("doc_id", 5) != 0).select("doc_id", "quality"))
    scored = documents.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
                              neighbour_quality.quality_score(F.col("text"), space).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op6_low_discrepancy_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken", "first_slot")


def op7_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    found = winnowing.find_passages(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op8_ngram_ratio(spark: SparkSession, folder: str) -> DataFrame:
    trusted = table(spark, folder, "labels").where("quality = 1")
    judged = ngram_ratio.judge(table(spark, folder, "documents").select("doc_id", "text"), trusted)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                         "log_ratio")


def op9_noisy_channel_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.fit(documents.select("doc_id", "text"), labels.where(fold("doc_id", 3) != 1).select("doc_id", "toxic"))
    scored = documents.select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
                              toxicity.toxicity_score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op10_superminhash(spark: SparkSession, folder: str) -> DataFrame:
    found = superminhash.near_duplicates(table(spark, folder, "documents"), size=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op11_reversed_search(spark: SparkSession, folder: str) -> DataFrame:
    return reversed_search.rank_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark")).select(
        "item_id", "rank", "doc_id", "score")


def op12_license_index(spark: SparkSession, folder: str) -> DataFrame:
    found = license_index.find_licenses(table(spark, folder, "documents"))
    base, all_labels = F.col("places.label"), F.concat("places.label", "licenses.label")
    return found.select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"), F.array_min("places.start").alias("first_word"),
        F.array_max("places.start").alias("last_word"), F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(all_labels)), ",").alias("labels"),
        F.coalesce(F.array_max("licenses.share"), F.lit(0.0)).alias("score"))


#: Turns that a conversation may take over from the first of its five.
_TAKEN = 8


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations of five consecutive ids begin alike: with first turns of the first of them."""
    digested = prefix_trie.digest_turns(table(spark, folder, "conversations"))
    turns = stage(prefix_trie.number_turns(digested, "trie-original"), "trie-original")
    taken = fold("conv_id", _TAKEN + 1)
    all_ids = stage(turns.select("conv_id").distinct(), "trie-ids")
    first = turns.where(F.col("place") < _TAKEN).select(F.col("conv_id").alias("_first"), "place", "a", "b", "bytes")
    heads = all_ids.withColumn("taken", taken).join(first, F.col("conv_id") - F.col("conv_id") % 5 == F.col("_first")).where("place < taken")
    columns = ["conv_id", F.col("place").alias("turn"), "a", "b", "bytes"]
    rebuilt = heads.select(*columns).unionByName(turns.where(F.col("place") >= taken).select(*columns))
    return prefix_trie.prefix_trie(rebuilt, all_ids).withColumnRenamed("saved_bytes", "saved_tokens").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


QUERIES = {f.__name__: f for f in (
    op1_reply_trees, op2_jump_shards, op3_warc, op4_credential_links, op5_neighbour_quality, op6_low_discrepancy_mix, op7_winnowing, op8_ngram_ratio,
    op9_noisy_channel_toxicity, op10_superminhash, op11_reversed_search,
    op12_license_index, op13_prefix_trie)}
