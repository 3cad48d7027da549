"""A training corpus from ``documents``: filter, deduplicate, decontaminate, mix, shard.

Each stage takes all rows that its predecessor kept, as written to the shared scratch folder, and all but the last
return the columns of ``documents``. Every stage takes nulls, empty and long texts, ties, repeated rows, empty tables
and extra columns; what an operator defines for them holds here too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm import mixing, sharding, superminhash, toxicity, winnowing
from landfall.sources.staging import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Documents with this toxicity score or more are rejected.
TOXIC = 0.7
SHARDS = 16


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold. Without labels nothing is rejected."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs.select("doc_id", "text"), labels)
    return docs.withColumn("_score", toxicity.toxicity_score(F.col("text"), model)).where(
        F.col("_score") < TOXIC).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id.

    Documents without words are in no group and all stay. Of repeated rows (equal id and text) one stays.
    """
    found = superminhash.near_duplicates(docs, size=5, percent=80)
    rows = stage(found.select("doc_id", "text_key", "n_shingles", "component_id", "kept"), "pipeline-near")
    # A row is known by its id and text; several rows of a kept id stand for one document if they share a group.
    kinds = rows.groupBy("doc_id", "text_key").agg(
        F.count("*").alias("copies"), F.max("n_shingles").alias("n"), F.max("kept").alias("kept"),
        F.max("component_id").alias("component_id"))
    firsts = kinds.where("kept and n > 0").groupBy("component_id", "doc_id").agg(
        F.min("text_key").alias("text_key"), F.count("*").alias("texts"))
    spare = kinds.where("kept and n > 0").join(
        firsts.where("texts > 1").select(F.col("component_id").alias("_c"), F.col("doc_id").alias("_d"),
                                         F.col("text_key").alias("_first")),
        F.col("component_id").eqNullSafe(F.col("_c")) & F.col("doc_id").eqNullSafe(F.col("_d"))).where(
        "text_key <> _first").select("doc_id", "text_key")
    out = kinds.where("not kept").select("doc_id", "text_key").unionByName(spare)
    repeated = kinds.where("kept and n > 0 and copies > 1").select("doc_id", F.col("text_key").alias("_key"))
    once = _without(repeated, spare).withColumnRenamed("_key", "text_key")
    keyed = docs.select(*COLUMNS, F.xxhash64("text").alias("_key"))
    staying = _without(keyed, stage(out.unionByName(once), "pipeline-out"))
    again = _only(keyed, stage(once, "pipeline-once")).dropDuplicates(["doc_id", "_key"])
    return staying.unionByName(again).select(*COLUMNS)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with an item of the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = winnowing.find_passages(docs, items)
    out = stage(found.where("n_hit > 0").select("doc_id", "text_key").distinct(), "pipeline-passages")
    return _without(docs.select(*COLUMNS, F.xxhash64("text").alias("_key")), out).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: words taken by its size, rounded up; a document without words once.

    Mixing decides on words; a corpus of documents repeats whole ones, so a document that is taken in part counts whole.
    """
    taken = mixing.mix(docs.withColumn("_key", F.xxhash64("text")), carry=["_key"])
    times = taken.withColumn("times", F.when(F.col("size") == 0, F.lit(1)).otherwise(
        F.ceil(F.col("taken") / F.col("size")).cast("int")))
    per_row = stage(times.groupBy("doc_id", "source", "_key").agg(
        F.sum("times").alias("times"), F.count("*").alias("rows")), "pipeline-times")
    return _times(docs, per_row)


def _times(docs: DataFrame, per_row: DataFrame) -> DataFrame:
    """Rows as often as they are due; equal rows share their number evenly, rounded up."""
    keyed = docs.select(*COLUMNS, F.xxhash64("text").alias("_key"))
    named = per_row.select(F.col("doc_id").alias("_doc"), F.col("source").alias("_source"), F.col("_key").alias("_text"),
                           "times", "rows")
    joined = keyed.join(named, F.col("doc_id").eqNullSafe(F.col("_doc")) & F.col("source").eqNullSafe(F.col("_source"))
                        & (F.col("_key") == F.col("_text")))
    each = F.when(F.col("rows") == 1, F.col("times")).otherwise(F.ceil(F.col("times") / F.col("rows")))
    return joined.where(each > 0).select(*COLUMNS, F.explode(F.sequence(F.lit(1), each.cast("int"))).alias("_n")).select(*COLUMNS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, size, shard, slot``: where each row of the corpus is stored."""
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select("doc_id", "source", (F.octet_length(text) + 1).cast("bigint").alias("size"))
    placed = sharding.shard_table(slim, "doc_id", SHARDS, ["doc_id", "source", "size"])
    return placed.select("doc_id", "source", "size", "shard", "slot")


def _same() -> object:
    return F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_key") == F.col("_text"))


def _without(keyed: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of ``keyed`` that are not named in ``rows``, by id and hash of the text."""
    return keyed.join(rows.select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_text")), _same(), "left_anti")


def _only(keyed: DataFrame, rows: DataFrame) -> DataFrame:
    return keyed.join(rows.select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_text")), _same(), "left_semi")


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Signatures, the language model and hashes have no SQL counterpart; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
