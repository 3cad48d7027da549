"""Captured responses as input: Parquet tables, or files with a manifest."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.sources import schemas
from landfall.sources.staging import small_side, stage


def read_fetches(spark: SparkSession, path: str) -> DataFrame:
    """Document captures stored as Parquet."""
    return spark.read.schema(schemas.FETCHES).parquet(path)


def save_fetches(fetches: DataFrame, table: str, buckets: int) -> None:
    """Store captures as a table bucketed by fetch number.

    Landing joins decisions to the bytes by that number; with buckets the bytes
    are not shuffled for it. Choose buckets of a few hundred megabytes.
    """
    fetches.repartition(buckets, "fetch_seq").write.bucketBy(buckets, "fetch_seq").sortBy("fetch_seq").mode(
        "overwrite").saveAsTable(table)


def read_listing_pages(spark: SparkSession, path: str) -> DataFrame:
    """Listing captures stored as Parquet."""
    return spark.read.schema(schemas.LISTING_PAGES).parquet(path)


def fetches_from_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Document captures stored one file each below ``folder``.

    ``manifest`` has ``file_name`` (the path below ``folder``), ``fetch_seq, url, status, error``; a row whose file is
    missing keeps its status or error and has no data. Files of one name in different folders are different files.
    """
    root = re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "", folder).strip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    path = F.regexp_replace("path", r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?/*", "")
    named = files.withColumn("_path", path).select(
        F.substring("_path", F.lit(len(root) + 2), F.length("_path")).alias("file_name"), "content")
    listed = stage(manifest.select("file_name", "fetch_seq", "url", "status", "error"), "manifest")
    columns = ["fetch_seq", "url", "status", "error"]
    present = named.join(small_side(listed), "file_name").select(*columns, F.col("content").alias("data"))
    missing = listed.join(named.select("file_name"), "file_name", "left_anti").select(*columns, F.lit(None).cast("binary").alias("data"))
    return present.unionByName(missing)
