"""Curation: slice, load, clean, rehash, compare and record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.functions import cleaning, content, identity
from landfall.functions.binding import let
from landfall.operators.sequence import compute_once
from landfall.sources.schemas import RECORD_COLUMNS
from landfall.sources.staging import small_side

MISSING_OBJECT = "missing object: "


def range_slice(records: DataFrame, start: Column, end: Column, day: str = "published_date") -> DataFrame:
    """Records with ``day`` in the half-open range; null days are in no slice.

    The raw column is compared, so the range reaches the Parquet scan.
    """
    return records.filter((F.col(day) >= start) & (F.col(day) < end))


def curated_bytes(doc_type: Column, data: Column, identifier: Column) -> Column:
    """html reduced to its content; other documents byte for byte."""
    cleaned = cleaning.clean_html(content.html_text(data), identifier).cast("binary")
    return F.when(doc_type == "html", cleaned).otherwise(data)


def load_objects(slice_: DataFrame, objects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records with their bytes, records whose object is missing).

    Objects are partitioned by the label inside the key; joining on it as well
    lets the scan skip other labels. The slice is the small side of the join with
    the bytes; missing keys are found from the key column alone.
    """
    labelled = slice_.withColumn("_label", identity.label_of_key(F.col("storage_path")))
    stored = objects.withColumnRenamed("partition_date", "_label")
    keys = ["_label", "storage_path"]
    loaded = stored.select(*keys, "data").join(small_side(labelled), keys).drop("_label")
    missing = labelled.join(stored.select(*keys), keys, "left_anti").drop("_label")
    return loaded, missing


def transform(slice_: DataFrame, objects: DataFrame, curated_hashes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(curated rows, failures) of a slice.

    A curated row is the landing record with new path, hash, length and the
    original ones beside them, its ``data`` and an ``outcome``. The hash curated
    earlier is joined before the bytes are, so bytes are moved at most once.
    Rows that come out as before are ``unchanged`` and keep no bytes.
    """
    earlier = curated_hashes.select("identifier", F.col("file_hash").alias("_curated_hash"))
    loaded, missing = load_objects(slice_.join(earlier, "identifier", "left"), objects)
    doc_type = F.col("document_type")
    output = compute_once(loaded, _output=let(
        curated_bytes(doc_type, F.col("data"), F.col("identifier")),
        lambda data: F.struct(data.alias("data"), content.sha256_hex(data).alias("hash"),
                              content.byte_length(data).alias("length")))).drop("data")
    ext = identity.document_extension(F.col("document_url"), doc_type)
    written = F.when(doc_type == "html", "transformed_html").otherwise("copied_asis")
    curated = output.withColumns({
        "original_storage_path": F.col("storage_path"),
        "original_file_hash": F.col("file_hash"),
        "storage_path": identity.curated_key(F.col("identifier"), ext),
        "file_hash": F.col("_output.hash"),
        "content_length": F.col("_output.length"),
        "content_type": identity.content_type(doc_type),
        "outcome": F.when(F.col("_output.hash") == F.col("_curated_hash"), "unchanged").otherwise(written),
    })
    curated = curated.withColumn("data", F.when(F.col("outcome") != "unchanged", F.col("_output.data"))).select(
        *RECORD_COLUMNS, "original_storage_path", "original_file_hash", "content_type", "outcome", "data")
    failures = missing.select(
        "identifier", F.concat(F.lit(MISSING_OBJECT), F.col("storage_path")).alias("reason"))
    return curated, failures


def summary(outcomes: DataFrame, failures: DataFrame) -> DataFrame:
    """One row: processed, transformed_html, copied_asis, unchanged, failed."""
    rows = outcomes.select("outcome").unionByName(failures.select(F.lit("failed").alias("outcome")))
    counts = rows.agg(*[F.count_if(F.col("outcome") == o).alias(o)
                        for o in ("transformed_html", "copied_asis", "unchanged", "failed")])
    processed = F.col("transformed_html") + F.col("copied_asis") + F.col("unchanged")
    return counts.select(processed.alias("processed"), "*")
