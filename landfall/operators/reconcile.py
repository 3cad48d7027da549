"""Accounting: what was found, stored, skipped, failed and is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNIT = ["body_key", "partition_date"]
OUTCOMES = ("new", "changed", "unchanged", "skipped")
MEASURES = ("found", "scraped", "new", "changed", "unchanged", "skipped", "failed", "missing")


def document_failures(classified: DataFrame) -> DataFrame:
    """One row per failed document: ``body_key, partition_date, url, reason, status``."""
    return classified.filter(F.col("outcome") == "failed").select(
        *UNIT, F.col("document_url").alias("url"), "reason", "status")


def reconcile(found: DataFrame, outcomes: DataFrame, failures: DataFrame) -> DataFrame:
    """Counters per source and window; a unit seen in any input gets a row.

    One aggregate over the three inputs, so a unit holding most rows is
    combined before the shuffle. ``missing`` is clamped at zero per unit.
    """
    zero = F.lit(0).cast("bigint")
    counted = outcomes.filter(F.col("outcome").isin(*OUTCOMES)).select(*UNIT, "outcome", zero.alias("found"))
    failed = failures.select(*UNIT, F.lit("failed").alias("outcome"), zero.alias("found"))
    listed = found.select(*UNIT, F.lit("found").alias("outcome"), F.col("found").cast("bigint").alias("found"))
    per_unit = listed.unionByName(counted).unionByName(failed).groupBy(*UNIT).agg(
        F.sum("found").alias("found"),
        *[F.count_if(F.col("outcome") == o).alias(o) for o in (*OUTCOMES, "failed")],
    )
    scraped = sum((F.col(o) for o in OUTCOMES[1:]), F.col(OUTCOMES[0]))
    return (
        per_unit.withColumn("unit", F.concat_ws("/", *UNIT))
        .withColumn("scraped", scraped)
        .withColumn("missing", F.greatest(F.col("found") - F.col("scraped") - F.col("failed"), zero))
        .select("unit", *UNIT, *MEASURES)
        .orderBy("unit")
    )


def totals(per_unit: DataFrame) -> DataFrame:
    """Sums over all units, of the clamped ``missing`` as well."""
    return per_unit.agg(*[F.coalesce(F.sum(m), F.lit(0).cast("bigint")).alias(m) for m in MEASURES])


def summary_json(per_unit: DataFrame) -> DataFrame:
    """The summary as JSON lines: one object per unit. Failures stay a table of their own,
    because one unit may hold most of them."""
    return per_unit.select(F.to_json(F.struct("unit", *MEASURES)).alias("value"))
