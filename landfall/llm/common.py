"""Column helpers and table helpers shared by the operators."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.sources.staging import stage

#: Runs of ASCII white space, between words.
SPACES = r"[\x20\x09-\x0D]+"
#: Runs of ASCII characters that are neither letters nor digits.
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z to lower case, everything else as it is. ``lower`` does the same, faster, where a text is all ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def split_words(text: Column, separators: str = SPACES) -> Column:
    """The words of a text as an array; null and empty texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often and wherever in lambdas ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(df: DataFrame, group: list[str], order: list[str], weight: str | None, name: str) -> DataFrame:
    """Every row with its ``place`` (from 0) and ``start`` (sum of ``weight`` before it) within its group.

    ``group`` may be skewed: rows are dealt out by ranges of (group, order), so a large group spreads over many
    tasks, and equal rows are split by an arrival number. Each task numbers its range; one row per task and group
    then carries the totals of the ranges before. Rows equal in ``order`` are numbered in an arbitrary order.
    """
    keyed = stage(df.withColumn("_arrival", F.monotonically_increasing_id()), f"{name}-keyed")
    ranged = keyed.repartitionByRange(*group, *order, "_arrival").sortWithinPartitions(*group, *order, "_arrival")
    schema = T.StructType([*ranged.schema.fields, T.StructField("_range", T.IntegerType()),
                           T.StructField("_place", T.LongType()), T.StructField("_start", T.LongType())])
    placed = stage(ranged.withColumn("_range", F.spark_partition_id()).mapInArrow(
        _numbering(group, weight), schema), f"{name}-placed").drop("_arrival")
    ends = placed.groupBy("_range", *group).agg(
        F.count("*").alias("_rows"), F.sum(weight if weight else F.lit(0)).alias("_weight"))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(F.col("_range").alias("_of"), *[F.col(c).alias(f"_of_{c}") for c in group], F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
                       F.coalesce(F.sum("_weight").over(before), F.lit(0)).alias("_weight_before"))
    same = F.col("_range") == F.col("_of")
    for column in group:
        same = same & F.col(column).eqNullSafe(F.col(f"_of_{column}"))
    return placed.join(ends, same).select(*df.columns, (F.col("_place") + F.col("_rows_before")).alias("place"),
                                          (F.col("_start") + F.col("_weight_before")).alias("start"))


def _numbering(group: list[str], weight: str | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    import numpy as np

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, rows_seen, weight_seen = None, 0, 0  # of the group that the batch before ended with
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            new = np.zeros(n, dtype=bool)
            for column in group:
                values = batch.column(batch.schema.get_field_index(column)).dictionary_encode(null_encoding="encode")
                codes = values.indices.to_numpy(zero_copy_only=False)
                new[1:] |= codes[1:] != codes[:-1]
            first = tuple(batch.column(batch.schema.get_field_index(c))[0].as_py() for c in group)
            if first != last:
                rows_seen = weight_seen = 0
            weights = (pc.fill_null(batch.column(batch.schema.get_field_index(weight)), 0).to_numpy(
                zero_copy_only=False).astype(np.int64) if weight else np.zeros(n, dtype=np.int64))
            row = np.arange(n, dtype=np.int64)
            sums = np.cumsum(weights) - weights
            heads = np.flatnonzero(new)
            at = np.zeros(n, dtype=np.int64)
            at[heads] = heads
            at = np.maximum.accumulate(at)  # where the group of each row begins in this batch
            place, start = row - at, sums - sums[at]
            opening = at == 0
            place[opening] += rows_seen
            start[opening] += weight_seen
            last = tuple(batch.column(batch.schema.get_field_index(c))[n - 1].as_py() for c in group)
            rows_seen, weight_seen = int(place[-1]) + 1, int(start[-1] + weights[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(place), pa.array(start)], names=[*batch.schema.names, "_place", "_start"])

    return number
