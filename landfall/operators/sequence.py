"""Looking back within a key without gathering the key in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_SPAN = 1_000_000


def blocks(order: str, span: int) -> Column:
    """Number of the block of ``span`` consecutive values that an integer order column falls in."""
    return F.expr(f"`{order}` DIV {span}L")


def previous_value(rows: DataFrame, key: str, order: str, value: str, output: str,
                   seed: DataFrame | None = None, block: Column | None = None) -> DataFrame:
    """Add ``output``: the latest non-null ``value`` of the same key before this row.

    ``order`` must be unique within a key. ``seed`` holds one ``(key, value)``
    per key known from earlier; it counts as preceding everything.

    One key may hold a large share of all rows, so no window spans a whole key.
    Rows are split into blocks of the order column. Windows look back within a
    block; the last value of each block (an aggregate with map-side combine) is
    carried to the key's later blocks in a second window that sees one row per
    block. ``block`` must not decrease with ``order``; by default it is
    ``order`` divided by a million. ``rows`` is read twice: pass a staged table
    if it is expensive.
    """
    block = blocks(order, BLOCK_SPAN) if block is None else block
    split = rows.withColumn("_block", block.cast("bigint"))
    before = Window.partitionBy(key, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    within = split.withColumn("_near", F.last(value, ignorenulls=True).over(before))

    tails = split.groupBy(key, "_block").agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias("_tail"))
    if seed is not None:
        # A small batch makes the semi join a broadcast, so the large seed is filtered in place.
        wanted = seed.select(key, F.col(value).alias("_tail")).join(rows.select(key).distinct(), key, "left_semi")
        tails = tails.unionByName(wanted.withColumn("_block", F.lit(None).cast("bigint")))
    earlier = Window.partitionBy(key).orderBy(F.col("_block").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1)
    carried = (
        tails.withColumn("_far", F.last("_tail", ignorenulls=True).over(earlier))
        .filter(F.col("_far").isNotNull() & F.col("_block").isNotNull())
        .select(key, "_block", "_far")
    )
    return (
        within.join(carried, [key, "_block"], "left")
        .withColumn(output, F.coalesce("_near", "_far"))
        .drop("_block", "_near", "_far")
    )


def number_rows(rows: DataFrame, group: str, position: str, output: str) -> DataFrame:
    """Add ``output``: the number of each row, from 0, in the order of an integer ``group`` and ``position`` within it.

    Positions of a group run from 0 without gaps. Group sizes are summed up in blocks of the group number, blocks
    in a window that sees one row per block, so nothing is packed into a limited number of digits and no window
    sees the rows themselves. ``rows`` is read twice: pass a staged table.
    """
    sizes = rows.groupBy(group).agg(F.count("*").alias("_size")).withColumn("_block", blocks(group, BLOCK_SPAN))
    ahead = (Window.unboundedPreceding, -1)
    inside = F.sum("_size").over(Window.partitionBy("_block").orderBy(group).rowsBetween(*ahead))
    totals = sizes.groupBy("_block").agg(F.sum("_size").alias("_total"))
    before = totals.select("_block", F.sum("_total").over(Window.orderBy("_block").rowsBetween(*ahead)).alias("_before"))
    none = F.lit(0).cast("bigint")
    starts = sizes.withColumn("_inside", inside).join(before, "_block").select(
        group, (F.coalesce("_inside", none) + F.coalesce("_before", none)).alias("_start"))
    return rows.join(starts, group).withColumn(output, F.col("_start") + F.col(position)).drop("_start")


def compute_once(rows: DataFrame, **columns: Column) -> DataFrame:
    """Add columns whose expressions are evaluated exactly once per row.

    A filter on an ordinary computed column is moved below the computation and
    repeats it there. These columns come out of a generator, which filters do
    not pass. Meant for expressions that read whole documents.
    """
    packed = F.struct(*[column.alias(name) for name, column in columns.items()])
    return rows.select("*", F.inline(F.array(packed)))


def first_by(rows: DataFrame, key: Column | str, order: str) -> DataFrame:
    """The row of each key with the smallest ``order`` (keys compare by value, nulls as one key).

    An aggregate with map-side combine: each task sends one row per key.
    """
    return _pick(rows, key, F.min_by, F.col(order))


def latest_by(rows: DataFrame, key: Column | str, *order: str) -> DataFrame:
    """The row of each key with the greatest ``order`` columns."""
    return _pick(rows, key, F.max_by, F.struct(*order))


def _pick(rows: DataFrame, key: Column | str, choose, order: Column) -> DataFrame:
    whole = F.struct(*[F.col(c) for c in rows.columns])
    keyed = F.col(key) if isinstance(key, str) else key
    return rows.groupBy(keyed.alias("_key")).agg(choose(whole, order).alias("_row")).select("_row.*")
