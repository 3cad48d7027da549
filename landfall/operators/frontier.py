"""Calendar windows, sources and the units of work they span."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landfall.functions import periods

# The sources, in their usual order, with the site's own ids.
SOURCES = (
    ("workplace_relations_commission", 15376, "Workplace Relations Commission"),
    ("labour_court", 3, "Labour Court"),
    ("equality_tribunal", 1, "Equality Tribunal"),
    ("employment_appeals_tribunal", 2, "Employment Appeals Tribunal"),
)
RESULTS_PER_PAGE = 10
# Pages that one generated array holds at most.
PAGE_RUN = 1000


def tile_windows(spans: DataFrame, start: Column, end: Column, size: Column | str) -> DataFrame:
    """One row per calendar window of each span's half-open range ``[start, end)``.

    Adds ``label``, ``window_start`` and ``window_end`` (both ends inclusive,
    clamped to the span). Windows come from a generator on each row; nothing is
    joined. An empty or inverted range fails the query.
    """
    message = F.concat(F.lit("end "), end.cast("string"), F.lit(" must be after start "), start.cast("string"))
    starts = F.when(end > start, periods.window_starts(start, end, size)).otherwise(F.raise_error(message))
    tiled = spans.select("*", start.alias("_from"), end.alias("_until"), F.explode(starts).alias("_aligned"))
    aligned = F.col("_aligned")
    return tiled.withColumns({
        "label": periods.label(aligned, size),
        "window_start": F.greatest(aligned, F.col("_from")),
        "window_end": F.least(periods.window_end(aligned, size), F.date_sub(F.col("_until"), 1)),
    }).drop("_from", "_until", "_aligned")


def check_range(start: date, end: date) -> None:
    if end <= start:
        raise ValueError(f"end ({end}) must be after start ({start})")


def partition_calendar(spark: SparkSession, start: date, end: date, size: str = "monthly") -> DataFrame:
    """The windows of one range, in order: ``label, window_start, window_end``."""
    check_range(start, end)
    periods.check_size(size)
    return tile_windows(spark.range(1).select(), F.lit(start), F.lit(end), size)


def assign_partition(rows: DataFrame, day: Column, size: Column | str) -> DataFrame:
    """Add ``partition_date``, the label of the window that ``day`` falls in."""
    return rows.withColumn("partition_date", periods.label(periods.align(day, size), size))


def source_dimension(spark: SparkSession) -> DataFrame:
    """The built-in sources: ``pos, key, site_id, display_name``."""
    rows = [(i, *source) for i, source in enumerate(SOURCES)]
    return spark.createDataFrame(rows, "pos INT, key STRING, site_id INT, display_name STRING")


def resolve_sources(spark: SparkSession, keys: Sequence[str] = ()) -> DataFrame:
    """Built-in sources for ``keys`` in the requested order, all of them if empty."""
    known = {source[0] for source in SOURCES}
    for key in keys:
        if key not in known:
            raise ValueError(f"Unknown source {key!r}. Valid keys: {sorted(known)}")
    dimension = source_dimension(spark)
    if not keys:
        return dimension
    wanted = spark.createDataFrame(list(enumerate(keys)), "pos INT, key STRING")
    return lookup_sources(wanted, dimension.drop("pos")).orderBy("pos")


def lookup_sources(requests: DataFrame, dimension: DataFrame) -> DataFrame:
    """Attach ``site_id`` and ``display_name`` to ``key``; an unknown key fails the query.

    The planner broadcasts the dimension when its measured size allows.
    """
    unknown = F.raise_error(F.concat(F.lit("Unknown source "), F.coalesce(F.col("key"), F.lit("null"))))
    found = requests.join(dimension.withColumn("_known", F.lit(True)), "key", "left")
    return found.withColumn("site_id", F.when(F.col("_known"), F.col("site_id")).otherwise(unknown)).drop("_known")


def work_frontier(sources: DataFrame, start: Column, end: Column, size: Column | str = "monthly") -> DataFrame:
    """Every (source, window) pair. Each source row generates its own windows, so
    the product needs no join and stays partitioned like ``sources``."""
    return tile_windows(sources, start, end, size)


def expected_pages(found: DataFrame, total: Column) -> DataFrame:
    """Listing pages 2..n still to be captured for each row; none for up to one page."""
    # Two generators: runs of pages, then the pages of a run, so that a large announced total makes no long array.
    last = F.ceil(total / F.lit(RESULTS_PER_PAGE)).cast("bigint")
    runs = F.when(last >= 2, F.sequence(F.lit(2).cast("bigint"), last, F.lit(PAGE_RUN).cast("bigint")))
    begun = found.select("*", last.alias("_last"), F.explode(runs).alias("_first"))
    pages = F.sequence("_first", F.least("_last", F.col("_first") + (PAGE_RUN - 1)))
    return begun.select("*", F.explode(pages).alias("page")).drop("_first", "_last")


def listing_gaps(expected: DataFrame, captured: DataFrame) -> DataFrame:
    """Expected pages that were never captured."""
    keys = ["body_key", "partition_date", "page"]
    return expected.join(captured.select(*keys).distinct(), keys, "left_anti")


def capped_batch(batch: DataFrame, limit: int | None, order: str = "fetch_seq", url: str = "document_url") -> DataFrame:
    """The first ``limit`` rows by ``order`` (null last), ties by ``url``; 0 or none means all.

    Only these two columns go through the top-n; its last row is the bound that the rows themselves are compared
    with where they are. Of rows equal in both, which one is taken does not matter, and only as many as fit are.
    """
    if not limit:
        return batch
    names = [name for name in (order, url) if name in batch.columns]
    key = F.struct(*[part for name in names for part in (F.col(name).isNull(), F.col(name))])
    top = batch.select(key.alias("_key")).orderBy("_key").limit(limit)
    bound = top.agg(F.max("_key").alias("bound")).select("bound").scalar()
    equal = top.groupBy("_key").agg(F.count("*").alias("n")).orderBy(F.desc("_key")).limit(1).agg(F.max("n")).scalar()
    below = batch.filter(key < bound)
    return below.unionByName(batch.filter(key == bound).limit(limit).withColumn("_n", F.row_number().over(
        Window.orderBy(F.lit(1)))).filter(F.col("_n") <= equal).drop("_n"))
