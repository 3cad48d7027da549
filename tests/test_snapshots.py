"""Current state from snapshots and later runs: equal to the whole log's, and read without it."""

import random
import re

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from landfall.operators.landing import current_hashes, current_records
from landfall.sources import schemas, snapshots
from landfall.sources.zones import CuratedZone, LandingZone

COLUMNS = schemas.field_names(schemas.LANDING_LOG)


def records(spark, rows):
    """Landing rows from (identifier, hash, day, fetch_seq)."""
    frame = spark.createDataFrame(rows, "identifier string, file_hash string, published_date string, fetch_seq bigint")
    named = frame.withColumn("published_date", F.col("published_date").cast("date"))
    types = {part.split()[0]: part.split()[1] for part in schemas.LANDING_LOG.split(",")}
    return named.select(*[F.col(c) if c in named.columns else F.lit(None).cast(types[c]).alias(c) for c in COLUMNS if c != "run_seq"])


def order(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.fixture
def zone(spark, tmp_path):
    return LandingZone(spark, str(tmp_path / "zone"))


def some_rows(run, count=40):
    pick = random.Random(run)
    ids = [*[f"D{k}" for k in range(25)], "", None]
    return [(pick.choice(ids), f"h{pick.randrange(3)}", f"2024-0{pick.randrange(1, 7)}-01", k) for k in range(count)]


def same_as_log(spark, zone):
    log = zone.read("records").select(*COLUMNS)
    assert order(zone.current()) == order(current_records(log))
    assert order(zone.hashes()) == order(current_hashes(log))
    asked = spark.createDataFrame([("D1",), ("D2",), ("D2",), ("none",), ("",)], "identifier string")
    assert order(zone.hashes(asked=asked)) == order(current_hashes(log.join(asked, "identifier", "left_semi")))
    assert {r[0] for r in zone.identifiers().collect()} == {r[0] for r in log.select("identifier").collect()}
    start, end = (F.to_date(F.lit(f"2024-0{m}-01")).cast("date") for m in (2, 5))
    between = zone.current_between("2024-02-01", "2024-05-01").where("identifier is not null")
    assert order(between) == order(current_records(log).where("identifier is not null").where((F.col("published_date") >= start) & (F.col("published_date") < end)))


def test_state_equals_that_of_the_whole_log(spark, zone, monkeypatch):
    monkeypatch.setattr(snapshots, "LEAST_BUCKETS", 2)
    monkeypatch.setattr(snapshots, "BUCKET_ROWS", 6)
    zone.compact()  # nothing to compact
    assert zone.current().isEmpty() and zone.snapshots.latest() is None
    for run in (1, 2, 5, 6):
        zone.write_run("records", records(spark, some_rows(run)), run)
        if run in (2, 6):
            same_as_log(spark, zone)
            zone.compact()
        same_as_log(spark, zone)
    assert zone.snapshots.latest().through == 6 and zone.snapshots.latest().buckets >= 4
    assert zone.snapshots.latest(before=6).through == 2  # a repeated run 6 sees the state before it
    assert order(zone.hashes(before=6)) == order(current_hashes(zone.read("records", before=6)))
    for snapshot in zone.snapshots.all():  # as in a session that wrote none
        spark.sql(f"DROP TABLE IF EXISTS {snapshot.table}")
    same_as_log(spark, zone)


def test_a_replaced_run_is_not_kept_by_a_snapshot(spark, zone):
    for run in (1, 2, 3):
        zone.write_run("records", records(spark, some_rows(run)), run)
        zone.compact()
    zone.write_run("records", records(spark, [("D1", "replaced", None, 0)]), 2)
    assert [s.through for s in zone.snapshots.all()] == []
    same_as_log(spark, zone)
    zone.compact()
    zone.write_run("records", records(spark, [("D1", "later", None, 0)]), 4)
    assert zone.snapshots.latest().through == 3
    same_as_log(spark, zone)


def test_what_a_run_reads(spark, zone, monkeypatch):
    """Neither runs before the snapshot nor a shuffle of the snapshot; asked identifiers are chosen below the aggregate."""
    for run in (1, 2, 3):
        zone.write_run("records", records(spark, some_rows(run, 400)), run)
        if run == 2:
            zone.compact()
    asked = spark.createDataFrame([(f"D{k}",) for k in range(5)], "identifier string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = zone.hashes(before=4, asked=asked)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    logs = [line for line in plan.splitlines() if "/zone/records" in line]
    assert logs and all(re.search(r"PartitionFilters: \[.*run_seq#\d+L > 2", line) for line in logs)
    lines = plan.splitlines()
    depth = [re.search(r"[\w*(]", re.sub(r"^[\s:|+-]*", lambda m: " " * len(m[0]), line)).start() for line in lines]

    def above(at):
        path, level = [], depth[at]
        for i in range(at - 1, -1, -1):
            if depth[i] < level:
                path.append(lines[i])
                level = depth[i]
        return path

    scan = next(i for i, line in enumerate(lines) if "SelectedBucketsCount" in line or "Bucketed: true" in line)
    path = above(scan)
    joined = next(k for k, line in enumerate(path) if "Join" in line)
    assert not any("Exchange" in line for line in path[:joined + 1])
    assert not any("Aggregate" in line for line in path[:joined + 1]) and any("Aggregate" in line for line in path)


def test_maintenance_and_curated_state(spark, tmp_path):
    zone = CuratedZone(spark, str(tmp_path / "curated"))
    for run in range(1, 5):
        rows = records(spark, [(f"D{k}", f"h{run}", None, k) for k in range(run, 8)]).drop("fetch_seq").withColumns({
            "original_storage_path": F.lit("o"), "original_file_hash": F.lit("x"), "content_type": F.lit("text/html"),
            "outcome": F.when(F.col("identifier") == "D7", "unchanged").otherwise("copied_asis"), "data": F.lit(b"bytes")})
        zone.write_run("curated", rows, run)
        zone.maintain(every=2)
    assert [s.through for s in zone.snapshots.all()] == [2, 4]
    assert order(zone.hashes()) == sorted((f"D{k}", f"h{min(k, 4)}") for k in range(1, 7))
    assert {r.identifier: r.run_seq for r in zone.current().collect()} == {f"D{k}": min(k, 4) for k in range(1, 7)}


def test_rows_survive_a_failed_publication(spark, zone, monkeypatch):
    zone.write_run("records", records(spark, [("D1", "a", None, 0)]), 1)
    with pytest.raises((OSError, Py4JJavaError)):
        zone._publish(f"{zone.root}/records/_missing", f"{zone.root}/records/run_seq=1")
    assert order(zone.hashes()) == [("D1", "a")]
