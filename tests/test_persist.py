"""Objects that cannot be written as files: failures with a reason, nothing else is lost, the next run tries again."""

import os

from pyspark.sql import functions as F

from landfall.sources.zones import LandingZone
from landfall.streaming.merge import land_documents

SCHEMA = "fetch_seq bigint, identifier string, body_key string, body string, status int, error string"


def batch(spark, rows):
    raw = spark.createDataFrame([(*r, 200, None) for r in rows], SCHEMA)
    return raw.select(
        "fetch_seq", "identifier", F.col("identifier").alias("title"), F.lit("").alias("description"), F.lit("2024-01-05").cast("date").alias("published_date"),
        "body_key", F.lit("B").alias("body_name"), F.lit(1).alias("body_id"), F.lit("2024-01").alias("partition_date"), F.lit("http://h/x").alias("source_url"),
        F.concat(F.lit("http://h/"), "identifier").alias("document_url"), F.lit("html").alias("document_type"), "status", "error",
        F.col("body").cast("binary").alias("data"))


def test_unwritable_objects_are_failures(spark, tmp_path):
    files = tmp_path / "files"
    files.mkdir()
    (files / "shut").write_text("in the way")
    zone = LandingZone(spark, str(tmp_path / "zone"), files=f"file://{files}")
    rows = [(1, "A", "open", "a1"), (2, "B", "shut", "b1"), (3, "B", "shut", "b1"), (4, "B", "shut", "b2"), (5, "C", "shut", "c1"), (6, "C", "open", "c1"),
            (7, "A", "open", "a2"), (8, "A", "shut", "a3"), (9, "A", "open", "a2"), (10, "D", "open", "")]
    land_documents(batch(spark, rows), zone, run_id="r1", run_seq=1)
    outcomes = {r.fetch_seq: r.outcome for r in zone.read_run("outcomes", 1).collect()}
    assert outcomes == {1: "new", 2: "failed", 3: "failed", 4: "failed", 5: "failed", 6: "new", 7: "changed", 8: "failed", 9: "unchanged", 10: "failed"}
    reasons = sorted(r.reason[:9] for r in zone.read_run("failures", 1).collect())
    assert reasons == ["empty doc"] + ["persist: "] * 5
    stored = {r.storage_path for r in zone.read("objects").collect()}
    assert {r.storage_path for r in zone.read("records").collect()} == stored
    assert stored == {os.path.relpath(os.path.join(folder, name), files) for folder, _, names in os.walk(files) for name in names if name.endswith(".html")}

    os.rename(files / "shut", files / "moved")  # what was in the way is gone
    land_documents(batch(spark, rows), zone, run_id="r2", run_seq=2)
    again = {r.fetch_seq: r.outcome for r in zone.read_run("outcomes", 2).collect()}
    assert "failed" not in {outcomes for seq, outcomes in again.items() if seq != 10} and again[2] == "new" and again[3] == "unchanged"
    # A record of either run points to an object that is there, as a row and as a file.
    paths = {r.storage_path for r in zone.read("records").collect()}
    assert paths == {r.storage_path for r in zone.read("objects").collect()} and all((files / p).is_file() for p in paths)


def test_zone_without_files_reads_no_path(spark, tmp_path):
    zone = LandingZone(spark, str(tmp_path / "zone"))
    land_documents(batch(spark, [(1, "A", "shut", "a")]), zone, run_id="r1", run_seq=1)
    assert zone.read("records").count() == 1 and zone.read("failures").isEmpty()
