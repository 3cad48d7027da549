"""Files of the objects table, and how often a run asks for the bytes of its documents."""

import glob

from pyspark.sql import functions as F

from landfall.plans import ingest
from landfall.sources.zones import LandingZone
from landfall.streaming.merge import land_documents


def test_files_follow_labels_not_tasks(spark, tmp_path):
    zone = LandingZone(spark, str(tmp_path / "zone"))
    rows = spark.range(0, 240, 1, 8).select(
        F.concat(F.lit("p/"), F.col("id")).alias("storage_path"), F.col("id").cast("string").cast("binary").alias("data"), F.lit("text/html").alias("content_type"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("2024-0"), F.col("id") % 3)).alias("partition_date"))
    zone.write_run("objects", rows, 1)
    files = glob.glob(f"{tmp_path}/zone/objects/run_seq=1/*/*.parquet")
    assert len(files) == len({name.rsplit("/", 1)[0] for name in files}) == 3  # before: 24
    columns = ["storage_path", "data", "content_type", "partition_date"]
    assert sorted(map(repr, zone.read_run("objects", 1).select(columns).collect())) == sorted(map(repr, rows.collect()))


def test_files_that_were_tried_are_not_read_again(spark, tmp_path, monkeypatch):
    files = tmp_path / "files"
    files.mkdir()
    (files / "shut").write_text("in the way")
    zone = LandingZone(spark, str(tmp_path / "zone"), files=f"file://{files}")
    raw = spark.createDataFrame([(1, "A", "open"), (2, "B", "shut"), (3, "C", "open")], "fetch_seq bigint, identifier string, body_key string")
    batch = raw.select(
        "*", F.col("identifier").alias("title"), F.lit("").alias("description"), F.lit("2024-01-05").cast("date").alias("published_date"),
        F.lit("B").alias("body_name"), F.lit(1).alias("body_id"), F.lit("2024-01").alias("partition_date"), F.lit("http://h/x").alias("source_url"),
        F.concat(F.lit("http://h/"), "identifier").alias("document_url"), F.lit("html").alias("document_type"), F.lit(200).alias("status"),
        F.lit(None).cast("string").alias("error"), F.col("identifier").cast("binary").alias("data"))
    asked, export = [], ingest.export_objects

    def counted(objects, root):
        asked.append(objects.count())
        return export(objects, root)

    monkeypatch.setattr(ingest, "export_objects", counted)
    land_documents(batch, zone, run_id="r1", run_seq=1)
    assert asked == [3, 0]  # before: 3 and 2
    assert {r.fetch_seq: r.outcome for r in zone.read_run("outcomes", 1).collect()} == {1: "new", 2: "failed", 3: "new"}
