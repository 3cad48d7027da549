"""The stream with keyed state against runs that look up the zone."""

import pytest
from pyspark.sql import functions as F

from landfall.functions import content
from landfall.sources.zones import LandingZone
from landfall.streaming.keyed import keyed_stream
from landfall.streaming.merge import land_documents

RAW = "fetch_seq bigint, identifier string, kind string, status int, error string, body string"

BATCHES = [
    [(1, "A", "html", 200, None, "v1"), (2, "A", "html", 200, None, "v2"), (3, "B", "pdf", 404, None, None), (4, "C", "html", None, "late", None),
     (5, "", "html", 200, None, "nameless"), (6, "A", "html", 200, None, "<!-- Elapsed time: 1 -->")],
    [(7, "A", "html", 200, None, "v1"), (8, "A", "html", 200, None, "v2"), (9, "B", "pdf", 200, None, "b"), (10, "B", "pdf", 200, None, "b")],
    [(11, "A", "html", 200, None, "v2<!-- Elapsed time: 2 -->"), (12, "C", "html", 500, None, "x")],
    [(13, "C", "html", 200, None, "c"), (14, "", "html", 200, None, "other"), (15, "A", "html", 200, None, "v1"), (16, "D", "html", 200, None, "d " * 40_000)],
]


def documents(raw):
    """Landing metadata around the raw rows; works on tables and streams."""
    named = F.concat(F.lit("https://site.example/"), "identifier", F.lit("."), "kind")
    return raw.select(
        "fetch_seq", "identifier", F.col("identifier").alias("title"), F.lit("").alias("description"),
        F.lit("2024-01-05").cast("date").alias("published_date"), F.lit("court").alias("body_key"), F.lit("Court").alias("body_name"),
        F.lit(1).alias("body_id"), F.lit("2024-01").alias("partition_date"), named.alias("source_url"), named.alias("document_url"),
        F.col("kind").alias("document_type"), "status", "error", F.col("body").cast("binary").alias("data"))


def contents(zone):
    outcomes = zone.read("outcomes").select("run_seq", "fetch_seq", "identifier", "outcome")
    records = zone.read("records").select("run_seq", "fetch_seq", "identifier", "storage_path", "file_hash", "content_length")
    objects = zone.read("objects").select("run_seq", "storage_path", content.sha256_hex(F.col("data")).alias("hash"))
    return [sorted((tuple(r) for r in t.collect()), key=repr) for t in (outcomes, records, objects)]


@pytest.mark.parametrize("recheck", [True, False])
def test_batches_equal_runs(spark, tmp_path, monkeypatch, recheck):
    source, reference = str(tmp_path / "source"), LandingZone(spark, str(tmp_path / "reference"))
    zone, checkpoint = LandingZone(spark, str(tmp_path / "zone")), str(tmp_path / "checkpoint")
    read = LandingZone.read

    def without_history(self, table, before=None):
        assert self.root != zone.root, f"the stream reads {table}"
        return read(self, table, before)

    def run():
        stream = spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).parquet(source)
        with monkeypatch.context() as patch:
            patch.setattr(LandingZone, "read", without_history)
            keyed_stream(documents(stream), lambda files: documents(spark.read.schema(RAW).parquet(*files)), zone, checkpoint,
                         recheck=recheck).awaitTermination()

    for number, batch in enumerate(BATCHES):
        frame = spark.createDataFrame(batch, RAW)
        frame.coalesce(1).write.mode("append").parquet(source)
        land_documents(documents(frame), reference, run_id=f"r{number}", run_seq=number, recheck=recheck)
        if number in (1, 3):  # the query is restarted in between
            run()
    assert contents(zone) == contents(reference)
    run()  # nothing new: no batch
    assert {r.run_seq for r in read(zone, "outcomes").select("run_seq").distinct().collect()} == {0, 1, 2, 3}


def test_zone_with_other_runs_is_refused(spark, tmp_path):
    zone = LandingZone(spark, str(tmp_path / "zone"))
    land_documents(documents(spark.createDataFrame(BATCHES[0], RAW)), zone, run_id="other", run_seq=0)
    (tmp_path / "source").mkdir()
    stream = spark.readStream.schema(RAW).parquet(str(tmp_path / "source"))
    with pytest.raises(ValueError, match="runs of others"):
        keyed_stream(documents(stream), None, zone, str(tmp_path / "checkpoint"))
