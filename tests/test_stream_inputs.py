"""The input of the stream queries: written by many tasks, one batch of the stream for what arrives together."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from workload import spark_queries


@pytest.fixture
def scattered(spark):
    """Small rows stay in as many partitions as the session has for shuffles."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_crawls_arrive_in_many_files(scattered, tmp_path, monkeypatch):
    spark, seen = scattered, []
    item = '<nav><ul><li><a href="/then">t</a></li><li><a href="/a,b">u</a></li></ul></nav>'
    pages = spark.range(64).select(
        F.col("id").alias("page_id"), F.concat(F.lit("https://h.example/en/"), "id", F.when(F.col("id") % 2 == 0, "?x=1").otherwise("")).alias("url"),
        F.lit(f"<html><body>{item}</body></html>").alias("html"))
    pages.write.parquet(f"{tmp_path}/pages.parquet")

    def stream(listings, fetches, reread, zone, checkpoint):
        folder = checkpoint.rsplit("/", 1)[0]
        seen.append([(rows.count(), len(rows.inputFiles())) for rows in (spark.read.parquet(f"{folder}/{kind}") for kind in ("pages", "documents"))])
        return SimpleNamespace(awaitTermination=lambda: None)

    monkeypatch.setattr(spark_queries, "crawl_stream", stream)
    monkeypatch.setattr(spark_queries, "report", lambda zone, run: None)
    spark_queries.stream_crawls(spark, str(tmp_path))
    assert [rows for (rows, _), _ in seen] == [64, 96, 96, 96]
    assert seen[0][0][1] == 4 and seen[1][0][1] == 8  # files of the pages
    documents = [rows for _, (rows, _) in seen]
    assert documents == sorted(documents) and documents[-1] > documents[0]


def test_events_arrive_in_many_files(scattered, tmp_path, monkeypatch):
    spark, batches = scattered, []
    events = spark.range(400).selectExpr(
        "id + 7 AS event_id", "timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS ts", "id % 9 AS user_id",
        "if(id % 5 = 0, 'view', 'error') AS event_type", "1.5D AS value", "'{}' AS props")
    events.write.parquet(f"{tmp_path}/events.parquet")

    def stream(documents, reread, zone, checkpoint):
        def note(batch, number):
            at = batch.select("fetch_seq", "_metadata.file_path").collect()
            batches.append((len(at), min(r.fetch_seq for r in at), max(r.fetch_seq for r in at), len({r.file_path for r in at})))
        return documents.select("*", "_metadata").writeStream.foreachBatch(note).option("checkpointLocation", checkpoint).trigger(
            availableNow=True).start()

    monkeypatch.setattr(spark_queries, "keyed_stream", stream)
    spark_queries.stream_keyed(spark, str(tmp_path))
    assert batches == [(100, 7, 106, 4), (100, 107, 206, 4), (100, 207, 306, 4), (100, 307, 406, 4)]
