"""Operators on small frames, and the shape of their plans."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from landfall.operators import curate, frontier, landing, listing, reconcile
from landfall.operators.sequence import compute_once, previous_value
from landfall.sources import schemas
from landfall.sources.captures import fetches_from_files, save_fetches
from landfall.sources.object_files import export_objects
from landfall.sources.staging import scratch_root, stage


def windows(spark, start, end, size):
    rows = frontier.partition_calendar(spark, dt.date.fromisoformat(start), dt.date.fromisoformat(end), size).collect()
    return [(r.label, str(r.window_start), str(r.window_end)) for r in rows]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def listed(spark, html):
    page = spark.createDataFrame([(1, "b", 1, "B", "2024-01", 1, "http://h/x", 200, None, html)], schemas.LISTING_PAGES)
    return listing.listing_rows(page)


def test_rows_without_end_tags_keep_their_own_link(spark):
    html = '<ul><li class="each-item"><h2 class="title">none</h2><li class="each-item"><h2 class="title"><a href="/q.html">Q</a></h2></ul>'
    rows = listed(spark, html)
    assert [(r.row_pos, r.link) for r in rows.orderBy("row_pos").collect()] == [(0, None), (1, "/q.html")]
    assert listing.row_failures(rows).count() == 1


def test_many_open_rows_of_one_page(spark):
    rows = "".join(f'<li class="each-item"><h2 class="title"><a href="/q{i}">T{i}</a></h2><p>more' for i in range(2000))
    links = {r.row_pos: r.link for r in listed(spark, f"<base href='http://o/'><ul>{rows}</ul>").collect()}
    assert links == {i: f"/q{i}" for i in range(2000)}


def test_listings_without_pages(spark):
    assert listing.listing_rows(spark.createDataFrame([], schemas.LISTING_PAGES)).count() == 0


def test_calendar(spark):
    year = windows(spark, "2024-01-01", "2025-01-01", "monthly")
    assert len(year) == 12 and year[1] == ("2024-02", "2024-02-01", "2024-02-29")
    assert year[0] == ("2024-01", "2024-01-01", "2024-01-31") and year[-1] == ("2024-12", "2024-12-01", "2024-12-31")
    clamped = windows(spark, "2024-01-15", "2024-03-10", "monthly")
    assert clamped[0][1:] == ("2024-01-15", "2024-01-31") and clamped[-1][2] == "2024-03-09"
    assert [w[0] for w in windows(spark, "2024-01-01", "2024-01-22", "weekly")] == ["2024-W01", "2024-W02", "2024-W03"]
    assert [w[0] for w in windows(spark, "2022-01-01", "2024-01-01", "yearly")] == ["2022", "2023"]
    assert windows(spark, "2020-12-31", "2021-01-05", "weekly") == [
        ("2020-W53", "2020-12-31", "2021-01-03"), ("2021-W01", "2021-01-04", "2021-01-04")]
    with pytest.raises(ValueError):
        windows(spark, "2024-02-01", "2024-01-01", "monthly")
    with pytest.raises(ValueError):
        windows(spark, "2024-01-01", "2024-02-01", "fortnightly")


@pytest.mark.parametrize("size", ["monthly", "weekly", "yearly"])
def test_windows_tile_the_range(spark, size):
    for start, end in (("2019-03-31", "2022-03-01"), ("2020-02-29", "2020-03-01"), ("2023-12-31", "2025-01-02")):
        rows = windows(spark, start, end, size)
        days = [dt.date.fromisoformat(d) for _, a, b in rows for d in (a, b)]
        assert days[0] == dt.date.fromisoformat(start)
        assert days[-1] == dt.date.fromisoformat(end) - dt.timedelta(1)
        assert all(b - a == dt.timedelta(1) for a, b in zip(days[1:-1:2], days[2::2]))
        assert len({r[0] for r in rows}) == len(rows)


def test_bad_spans_fail_in_the_query(spark):
    spans = spark.createDataFrame([("2024-01-01", "2024-01-01", "monthly")], "s string, e string, size string")
    day = lambda name: F.col(name).cast("date")
    with pytest.raises(PySparkException, match="must be after"):
        frontier.tile_windows(spans, day("s"), day("e"), F.col("size")).collect()
    with pytest.raises(PySparkException, match="Unsupported"):
        frontier.tile_windows(spans.withColumn("size", F.lit("daily")), day("s"), F.date_add(day("e"), 9),
                              F.col("size")).collect()


def test_sources_and_frontier(spark):
    keys = ["equality_tribunal", "labour_court", "workplace_relations_commission"]
    assert [(r.key, r.site_id) for r in frontier.resolve_sources(spark, keys).collect()] == list(zip(keys, (1, 3, 15376)))
    assert [r.site_id for r in frontier.resolve_sources(spark).orderBy("pos").collect()] == [15376, 3, 1, 2]
    with pytest.raises(ValueError):
        frontier.resolve_sources(spark, ["nowhere"])
    requests = spark.createDataFrame([(0, "labour_court"), (1, "nowhere")], "pos int, key string")
    with pytest.raises(PySparkException, match="Unknown source nowhere"):
        frontier.lookup_sources(requests, frontier.source_dimension(spark).drop("pos")).collect()
    units = frontier.work_frontier(frontier.resolve_sources(spark), F.lit("2024-01-01").cast("date"),
                                   F.lit("2024-04-01").cast("date"))
    assert units.count() == 12
    assert "CartesianProduct" not in plan(units) and "NestedLoop" not in plan(units)


def test_expected_pages_and_gaps(spark):
    found = spark.createDataFrame([("a", "m", t) for t in (0, 1, 10, 11, 25)], "body_key string, partition_date string, n int")
    pages = frontier.expected_pages(found, F.col("n"))
    assert sorted((r.n, r.page) for r in pages.collect()) == [(11, 2), (25, 2), (25, 3)]
    captured = spark.createDataFrame([("a", "m", 2)], "body_key string, partition_date string, page int")
    assert [(r.n, r.page) for r in frontier.listing_gaps(pages, captured).collect()] == [(25, 3)]


def test_capped_batch(spark):
    batch = spark.range(100).select(((F.col("id") * 37) % 100).alias("fetch_seq"))
    assert sorted(r[0] for r in frontier.capped_batch(batch, 3).collect()) == [0, 1, 2]
    assert frontier.capped_batch(batch, 0).count() == frontier.capped_batch(batch, None).count() == 100
    assert frontier.capped_batch(batch, 1000).count() == 100


def test_reconcile_clamps_per_unit(spark):
    found = spark.createDataFrame([("a", "m", 5), ("b", "m", 1)], "body_key string, partition_date string, found bigint")
    outcomes = spark.createDataFrame(
        [("a", "m", o) for o in ("new", "changed", "failed")] + [("b", "m", "unchanged"), ("b", "m", "skipped")],
        "body_key string, partition_date string, outcome string")
    failures = spark.createDataFrame([("a", "m", "u", "boom", None), ("c", "m", "u", "HTTP 500", 500)],
                                     "body_key string, partition_date string, url string, reason string, status int")
    rows = reconcile.reconcile(found, outcomes, failures)
    assert [(r.unit, r.found, r.scraped, r.failed, r.missing) for r in rows.collect()] == [
        ("a/m", 5, 2, 1, 2), ("b/m", 1, 2, 0, 0), ("c/m", 0, 0, 1, 0)]
    assert tuple(reconcile.totals(rows).first()) == (6, 4, 1, 1, 1, 1, 2, 2)
    assert tuple(reconcile.totals(rows.filter("false")).first()) == (0,) * 8
    assert '"unit":"a/m","found":5' in reconcile.summary_json(rows).first().value


def test_url_once_keeps_the_first_request(spark):
    rows = spark.createDataFrame([(3, "http://h/a#x"), (1, "http://h/b"), (2, "http://h/a"), (4, "http://H/b?")],
                                 "fetch_seq bigint, document_url string")
    assert sorted(map(tuple, landing.url_once(rows).collect())) == [(1, "http://h/b"), (2, "http://h/a")]


def test_previous_value_windows_never_span_a_key(spark):
    rows = spark.range(1000).select(F.lit("hot").alias("k"), F.col("id").alias("n"), F.col("id").cast("string").alias("v"))
    out = previous_value(rows, "k", "n", "v", "before", block=F.floor(F.col("n") / 10))
    assert all(r.before == (None if r.n == 0 else str(r.n - 1)) for r in out.collect())
    for line in plan(out).split("\n"):
        assert "Window" not in line or "_block" in line


def test_compute_once_is_not_repeated_by_a_filter(spark):
    rows = compute_once(spark.createDataFrame([("a",), ("b",)], "v string"), h=F.sha2("v", 256)).filter("h like 'c%'")
    assert plan(rows).count("sha2(") == 1 and [r.v for r in rows.collect()] == ["a"]


def test_range_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "records")
    spark.createDataFrame([("A", dt.date(2024, 1, 10)), ("B", dt.date(2024, 1, 20)), ("C", dt.date(2024, 1, 31)),
                           ("D", None)], "identifier string, published_date date").write.parquet(path)
    sliced = curate.range_slice(spark.read.parquet(path), F.lit(dt.date(2024, 1, 10)), F.lit(dt.date(2024, 1, 31)))
    assert sorted(r.identifier for r in sliced.collect()) == ["A", "B"]
    pushed = sliced.select("published_date")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        text = plan(pushed)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(published_date,2024-01-10), LessThan(published_date,2024-01-31)" in text


def test_bucketed_bytes_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr("landfall.sources.staging.BROADCAST_BYTES", -1)
    fetches = spark.createDataFrame([(i, f"http://h/{i}", 200, None, bytearray(b"x%d" % i)) for i in range(20)],
                                    schemas.FETCHES)
    save_fetches(fetches, "bucketed_fetches", 4)
    objects = spark.range(5).select(F.col("id").alias("payload_seq"), F.col("id").alias("fetch_seq"),
                                    F.concat(F.lit("s/m/"), "id").alias("storage_path"), F.lit("html").alias("document_type"),
                                    F.lit("m").alias("partition_date"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = landing.attach_bytes(objects, spark.table("bucketed_fetches"))
        text = plan(joined)
        assert text.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in text and "Sort " not in text
        assert sorted(bytes(r.data) for r in joined.collect()) == [b"x%d" % i for i in range(5)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bucketed_fetches")


def test_fetches_from_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.pdf").write_bytes(b"%PDF \x00\xff")
    manifest = spark.createDataFrame([("sub/a.pdf", 1, "http://h/a.pdf", 200, None), ("b.pdf", 2, "http://h/b.pdf", 404, None)],
                                     "file_name string, fetch_seq bigint, url string, status int, error string")
    rows = fetches_from_files(spark, str(tmp_path), manifest).orderBy("fetch_seq").collect()
    assert [(r.status, None if r.data is None else bytes(r.data)) for r in rows] == [(200, b"%PDF \x00\xff"), (404, None)]


def test_staging_uses_the_shared_folder(spark):
    root = scratch_root(spark)
    assert root == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    staged = stage(spark.range(3).toDF("n"), "numbers")
    assert sorted(r.n for r in staged.collect()) == [0, 1, 2]
    assert all(root in f for f in staged.inputFiles())


def test_objects_as_files(spark, tmp_path):
    objects = spark.createDataFrame([("s/2024-01/A.html", bytearray(b"one")), ("s/2024-01/B.pdf", bytearray(b"\x00\xff"))],
                                    "storage_path string, data binary")
    root = f"file://{tmp_path}/objects"
    assert [r.written for r in export_objects(objects, root).collect()] == [True, True]
    assert (tmp_path / "objects/s/2024-01/B.pdf").read_bytes() == b"\x00\xff"
    changed = objects.withColumn("data", F.lit(bytearray(b"two")))
    assert [r.written for r in export_objects(changed, root).collect()] == [False, False]
    assert (tmp_path / "objects/s/2024-01/A.html").read_bytes() == b"one"
    assert [r.written for r in export_objects(changed, root, overwrite=True).collect()] == [True, True]
    assert sorted(p.name for p in (tmp_path / "objects/s/2024-01").iterdir()) == ["A.html", "B.pdf"]
    assert (tmp_path / "objects/s/2024-01/A.html").read_bytes() == b"two"


def test_an_object_that_cannot_be_written_is_a_row(spark, tmp_path):
    (tmp_path / "taken").write_bytes(b"a file where a folder is needed")
    objects = spark.createDataFrame([("taken/A.html", bytearray(b"1")), ("fine/B.html", bytearray(b"2")), ("fine/C.html", None)],
                                    "storage_path string, data binary")
    got = {r.storage_path: r for r in export_objects(objects, f"file://{tmp_path}").collect()}
    assert {k: r.written for k, r in got.items()} == {"taken/A.html": False, "fine/B.html": True, "fine/C.html": False}
    assert got["fine/B.html"].reason is None and got["taken/A.html"].reason.startswith("persist: ")
    assert got["fine/C.html"].reason == "persist: no data"


def test_capped_batch_with_nulls_and_ties(spark):
    rows = [(None, "a"), (None, "b"), (5, "c"), (5, "b"), (5, "b"), (5, "b"), (1, "z")]
    batch = spark.createDataFrame(rows, "fetch_seq bigint, document_url string")
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    for limit in range(1, 9):
        got = sorted((tuple(r) for r in frontier.capped_batch(batch, limit).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        assert got == ordered[:limit]


def test_large_totals_make_no_long_array(spark):
    found = spark.createDataFrame([("a", 25), ("b", 10), ("c", None), ("d", 31000)], "k string, total bigint")
    got = frontier.expected_pages(found, F.col("total")).groupBy("k").agg(F.count("*"), F.min("page"), F.max("page")).collect()
    assert sorted(map(tuple, got)) == [("a", 2, 2, 3), ("d", 3099, 2, 3100)]


def test_rows_are_numbered_without_gaps(spark):
    from landfall.operators.sequence import number_rows
    rows = [(g, p) for g in (3, 0, 2_500_000, 1_000_001, 7) for p in range(g % 5 + 1)]
    got = number_rows(spark.createDataFrame(rows, "g bigint, p int"), "g", "p", "n").orderBy("g", "p").collect()
    assert [(r.g, r.p) for r in got] == sorted(rows) and [r.n for r in got] == list(range(len(rows)))
