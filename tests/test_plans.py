"""Runs over small captured sites: landing, curation, streaming."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from landfall.functions import stubs
from landfall.operators import landing, listing, reconcile
from landfall.plans.curation import curate_range
from landfall.plans.ingest import ingest
from landfall.plans.chain import ingest_and_curate
from landfall.sources import schemas
from landfall.sources.zones import CuratedZone, LandingZone
from landfall.streaming.merge import land_documents, merge_stream

SITE = "https://x.example"
SEARCH = f"{SITE}/en/search/?from=01/01/2024&page=1"

ROWS = """
<li class="wide each-item"><section><h2 class="title" id="t1">
<a rel="next" href="/docs/spring/kl-77.html">KL-77</a></h2>
<span class="date">31/01/2024</span></section>
<p class="description" title="Miller &amp; Sons, timber">short</p><span class="refNO">KL-77</span></li>
<li class="each-item"><h2 class="title"><a href="/docs/spring/q-p-00042.html"><i>?</i></a></h2>
<span class="date">15/01/2024</span><p class="description">Two neighbours and a hedge</p><span class="refNO"> Q - 42 </span></li>
<li class="each-item"><h2 class="title">nothing to follow here</h2></li>"""
STUB = b"""<html><body><h2>See file</h2><div class="content"></div>
<a class="download" href="/files/old/scan-9.pdf">as a file</a></body></html>"""
REAL = (b'<html><body><div class="content"><h2>Minutes</h2><p>' + b"They met and talked at length. " * 20
        + b'</p></div><a class="download" href="/files/copy.pdf">as a file</a></body></html>')


def pages(spark, *rows):
    return spark.createDataFrame(
        [(i, "labour_court", 3, "Labour Court", label, page, SEARCH, status, error, html)
         for i, (label, page, status, error, html) in enumerate(rows)], schemas.LISTING_PAGES)


def fetches(spark, *rows):
    return spark.createDataFrame(
        [(i, SITE + url, status, error, None if data is None else bytearray(data))
         for i, (url, status, error, data) in enumerate(rows)], schemas.FETCHES)


def listing_html(rows, count=None):
    head = f"<div>Shows 1 to 10 of {count} results</div>" if count else ""
    return f"<html><body>{head}<ul>{rows}</ul></body></html>"


def item(url, day="05/01/2024"):
    return f'<li class="each-item"><h2 class="title"><a href="{url}">{url}</a></h2><span class="date">{day}</span></li>'


def documents(spark, *rows):
    """(identifier, data[, type, extension]) rows as a batch of documents."""
    out = []
    for i, row in enumerate(rows):
        identifier, data, kind, ext = (*row, "html", "html")[:4] if len(row) == 2 else row
        url = f"{SITE}/{identifier}.{ext}"
        out.append((i, identifier, "t", "d", dt.date(2024, 1, 31), "labour_court", "Labour Court", 3, "2024-01", url,
                    url, kind, None, None, bytearray(data)))
    return spark.createDataFrame(out, """fetch_seq BIGINT, identifier STRING, title STRING, description STRING,
        published_date DATE, body_key STRING, body_name STRING, body_id INT, partition_date STRING,
        source_url STRING, document_url STRING, document_type STRING, status INT, error STRING, data BINARY""")


def outcomes(named):
    return [(r.identifier, r.outcome) for r in named.orderBy("fetch_seq").collect()]


def test_listing_rows_and_counts(spark):
    listed = pages(spark, ("2024-01", 1, None, None, listing_html(ROWS, "1,025")), ("2024-02", 1, 200, None, listing_html(ROWS)),
                   ("2024-02", 2, 200, None, listing_html(ROWS, 3)), ("2024-03", 1, 500, None, None),
                   ("2024-04", 1, None, "timed out", None))
    rows = listing.listing_rows(listed)
    assert sorted(map(tuple, listing.found_counts(listed, rows).collect())) == [
        ("labour_court", "2024-01", 1025), ("labour_court", "2024-02", 3)]
    got = [tuple(r) for r in listing.candidates(rows).filter("partition_date = '2024-01'").orderBy("fetch_seq").select(
        "identifier", "title", "description", "published_date", "document_type", "document_url").collect()]
    assert got == [
        ("KL-77", "KL-77", "Miller & Sons, timber", dt.date(2024, 1, 31), "html", f"{SITE}/docs/spring/kl-77.html"),
        ("Q-P-00042", "Q - 42", "Two neighbours and a hedge", dt.date(2024, 1, 15), "html",
         f"{SITE}/docs/spring/q-p-00042.html")]
    assert [r.reason for r in listing.row_failures(rows).collect()] == [listing.NO_LINK] * 3
    assert sorted(map(tuple, listing.listing_failures(listed).collect())) == [
        ("labour_court", "2024-03", SEARCH, "listing: HTTP 500", 500),
        ("labour_court", "2024-04", SEARCH, "listing: timed out", None)]


def test_rows_in_rows_and_several_titles(spark):
    html = listing_html(
        '<li class="each-item"><h2 class="title">one</h2><h2 class="title"><a href="/two.html">Two</a></h2>'
        '<ul><li class="each-item"><h2 class="title"><a href="/inner.html">Inner</a></h2></li><li>x</li></ul></li>'
        '<li class="each-item"><h2 class="title">t</h2><a class="big btn" href="/button.html">go</a></li>'
        '<li class="each-item"><h2 class="title"><a href="/open.html">never closed</a></h2>')
    listed = pages(spark, ("2024-01", 1, None, None, listing_html(item("/z.html"))), ("2024-01", 2, None, None, html))
    rows = listing.listing_rows(listed).orderBy("fetch_seq").collect()
    assert [(r.fetch_seq, r.page_seq, r.row_pos, r.link) for r in rows] == [
        (0, 0, 0, "/z.html"), (1, 1, 0, "/two.html"), (2, 1, 1, "/inner.html"), (3, 1, 2, "/button.html"), (4, 1, 3, "/open.html")]
    assert rows[1].title_text == "Two"


def test_text_of_all_containers_decides_on_stubs(spark):
    blanks = "<div class='content'><p>a</p>" + " " * 150 + "</div>"
    page = f"<html>{blanks}{blanks}<a class='download' href='/f.pdf'>f</a></html>"
    html = spark.createDataFrame([(page,), (page.replace(" " * 150, " "),)], "h string")
    # Two letters, 150 blanks behind each, one between any two texts; the last blanks are trimmed.
    assert [tuple(r) for r in html.select(stubs.content_chars("h"), stubs.download_link(F.col("h"))).collect()] == [
        (154, "/f.pdf"), (5, "/f.pdf")]


def test_stub_detection(spark):
    html = spark.createDataFrame([(STUB.decode(),), (REAL.decode(),), ("<p>none</p>",)], "h string")
    assert [r[0] for r in html.select(stubs.download_link(F.col("h"))).collect()] == [
        "/files/old/scan-9.pdf", None, None]


def test_document_lifecycle(spark, tmp_path):
    zone = LandingZone(spark, str(tmp_path))
    steps = [(b"<html>v1</html>", "new", 1), (b"<html>v1</html>", "unchanged", 1),
             (b"<html>v1<!-- Elapsed time: 3 --></html>", "unchanged", 1),
             (b"<html>v2 CHANGED</html>", "changed", 2), (b"<html>v1</html>", "changed", 3)]
    for run, (data, expected, objects) in enumerate(steps):
        named = land_documents(documents(spark, ("ADJ-1", data)), zone, run_id=f"r{run}", run_seq=run)
        assert outcomes(named) == [("ADJ-1", expected)]
        assert zone.read("objects").count() == objects
    current = zone.current().collect()
    assert len(current) == 1 and "__" in current[0].storage_path and current[0].last_run_id == "r4"
    assert current[0].file_hash == hashlib.sha256(b"<html>v1</html>").hexdigest()
    assert landing.hash_mismatches(zone.current(), zone.read("objects")).count() == 0


def test_order_within_a_batch(spark, tmp_path):
    batch = documents(spark, ("A", b""), ("A", b"1"), ("A", b"1"), ("A", b""), ("A", b"2"), ("A", b"1"), ("B", b"1"),
                      ("", b"x"), ("", b"y"))
    zone = LandingZone(spark, str(tmp_path / "recheck"))
    named = land_documents(batch, zone, run_id="r", run_seq=0, recheck=True)
    assert [o for _, o in outcomes(named)] == [
        "failed", "new", "unchanged", "failed", "changed", "changed", "new", "new", "changed"]
    # A-B-A within one run: the second "1" gets a versioned key of its own.
    assert zone.read("objects").count() == 6
    zone = LandingZone(spark, str(tmp_path / "skip"))
    named = land_documents(batch, zone, run_id="r", run_seq=0, recheck=False)
    assert [o for _, o in outcomes(named)] == [
        "failed", "new", "skipped", "skipped", "skipped", "skipped", "new", "new", "skipped"]
    assert landing.current_hashes(zone.read("records")).count() == 3


def test_blocks_do_not_change_the_outcome(spark, tmp_path):
    import random
    rng = random.Random(5)
    rows = [(rng.choice(["hot", "hot", "hot", "cold", "rare"]), rng.choice([b"", b"1", b"2"])) for _ in range(300)]
    decided = spark.createDataFrame(
        [(i, k, hashlib.sha256(v).hexdigest() if v else None) for i, (k, v) in enumerate(rows)],
        "fetch_seq bigint, identifier string, file_hash string")
    known = spark.createDataFrame([("cold", hashlib.sha256(b"1").hexdigest()), ("other", "x")],
                                  "identifier string, file_hash string")
    for recheck in (True, False):
        expected, last = [], dict(known.collect())
        for key, value in rows:
            digest = hashlib.sha256(value).hexdigest() if value else None
            if not recheck and key in last:
                expected.append("skipped")
            elif digest is None:
                expected.append("failed")
            else:
                expected.append("new" if key not in last else "unchanged" if last[key] == digest else "changed")
                last[key] = digest
        for span in (1, 7, 1000):
            got = landing.classify(decided, known, recheck, F.floor(F.col("fetch_seq") / span))
            assert [r.outcome for r in got.orderBy("fetch_seq").collect()] == expected


def test_extension_drives_the_key(spark, tmp_path):
    zone = LandingZone(spark, str(tmp_path))
    land_documents(documents(spark, ("A", b"x", "html", "html"), ("B", b"x", "pdf", "pdf"), ("C", b"x", "doc", "rtf")),
                   zone, run_id="r", run_seq=0)
    rows = {r.identifier: r for r in zone.current().collect()}
    assert [rows[i].storage_path for i in "ABC"] == [
        "labour_court/2024-01/A.html", "labour_court/2024-01/B.pdf", "labour_court/2024-01/C.rtf"]
    assert {r.storage_path: r.content_type for r in zone.read("objects").collect()}[
        "labour_court/2024-01/C.rtf"] == "application/msword"


def site(spark):
    listed = pages(
        spark,
        ("2024-01", 1, None, None, listing_html(
            item("/a.html") + item("/b.html", "31/01/2024") + item("/gone.html") + item("/empty.html")
            + item("/a.html#again") + item("/stub1.html") + item("/stub2.html") + item("/lost.html")
            + item("/nodate.html", "soon") + "<li class='each-item'>broken</li>", 15)),
        ("2024-01", 2, 500, None, None),
        ("2024-02", 1, None, None, listing_html(item("/c.pdf", "02/02/2024") + item("/x/a.html", "03/02/2024"))))
    captured = fetches(
        spark, ("/a.html", 200, None, b"<html><body><nav>m</nav><div class='content'><p>A</p></div></body></html>"),
        ("/b.html", None, None, b"<html><body><nav>m</nav><p>orphan</p></body></html>"), ("/gone.html", 404, None, None),
        ("/empty.html", 200, None, b"<!-- Elapsed time: 1 -->"), ("/stub1.html", 200, None, STUB),
        ("/stub2.html", 200, None, STUB), ("/files/old/scan-9.pdf", 200, None, b"%PDF-1.7 \x00\xff"),
        ("/lost.html", None, "timed out", None), ("/c.pdf", 200, None, b"%PDF c"),
        ("/x/a.html", 200, None, b"<p>other A</p>"), ("/nodate.html", 200, None, b"<p>n</p>"))
    return listed, captured


def test_full_run_reconciles_and_curates(spark, tmp_path):
    listed, captured = site(spark)
    zone, curated = LandingZone(spark, str(tmp_path / "l")), CuratedZone(spark, str(tmp_path / "c"))
    report, counts = ingest_and_curate(listed, captured, zone, curated, dt.date(2024, 1, 1), dt.date(2024, 3, 1),
                                       run_id="r1", run_seq=1)
    rows = {r.unit: r.asDict() for r in report.collect()}
    january, february = rows["labour_court/2024-01"], rows["labour_court/2024-02"]
    # new: a, b, stub1, nodate; failed: gone, empty, lost, broken row, page 2.
    assert {k: january[k] for k in reconcile.MEASURES} == dict(
        found=15, scraped=4, new=4, changed=0, unchanged=0, skipped=0, failed=5, missing=6)
    # /x/a.html has the identifier of /a.html, which has landed by then.
    assert {k: february[k] for k in reconcile.MEASURES} == dict(
        found=2, scraped=2, new=1, changed=0, unchanged=0, skipped=1, failed=0, missing=0)
    total = reconcile.totals(report).first()
    assert (total.found, total.missing, total.failed) == (17, 6, 5)
    reasons = {(r.url.replace(SITE, ""), r.reason, r.status) for r in zone.read("failures").collect()}
    assert {("/gone.html", "HTTP 404", 404), ("/empty.html", "empty document body", None),
            ("/lost.html", "timed out", None)} < reasons
    stub = zone.current().filter("identifier = 'STUB1'").first()
    assert (stub.document_type, stub.document_url, stub.source_url, stub.storage_path) == (
        "pdf", f"{SITE}/files/old/scan-9.pdf", f"{SITE}/stub1.html", "labour_court/2024-01/STUB1.pdf")

    # The undated document is in no slice.
    assert tuple(counts.first()) == (4, 2, 2, 0, 0)
    files = {r.storage_path: bytes(r.data) for r in curated.objects().collect()}
    assert set(files) == {"A.html", "B.html", "C.pdf", "STUB1.pdf"}
    assert files["STUB1.pdf"] == b"%PDF-1.7 \x00\xff"
    page = files["A.html"].decode()
    assert page.startswith("<!DOCTYPE html>") and "<h1>A</h1>\n<p>A</p>\n</body>" in page and "nav" not in page
    assert "orphan" in files["B.html"].decode() and "<nav>" not in files["B.html"].decode()
    record = curated.current().filter("identifier = 'A'").first()
    original = zone.current().filter("identifier = 'A'").first()
    assert record.file_hash == hashlib.sha256(files["A.html"]).hexdigest()
    assert record.content_length == len(files["A.html"])
    assert (record.original_file_hash, record.original_storage_path) == (original.file_hash, original.storage_path)

    # Retrying the run, then repeating everything as run 2.
    again = ingest(listed, captured, zone, run_id="r1", run_seq=1)
    assert {r.unit: r.asDict() for r in again.collect()} == rows
    assert zone.read("records").count() == 5 and zone.read("objects").count() == 5
    # Every known identifier is skipped; stub 2 is not known and, stub 1 being skipped, now fetches the file.
    second = reconcile.totals(ingest(listed, captured, zone, run_id="r2", run_seq=2)).first()
    assert (second.new, second.changed, second.unchanged, second.skipped) == (1, 0, 0, 6)
    third = reconcile.totals(ingest(listed, captured, zone, run_id="r3", run_seq=3, recheck=True)).first()
    assert (third.new, third.changed, third.unchanged, third.skipped) == (0, 1, 5, 0)
    assert zone.read("objects").count() == 7
    counts = curate_range(zone, curated, dt.date(2024, 1, 1), dt.date(2024, 3, 1), run_seq=3)
    assert tuple(counts.first()) == (5, 1, 1, 3, 0)
    with pytest.raises(ValueError):
        curate_range(zone, curated, dt.date(2024, 3, 1), dt.date(2024, 3, 1), run_seq=4)


def test_curation_cases(spark, tmp_path):
    zone, curated = LandingZone(spark, str(tmp_path / "l")), CuratedZone(spark, str(tmp_path / "c"))
    land_documents(documents(spark, ("UD-1", b"%PDF", "pdf", "pdf"), ("<&>", b"<p>x</p>")), zone, run_id="r", run_seq=0)
    ghost = zone.read("records").withColumns({
        "identifier": F.lit("GHOST"), "storage_path": F.lit("missing/key/x.html"), "run_seq": F.lit(1).cast("bigint")})
    zone.write_run("records", ghost.limit(1), 1)
    window = dt.date(2024, 1, 31), dt.date(2024, 2, 1)
    assert tuple(curate_range(zone, curated, *window, run_seq=1).first()) == (2, 1, 1, 0, 1)
    assert [tuple(r)[:2] for r in curated.read("curation_failures").collect()] == [
        ("GHOST", "missing object: missing/key/x.html")]
    files = {r.storage_path: bytes(r.data) for r in curated.objects().collect()}
    assert files["UD-1.pdf"] == b"%PDF" and b"<h1>&lt;&amp;&gt;</h1>" in files["<&>.html"]
    assert tuple(curate_range(zone, curated, *window, run_seq=2).first()) == (2, 0, 0, 2, 1)
    assert curated.objects().count() == 2
    assert tuple(curate_range(zone, curated, dt.date(2024, 1, 1), dt.date(2024, 1, 31), run_seq=3).first()) == (
        0, 0, 0, 0, 0)


def test_stream_equals_batches_and_reruns_do_nothing(spark, tmp_path):
    batches = [documents(spark, ("A", b"1"), ("B", b"1"), ("A", b"2")), documents(spark, ("A", b"2"), ("C", b"")),
               documents(spark, ("B", b"9"), ("C", b"3"))]
    zone, streamed = LandingZone(spark, str(tmp_path / "b")), LandingZone(spark, str(tmp_path / "s"))
    source = str(tmp_path / "in")
    for i, batch in enumerate(batches):
        land_documents(batch, zone, run_id="stream", run_seq=i)
        batch.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(batch.schema).parquet(source)
        query = merge_stream(stream, streamed, str(tmp_path / "checkpoint"))
        query.awaitTermination()
        assert query.exception() is None
    fields = ["identifier", "file_hash", "storage_path", "run_seq"]
    expected = sorted(map(tuple, zone.current().select(*fields).collect()))
    assert sorted(map(tuple, streamed.current().select(*fields).collect())) == expected and len(expected) == 3
    query = merge_stream(spark.readStream.schema(batches[0].schema).parquet(source), streamed,
                         str(tmp_path / "checkpoint"))
    query.awaitTermination()
    assert not query.recentProgress or query.recentProgress[-1]["numInputRows"] == 0
    assert sorted(map(tuple, streamed.current().select(*fields).collect())) == expected


def test_a_run_never_replaces_another(spark, tmp_path):
    zone = LandingZone(spark, str(tmp_path / "l"))
    land_documents(documents(spark, ("A", b"1"), ("B", b"1")), zone, run_id="first", run_seq=0)
    with pytest.raises(ValueError, match="belongs to first"):
        land_documents(documents(spark, ("C", b"1")), zone, run_id="second", run_seq=0)
    # A stream into a zone that has a batch run takes the numbers after it, and finds them again.
    source = str(tmp_path / "in")
    documents(spark, ("C", b"1")).write.parquet(source)
    for _ in range(2):
        stream = spark.readStream.schema(documents(spark, ("C", b"1")).schema).parquet(source)
        merge_stream(stream, zone, str(tmp_path / "checkpoint")).awaitTermination()
    assert {(r.identifier, r.run_seq) for r in zone.current().collect()} == {("A", 0), ("B", 0), ("C", 1)}
    assert zone.read("objects").count() == 3
    assert zone.claim("later") == 2 and zone.claim("later") == 2 and zone.claim("last") == 3


def test_windows_are_curated_in_any_order(spark, tmp_path):
    zone, curated = LandingZone(spark, str(tmp_path / "l")), CuratedZone(spark, str(tmp_path / "c"))
    batch = documents(spark, ("JAN", b"<p>1</p>"), ("FEB", b"<p>2</p>")).withColumn(
        "published_date", F.when(F.col("identifier") == "FEB", F.lit(dt.date(2024, 2, 3))).otherwise(F.lit(dt.date(2024, 1, 3))))
    land_documents(batch, zone, run_id="r", run_seq=0)
    months = [(dt.date(2024, 2, 1), dt.date(2024, 3, 1)), (dt.date(2024, 1, 1), dt.date(2024, 2, 1))]
    for month in months:
        assert curate_range(zone, curated, *month).first().transformed_html == 1
    assert {r.identifier for r in curated.current().collect()} == {"JAN", "FEB"}
    assert curate_range(zone, curated, *months[0]).first().unchanged == 1
    assert curate_range(zone, curated, *months[0], run_seq=7).first().unchanged == 1
    with pytest.raises(ValueError, match="belongs to"):
        curate_range(zone, curated, *months[1], run_seq=7)
    assert {bytes(r.data)[-30:] != b"" for r in curated.objects().collect()} == {True} and curated.objects().count() == 2


def test_known_documents_are_not_read(spark, tmp_path):
    listed, captured = site(spark)
    zone = LandingZone(spark, str(tmp_path / "l"))
    ingest(listed, captured, zone, run_id="r1", run_seq=1)
    broken = captured.withColumn("data", F.when(F.col("url").endswith("/a.html"), F.raise_error(F.lit("read")).cast("binary")).otherwise(F.col("data")))
    second = reconcile.totals(ingest(listed, broken, zone, run_id="r2", run_seq=2)).first()
    assert (second.new, second.skipped) == (1, 6)
    plan = landing.captures_of(captured, captured.limit(3).select("url"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Join LeftSemi")


def test_a_run_of_a_few_documents(spark, tmp_path):
    listed, captured = site(spark)
    zone = LandingZone(spark, str(tmp_path / "l"))
    total = reconcile.totals(ingest(listed, captured, zone, run_id="r", run_seq=0, limit=2)).first()
    assert total.new == 2 and zone.read("records").count() == 2


def test_captured_files_are_told_apart_by_folder(spark, tmp_path):
    from landfall.sources.captures import fetches_from_files
    for name, data in (("a/x.pdf", b"1"), ("b/x.pdf", b"2"), ("b/c/y z.pdf", b"3")):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data)
    manifest = spark.createDataFrame([("a/x.pdf", 1), ("b/x.pdf", 2), ("b/c/y z.pdf", 3), ("x.pdf", 4)], "file_name string, fetch_seq bigint").selectExpr(
        "*", "file_name AS url", "CAST(NULL AS INT) AS status", "CAST(NULL AS STRING) AS error")
    for folder in (str(tmp_path), f"file://{tmp_path}/"):
        got = {r.fetch_seq: r.data and bytes(r.data) for r in fetches_from_files(spark, folder, manifest).collect()}
        assert got == {1: b"1", 2: b"2", 3: b"3", 4: None}
