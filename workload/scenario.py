"""Captured sites derived from the ``pages`` table.

Two landing runs: first the pages served over https, then all pages with some of
them revised, emptied or failing; and a run of all pages as they are, to curate. All
conditions are facts of the URL; every page takes part with its whole text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.functions import identity
from landfall.operators import listing
from landfall.streaming.merge import decide


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Every page as a document with landing metadata and its text as ``html``.

    German pages count as PDF files and Spanish ones as Word files. The ad
    comments become comments that change with every request.
    """
    url = F.col("url")
    language = F.regexp_extract(url, "^[a-z]+://[^/?#]*/([a-z]+)/", 1)
    file_url = F.when(language == "de", F.regexp_replace(url, "/de/([0-9]+)[^#?]*", "/de/$1.pdf")).when(
        language == "es", F.regexp_replace(url, "/es/([0-9]+)[^#?]*", "/es/$1.docx")).otherwise(url)
    pages = table(spark, folder, "pages").select(
        F.col("page_id").alias("fetch_seq"), url.alias("page_url"), file_url.alias("document_url"),
        language.alias("body_key"), F.replace("html", F.lit("<!-- ad "), F.lit("<!-- Elapsed time: ")).alias("html"))
    named = pages.withColumn("identifier", identity.identifier_from_url(F.col("document_url")))
    published = F.date_add(F.lit("2022-01-01").cast("date"), F.col("identifier").try_cast("int"))
    dated = named.withColumn("published_date", published)
    return dated.withColumns({
        "title": F.concat(F.lit("Page "), F.col("identifier")),
        "description": F.col("page_url"),
        "body_name": F.upper("body_key"),
        "body_id": F.ascii("body_key"),
        "partition_date": F.coalesce(F.date_format("published_date", "yyyy-MM"), F.lit("undated")),
        "source_url": F.col("page_url"),
        "document_type": identity.document_type(F.col("document_url")),
    })


def first_run(spark: SparkSession, folder: str) -> DataFrame:
    """The pages served over https, as they are."""
    return whole_run(spark, folder).filter(F.col("page_url").startswith("https:"))


def whole_run(spark: SparkSession, folder: str) -> DataFrame:
    """All pages, as they are."""
    return documents(spark, folder).withColumns({
        "status": F.lit(200), "error": F.lit(None).cast("string"), "data": F.col("html").cast("binary"),
    }).drop("html")


def second_run(spark: SparkSession, folder: str) -> DataFrame:
    """All pages; revised, emptied, refused or timed out depending on their URL."""
    url, html = F.col("page_url"), F.col("html")
    emptied = F.concat(F.lit("<!-- Elapsed time: "), F.col("identifier"), F.lit(" -->"))
    refused, late = url.contains("spam-farm"), url.contains("cheap-pills")
    body = F.when(url.contains("//m.") & (F.col("document_type") == "html"), emptied).when(
        url.contains("page=2"), F.concat(html, F.lit("<p>revised</p>"))).otherwise(html)
    return documents(spark, folder).withColumns({
        "status": F.when(refused, 404).when(~late, 200),
        "error": F.when(late, F.lit("timed out")),
        "data": F.when(~refused & ~late, body.cast("binary")),
    }).drop("html")


def decided(batch: DataFrame) -> DataFrame:
    """Documents with hash, length and failure, without bytes."""
    return decide(batch)


def as_landed(batch: DataFrame, run_seq: int) -> DataFrame:
    """A log of a run into an empty zone in which nothing was skipped: every document is a version."""
    return decided(batch).withColumn("run_seq", F.lit(run_seq).cast("bigint"))


def listing_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's navigation as a listing; pages with a query announce a count.

    Entries of German pages lose their link, those of French ones get a button
    instead of a title link, those of Spanish ones have no end tag.
    """
    url, html = F.col("url"), F.col("html")
    language = F.regexp_extract(url, "^[a-z]+://[^/?#]*/([a-z]+)/", 1)
    number = F.regexp_extract(url, "/([0-9]+)", 1).cast("int")
    opened = F.replace(html, F.lit("<li><a href="), F.when(
        language == "de", F.lit('<li class="each-item"><h2 class="title"><a name=')).when(
        language == "fr", F.lit('<li class="each-item"><h2 class="title">Nom</h2><a class="small btn" href=')).otherwise(
        F.lit('<li class="each-item clearfix"><h2 class="title"><a href=')))
    tail = F.concat(
        F.lit('</a></h2><span class="date">'), F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), number), "dd/MM/yyyy"),
        F.lit('</span><p class="description" title="From &quot;'), language, F.lit('&quot;">x</p><span class="refNO"> R-'),
        F.col("page_id").cast("string"), F.when(language == "es", F.lit(" </span>")).otherwise(F.lit(" </span></li>")))
    closed = F.replace(opened, F.lit("</a></li>"), tail)
    announced = F.when(url.contains("?"), F.concat(
        F.lit("<p>Shows 1 to 10 of "), F.format_number(F.length("html"), 0), F.lit(" Results</p>"))).otherwise(F.lit(""))
    return table(spark, folder, "pages").select(
        F.col("page_id").alias("page_seq"), language.alias("body_key"), F.lit(1).alias("body_id"),
        F.upper(language).alias("body_name"), F.lit("2024-01").alias("partition_label"), F.lit(1).alias("page"), "url",
        F.when(url.contains("spam-farm"), 503).otherwise(200).alias("status"),
        F.when(url.contains("cheap-pills"), F.lit("timed out")).alias("error"),
        F.concat(announced, closed).alias("html"))


def with_container(spark: SparkSession, folder: str) -> DataFrame:
    """Pages whose article is wrapped in nested content containers."""
    opened = F.replace("html", F.lit("<article>"), F.lit('<div class="main content"><div class="inner">'))
    return table(spark, folder, "pages").select(
        "page_id", "url", F.replace(opened, F.lit("</article>"), F.lit("</div></div>")).alias("html"))


def with_furniture(spark: SparkSession, folder: str) -> DataFrame:
    """Pages whose ad block carries a class that marks page furniture."""
    ad = '<div class="wide social-banner"><div>nested</div>'
    return table(spark, folder, "pages").select(
        "page_id", "url", F.replace("html", F.lit('<div class="ad">'), F.lit(ad)).alias("html"))


def with_download(spark: SparkSession, folder: str) -> DataFrame:
    """Pages in a content container with a download link behind it; short ones are stubs.

    On pages with a query the container ends after the heading.
    """
    file = F.concat(F.lit('<a class="download" href="/files/'), F.regexp_extract("url", "/([0-9]+)[^/]*/?$", 1),
                    F.lit('.pdf?v=1">file</a><footer>'))
    heading_only = F.replace("html", F.lit("</h1>"), F.lit("</h1></div></div><div><div>"))
    ended = F.when(F.col("url").contains("?"), heading_only).otherwise(F.col("html"))
    return with_container(spark, folder).withColumn("html", F.replace(ended, F.lit("<footer>"), file))


def stub_captures(spark: SparkSession, folder: str) -> DataFrame:
    """Captures of the pages above, and of the files behind the English ones."""
    pages = with_download(spark, folder)
    html = pages.select(F.col("page_id").alias("fetch_seq"), "url", F.lit(200).alias("status"),
                        F.lit(None).cast("string").alias("error"), F.col("html").cast("binary").alias("data"))
    target = F.concat(F.regexp_extract("url", "^([a-z]+://[^/?#]*)", 1), F.lit("/files/"),
                      F.regexp_extract("url", "/([0-9]+)[^/]*/?$", 1), F.lit(".pdf?v=1"))
    files = pages.filter(F.col("url").contains("/en/")).select(
        (F.col("page_id") + 1_000_000_000).alias("fetch_seq"), target.alias("url"),
        F.when(F.col("url").contains("www."), 410).otherwise(200).alias("status"),
        F.lit(None).cast("string").alias("error"), F.concat(F.lit("%PDF "), F.col("url")).cast("binary").alias("data"))
    return html.unionByName(files)


def link_captures(pages: DataFrame) -> DataFrame:
    """A capture of every document the listings link to; names with a comma are gone."""
    rows = listing.listing_rows(pages).filter(F.col("link").isNotNull())
    targets = rows.groupBy(F.col("document_url").alias("url")).agg(F.min("fetch_seq").alias("fetch_seq"))
    page = F.concat(F.lit("<html><nav>menu</nav><div class='content'> <p>"), F.col("url"), F.lit("</p></div></html>"))
    gone = F.col("url").contains(",")
    return targets.select("fetch_seq", "url", F.when(gone, 404).otherwise(200).alias("status"),
                          F.lit(None).cast("string").alias("error"), F.when(~gone, page.cast("binary")).alias("data"))


def events_as_documents(events: DataFrame) -> DataFrame:
    """Events as documents: the user is the identifier, the event type the content."""
    user = F.concat(F.lit("U"), F.col("user_id").cast("string"))
    return events.select(
        F.col("event_id").alias("fetch_seq"), user.alias("identifier"), user.alias("title"),
        F.col("props").alias("description"), F.to_date("ts").alias("published_date"), F.lit("events").alias("body_key"),
        F.lit("Events").alias("body_name"), F.lit(1).alias("body_id"), F.date_format("ts", "yyyy-MM").alias("partition_date"),
        F.concat(F.lit("/users/"), user).alias("source_url"), F.concat(F.lit("/users/"), user).alias("document_url"),
        F.lit("html").alias("document_type"), F.lit(None).cast("int").alias("status"),
        F.lit(None).cast("string").alias("error"), F.col("event_type").cast("binary").alias("data"))
