"""Captured listing pages: result counts, rows, records and their failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.functions import identity, markup, periods, urls
from landfall.functions.binding import bind, blank_to_null, first_present, let_sql, quote, strip_space
from landfall.operators.sequence import number_rows
from landfall.sources.staging import stage

# How a listing marks up its rows.
ROW_ELEMENT, ROW_CLASS = "li", "each-item"
TITLE_ELEMENT, TITLE_CLASS = "h2", "title"
BUTTON_CLASS = "btn"
REFERENCE_ELEMENT, REFERENCE_CLASS = "span", "refNO"
DESCRIPTION_ELEMENT, DESCRIPTION_CLASS = "p", "description"
DATE_ELEMENT, DATE_CLASS = "span", "date"
RESULT_COUNT = r"(?iU)of\s+([0-9,]+)\s+results"
NO_LINK = "unparsable listing row (no document link)"


def failure_reason(status: Column, error: Column) -> Column:
    """Why a capture failed, null if it did not: ``HTTP n`` or the error text."""
    bad_status = (status < 200) | (status >= 300)
    return F.when(bad_status, F.concat(F.lit("HTTP "), status.cast("string"))).when(error.isNotNull(), error)


def http_status(status: Column) -> Column:
    """Status of an HTTP failure, null for any other failure."""
    return F.when((status < 200) | (status >= 300), status)


def captured(pages: DataFrame) -> DataFrame:
    """Pages that were fetched successfully."""
    return pages.filter(failure_reason(F.col("status"), F.col("error")).isNull())


def result_count(html: Column) -> Column:
    """Total announced by a listing page, null if it announces none."""
    digits = F.replace(F.regexp_extract(html, RESULT_COUNT, 1), F.lit(","), F.lit(""))
    return blank_to_null(digits).try_cast("bigint")


def row_markup(html: Column) -> Column:
    """Markup of every row of a page, in order; broken rows, rows inside rows and rows without an end tag included."""
    return markup.items(html, ROW_ELEMENT, ROW_CLASS)


def found_counts(pages: DataFrame, rows: DataFrame) -> DataFrame:
    """Announced total per first page; without an announcement, its number of rows.

    ``rows`` are the pages' entries (:func:`listing_rows`), so no page is cut into rows a second time.
    """
    first = captured(pages).filter(F.col("page") == 1)
    counts = rows.groupBy("page_seq").agg(F.count("*").alias("_rows"))
    announced = first.select("page_seq", "body_key", F.col("partition_label").alias("partition_date"),
                             result_count(F.col("html")).alias("_announced"))
    return announced.join(counts, "page_seq", "left").select(
        "body_key", "partition_date", F.coalesce("_announced", "_rows", F.lit(0)).cast("bigint").alias("found"))


def page_base(url: Column, html: Column) -> Column:
    """URL that links of a page are relative to: its ``<base>`` if it has one."""
    base = markup.attribute(F.get(markup.opening_tags(html, "base"), F.lit(0)), "href")
    return F.when(html.rlike(r"(?i)<base[\s>]"), urls.resolve(url, F.coalesce(base, F.lit("")))).otherwise(url)


def _sql_link(tags: str) -> str:
    """First href among opening tags, null if empty or absent."""
    hrefs = f"transform({tags}, tag -> {markup.sql_attribute('tag', 'href')})"
    return f"nullif(get(filter({hrefs}, href -> href IS NOT NULL), 0), '')"


def _sql_with_class(row: str, element: str, css_class: str) -> str:
    return f"filter({markup.sql_opening_tags(row, element)}, tag -> {markup.sql_has_class('tag', css_class)})"


def _sql_text(row: str, element: str, css_class: str) -> str:
    return markup.sql_leading_text(markup.sql_first_subtree(row, element, css_class))


def _sql_entry(row: str) -> str:
    """Everything read from a row, as a struct."""
    def fields(title: str) -> str:
        anchor = quote(r"(?is)<a(?=[\s>]).*?</a\s*+>")
        edges = quote(r"(?is)\A<a[^>]*+>|</a\s*+>\z")
        title_text = markup.sql_leading_text(f"regexp_replace(regexp_extract({title}, {anchor}, 0), {edges}, '')")
        button = _sql_link(_sql_with_class(row, "a", BUTTON_CLASS))
        note = f"get({_sql_with_class(row, DESCRIPTION_ELEMENT, DESCRIPTION_CLASS)}, 0)"
        note_text = _sql_text(row, DESCRIPTION_ELEMENT, DESCRIPTION_CLASS)
        return (
            f"named_struct('link', coalesce({_sql_link(markup.sql_opening_tags(title, 'a'))}, {button}),"
            f" 'title_text', {title_text},"
            f" 'reference', {markup.sql_strip(_sql_text(row, REFERENCE_ELEMENT, REFERENCE_CLASS))},"
            f" 'description_text', coalesce(nullif({markup.sql_attribute(note, 'title')}, ''), {note_text}),"
            f" 'date_text', {_sql_text(row, DATE_ELEMENT, DATE_CLASS)})"
        )

    # A row may have several titles: the first link of any of them counts.
    return bind(f"array_join({markup.sql_subtrees(row, TITLE_ELEMENT, TITLE_CLASS)}, '')", fields)


def _entries(html: Column) -> Column:
    return let_sql(html, lambda page: (
        f"transform({markup.sql_items(page, ROW_ELEMENT, ROW_CLASS)}, row -> {_sql_entry('row')})"))


def listing_rows(pages: DataFrame) -> DataFrame:
    """One row per listing entry with everything read from it.

    ``fetch_seq`` numbers all entries by page and position, from 0. ``link`` is null for an
    entry without a document link; its other fields are then not to be used. Entries are
    staged: pages are read once, however often the result is used.
    """
    return read_entries(number_rows(stage(cut_entries(pages), "listing-entries"), "page_seq", "row_pos", "fetch_seq"))


#: Columns of a page that its entries keep.
_OF_PAGE = ["page_seq", "body_key", "body_id", "body_name", "partition_date", "listing_url", "base_url"]


def cut_entries(pages: DataFrame, *carry: str) -> DataFrame:
    """The entries of captured pages as structs, with their position and the ``carry`` columns. Works on streams."""
    # Entries are read inside the generator: a filter on them cannot be moved below it, where it would
    # read every row a second time. What is read from the page itself comes before it, once per page.
    based = captured(pages).select(
        "page_seq", "body_key", "body_id", "body_name", F.col("partition_label").alias("partition_date"),
        F.col("url").alias("listing_url"), page_base(F.col("url"), F.col("html")).alias("base_url"), "html", *carry)
    return based.select(*_OF_PAGE, *carry, F.posexplode(_entries(F.col("html"))).alias("row_pos", "entry"))


def read_entries(numbered: DataFrame, *carry: str) -> DataFrame:
    """Fields of numbered entries, their links resolved."""
    read = numbered.select(
        *_OF_PAGE, *carry, "row_pos",
        "fetch_seq", "entry.link", "entry.title_text", "entry.reference", "entry.description_text",
        periods.site_date(F.col("entry.date_text")).alias("published_date"))
    return read.withColumn("document_url", urls.resolve(F.col("base_url"), F.col("link"))).drop("base_url")


def candidates(rows: DataFrame) -> DataFrame:
    """Documents to fetch: listing entries with a link, as unfinished records."""
    return with_identifier(rows.filter(F.col("link").isNotNull())).select(*request_fields())


def with_identifier(rows: DataFrame) -> DataFrame:
    """Entries with the identifier of the document they link to."""
    return rows.withColumn("identifier", identity.identifier_from_url(F.col("document_url")))


def request_fields() -> list[Column]:
    """Columns of an unfinished record, from an entry with its identifier."""
    url = F.col("document_url")
    return [
        F.col("fetch_seq"), F.col("identifier"),
        strip_space(F.coalesce(first_present(F.col("title_text"), F.col("reference")), F.col("identifier")))
        .alias("title"),
        strip_space(F.coalesce(F.col("description_text"), F.lit(""))).alias("description"),
        *[F.col(name) for name in ("published_date", "body_key", "body_name", "body_id", "partition_date")],
        url.alias("source_url"), url, identity.document_type(url).alias("document_type"),
    ]


def listing_failures(pages: DataFrame) -> DataFrame:
    """Failures of listing pages: one per page, however many entries it held."""
    reason = failure_reason(F.col("status"), F.col("error"))
    return pages.filter(reason.isNotNull()).select(
        "body_key", F.col("partition_label").alias("partition_date"), "url",
        F.concat(F.lit("listing: "), reason).alias("reason"), http_status(F.col("status")).alias("status"))


def row_failures(rows: DataFrame) -> DataFrame:
    """Failures of entries without a document link, reported under the listing URL."""
    return rows.filter(F.col("link").isNull()).select(
        "body_key", "partition_date", F.col("listing_url").alias("url"), F.lit(NO_LINK).alias("reason"),
        F.lit(None).cast("int").alias("status"))
