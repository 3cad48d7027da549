"""Pages whose only content is a link to the real document."""

from __future__ import annotations

from pyspark.sql import Column

from landfall.functions import markup
from landfall.functions.binding import let_sql, quote
from landfall.functions.cleaning import CONTENT_CLASS, CONTENT_ELEMENT

# Text length from which a page counts as a document of its own,
# class of the download link, and the file endings worth following.
MIN_CONTENT_CHARS = 200
DOWNLOAD_CLASS = "download"
DOWNLOAD_ENDINGS = r"(?i)^[^?]*\.(?:pdf|doc|docx|rtf)(?:\?|\z)"


def _sql_content_chars(html: str) -> str:
    containers = markup.sql_subtrees(html, CONTENT_ELEMENT, CONTENT_CLASS)
    # Texts of all containers are joined as they are and trimmed once.
    texts = f"transform({containers}, part -> {markup.sql_all_text('part')})"
    joined = f"array_join(filter({texts}, t -> t <> ''), ' ')"
    return f"length({markup.sql_strip(joined)})"


def _sql_download_link(html: str) -> str:
    anchors = f"filter({markup.sql_opening_tags(html, 'a')}, tag -> {markup.sql_has_class('tag', DOWNLOAD_CLASS)})"
    links = f"transform({anchors}, tag -> {markup.sql_attribute('tag', 'href')})"
    file_link = f"get(filter({links}, link -> coalesce(link RLIKE {quote(DOWNLOAD_ENDINGS)}, false)), 0)"
    # The cheap test comes first: most pages have no download link at all.
    mentioned = quote(rf"(?i)class\s*=[^>]*{DOWNLOAD_CLASS}")
    return f"IF({html} RLIKE {mentioned}, IF({_sql_content_chars(html)} < {MIN_CONTENT_CHARS}, {file_link}, NULL), NULL)"


def content_chars(html: Column) -> Column:
    """Characters of text in all content containers, 0 if there are none."""
    return let_sql(html, _sql_content_chars)


def download_link(html: Column) -> Column:
    """Link to follow from a stub page; null for a page with enough text of its own."""
    return let_sql(html, _sql_download_link)
