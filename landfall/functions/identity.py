"""Identifiers, document types and storage keys derived from URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from landfall.functions.binding import blank_to_null, collapse_space, strip_space, tighten_hyphens
from landfall.functions.urls import basename, extension, stem, url_path

# Extensions per document type and content types.
PDF_EXTENSIONS = (".pdf",)
DOC_EXTENSIONS = (".doc", ".docx", ".rtf")
CONTENT_TYPES = {
    "html": "text/html; charset=utf-8",
    "pdf": "application/pdf",
    "doc": "application/msword",
}
DEFAULT_CONTENT_TYPE = "application/octet-stream"


def _map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(v) for pair in values.items() for v in pair])


def normalize_identifier(raw: Column) -> Column:
    """Upper case, no blanks around hyphens, single blanks elsewhere."""
    return F.upper(collapse_space(tighten_hyphens(strip_space(raw))))


def identifier_from_url(url: Column) -> Column:
    """The URL's file name without extension and edge punctuation, normalised.

    Empty for a URL whose path ends in a slash: such documents share one
    identifier, which is why no operator may gather all rows of an identifier.
    """
    return normalize_identifier(F.btrim(stem(basename(url_path(url))), F.lit("_-. ")))


def document_type(url: Column) -> Column:
    """``pdf``, ``doc`` or (anything else) ``html``."""
    types = {**dict.fromkeys(PDF_EXTENSIONS, "pdf"), **dict.fromkeys(DOC_EXTENSIONS, "doc")}
    return F.coalesce(F.try_element_at(_map(types), extension(url)), F.lit("html"))


def document_extension(url: Column, doc_type: Column) -> Column:
    """Extension to store a document under; html is always ``.html``."""
    default = F.when(doc_type == "pdf", ".pdf").otherwise(".bin")
    return F.when(doc_type == "html", ".html").otherwise(F.coalesce(blank_to_null(extension(url)), default))


def content_type(doc_type: Column) -> Column:
    """MIME type of a document type."""
    return F.coalesce(F.try_element_at(_map(CONTENT_TYPES), doc_type), F.lit(DEFAULT_CONTENT_TYPE))


def landing_key(source: Column, label: Column, identifier: Column, ext: Column, version: Column) -> Column:
    """``source/label/identifier[__version].ext``; a null or empty version adds no suffix."""
    suffix = F.when(version != "", F.concat(F.lit("__"), version)).otherwise("")
    return F.concat(source, F.lit("/"), label, F.lit("/"), identifier, suffix, ext)


def curated_key(identifier: Column, ext: Column) -> Column:
    """``identifier.ext``, without source or label."""
    return F.concat(identifier, ext)


def label_of_key(storage_path: Column) -> Column:
    """The label inside a landing key, the column landing objects are partitioned by."""
    return F.split_part(storage_path, F.lit("/"), F.lit(2))
