"""Reduce a page to its content and wrap it as a small document."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from landfall.functions import markup
from landfall.functions.binding import bind, let, let_sql, quote

# Content container, elements never kept, and page furniture that
# is removed only when a page has no content container.
CONTENT_ELEMENT, CONTENT_CLASS = "div", "content"
UNWANTED_ELEMENTS = ("script", "style", "nav", "header", "footer", "form", "button", "noscript")
FURNITURE_IDS = ("globalCookieBar", "search", "binderFixed")
FURNITURE_CLASSES = ("top-header", "language-switch", "google-translate", "logo-header", "searchbanner",
                     "footer-one", "footer-two", "social-banner")

# The wrapper of a curated page.
_HEAD = '<!DOCTYPE html>\n<html lang="en">\n<head>\n<meta charset="utf-8">\n<title>'
_TITLE_END = "</title>\n</head>\n<body>\n<h1>"
_HEADING_END = "</h1>\n"
_TAIL = "\n</body>\n</html>\n"


def _sql_strip_furniture(html: str) -> str:
    ids, classes = (", ".join(map(quote, values)) for values in (FURNITURE_IDS, FURNITURE_CLASSES))

    # Pages, and tags, that name none of the blocks are not looked into.
    named = quote("|".join(FURNITURE_IDS + FURNITURE_CLASSES))

    def is_furniture(name: str, tag: str) -> str:
        own_id = f"coalesce({markup.sql_attribute(tag, 'id')}, '')"
        return (f"IF({tag} RLIKE {named}, arrays_overlap({markup.sql_classes(tag)}, array({classes}))"
                f" OR {own_id} IN ({ids}), false)")

    return bind(html, lambda page: (
        f"IF({page} RLIKE {named}, {markup.sql_drop_subtrees(page, markup.ANY_TAG, is_furniture)}, {page})"))


def _sql_content_of(html: str) -> str:
    container = markup.sql_first_subtree(html, CONTENT_ELEMENT, CONTENT_CLASS)
    return f"coalesce({container}, {_sql_strip_furniture(markup.sql_body_of(html))})"


def strip_boilerplate(html: Column) -> Column:
    """Drop scripts, navigation, forms and the like with everything in them."""
    return markup.drop_elements(html, UNWANTED_ELEMENTS)


def strip_furniture(html: Column) -> Column:
    """Drop blocks known by id or class."""
    return let_sql(html, _sql_strip_furniture)


def content_of(html: Column) -> Column:
    """Inside of the content container, or of the body without its furniture."""
    return let_sql(html, _sql_content_of)


def content_body(html: Column) -> Column:
    """Content without boilerplate, trimmed."""
    return let_sql(html, lambda page: markup.sql_strip(
        markup.sql_drop_elements(_sql_content_of(page), UNWANTED_ELEMENTS)))


def escape(text: Column) -> Column:
    """Escape text for use between tags."""
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def wrap(title: Column, body: Column) -> Column:
    """A complete page with the title as its heading."""
    return let(escape(title), lambda t: F.concat(
        F.lit(_HEAD), t, F.lit(_TITLE_END), t, F.lit(_HEADING_END), body, F.lit(_TAIL)))


def clean_html(html: Column, title: Column) -> Column:
    """The curated form of a page."""
    return wrap(title, content_body(html))
