"""URL expressions: splitting, resolving and comparing, without a UDF.

``parse_url`` is not used: it throws on malformed input under ANSI mode and
keeps ``;params`` in the path, which would end up in identifiers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from landfall.functions.binding import let

_SCHEME = r"^([a-zA-Z][a-zA-Z0-9+.\-]*):"
_BEFORE_PATH = r"(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?"


def tidy(url: Column) -> Column:
    """Drop leading control characters and blanks, and any tab or line break."""
    return F.regexp_replace(F.translate(url, "\t\r\n", ""), r"^[\x00-\x20]++", "")


def url_path(url: Column) -> Column:
    """The path of a URL without authority, ``;params``, query and fragment."""
    raw = F.regexp_extract(tidy(url), rf"^{_BEFORE_PATH}([^?#]*)", 1)
    return F.regexp_replace(raw, r";[^/]*\z", "")


def basename(path: Column) -> Column:
    """What follows the last slash; may be empty."""
    return F.substring_index(path, "/", -1)


def stem(name: Column) -> Column:
    """A file name without its last extension; leading dots start no extension."""
    return F.regexp_replace(name, r"(?s)^(.*[^.].*)\.[^.]*\z", "$1")


def extension(url: Column) -> Column:
    """Lower-case extension of the URL's file name with its dot, or ``''``."""
    name = basename(url_path(url))
    return F.lower(F.regexp_extract(name, r"(?s)^.*[^.].*(\.[^.]*)\z", 1))


def host(url: Column) -> Column:
    """Authority part in lower case, ``''`` if the URL has none."""
    return F.lower(F.regexp_extract(tidy(url), r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)", 1))


def _parts(url: Column) -> Column:
    """Scheme, authority, path, query and fragment; absent ones are ``''``.

    ``query`` and ``fragment`` keep their ``?`` and ``#`` so that the pieces can
    simply be joined again.
    """
    def pieces(u: Column) -> Column:
        return F.struct(
            F.lower(F.regexp_extract(u, _SCHEME, 1)).alias("scheme"),
            F.regexp_extract(u, r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(//[^/?#]*)", 1).alias("authority"),
            F.regexp_extract(u, rf"^{_BEFORE_PATH}([^?#]*)", 1).alias("path"),
            F.regexp_extract(u, r"^[^?#]*(\?[^#]*)", 1).alias("query"),
            F.regexp_extract(u, r"(#.*)\z", 1).alias("fragment"),
        )

    return let(tidy(url), pieces)


def _merge_segments(base_path: Column, path: Column) -> Column:
    """Resolve a relative path against a base path, folding ``.`` and ``..``."""
    directory = F.regexp_replace(base_path, r"[^/]*\z", "")
    joined = F.concat(F.when(directory == "", F.lit("/")).otherwise(directory), path)
    full = F.when(path.startswith("/"), path).otherwise(F.regexp_replace(joined, "/++", "/"))

    def fold(segments: Column) -> Column:
        kept = F.aggregate(
            segments,
            F.array().cast("array<string>"),
            lambda done, seg: F.when(seg == ".", done)
            .when((seg == "..") & (F.size(done) > 0), F.slice(done, F.lit(1), F.size(done) - 1))
            .when(seg == "..", done)
            .otherwise(F.array_append(done, seg)),
        )
        ends_in_dots = F.element_at(segments, -1).isin(".", "..")
        return F.array_join(F.when(ends_in_dots, F.array_append(kept, F.lit(""))).otherwise(kept), "/")

    folded = let(F.split(full, "/"), fold)
    return F.when(folded.startswith("/"), folded).otherwise(F.concat(F.lit("/"), folded))


def resolve(base: Column, href: Column) -> Column:
    """Resolve a link found on page ``base`` to an absolute URL."""
    def combine(b: Column, h: Column) -> Column:
        scheme = F.concat(b["scheme"], F.lit(":"))
        absolute = (h["scheme"] != "") & ((h["scheme"] != b["scheme"]) | (h["authority"] != ""))
        same_document = (h["path"] == "") & (h["authority"] == "")
        query = F.when(h["query"] != "", h["query"]).otherwise(b["query"])
        return (
            F.when(absolute, tidy(href))
            .when(h["authority"] != "", F.concat(scheme, tidy(href)))
            .when(same_document, F.concat(scheme, b["authority"], b["path"], query, h["fragment"]))
            .otherwise(
                F.concat(scheme, b["authority"], _merge_segments(b["path"], h["path"]), h["query"], h["fragment"])
            )
        )

    return F.when(
        F.length(tidy(href)) > 0, let(_parts(base), lambda b: let(_parts(href), lambda h: combine(b, h)))
    ).otherwise(base)


def same_request_key(url: Column) -> Column:
    """Two URLs with the same key are one request: the fragment is dropped, query arguments are
    sorted, scheme and host compare in lower case and an empty path equals ``/``."""
    def build(p: Column) -> Column:
        given = F.filter(F.split(F.substring(p["query"], 2, 1 << 30), "&"), lambda a: a != "")
        arguments = F.array_sort(
            F.transform(given, lambda a: F.when(F.instr(a, "=") > 0, a).otherwise(F.concat(a, F.lit("="))))
        )
        path = F.when(p["path"] == "", F.lit("/")).otherwise(p["path"])
        return F.concat(
            p["scheme"], F.lit(":"), F.lower(p["authority"]), path,
            F.when(F.size(arguments) > 0, F.concat(F.lit("?"), F.array_join(arguments, "&"))).otherwise(F.lit("")),
        )

    return let(_parts(url), build)
