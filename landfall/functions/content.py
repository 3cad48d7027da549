"""Document bytes: canonical form, hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from landfall.functions.charsets import html_text as html_text

# Fixed value: the comment a site renders with a new number on every request.
VOLATILE_COMMENT = r"(?is)<!--\s*Elapsed time:.*?-->"

_COMMENT_START = bytearray(b"<!--")


def canonical_bytes(doc_type: Column, data: Column, volatile: str = VOLATILE_COMMENT) -> Column:
    """Document bytes without volatile comments; only html is touched.

    Bytes without any comment skip the regular expression. Valid UTF-8 is matched
    as text; other bytes go through ISO-8859-1, which maps each byte to one
    character and back, so nothing but the comments can change.
    """
    text = data.cast("string")
    as_utf8 = F.regexp_replace(text, volatile, "").cast("binary")
    as_latin = F.encode(F.regexp_replace(F.decode(data, "ISO-8859-1"), volatile, ""), "ISO-8859-1")
    return (
        F.when((doc_type != "html") | ~F.contains(data, F.lit(_COMMENT_START)), data)
        .when(F.is_valid_utf8(text), as_utf8)
        .otherwise(as_latin)
    )


def sha256_hex(data: Column) -> Column:
    """Lower-case hex SHA-256 of the bytes."""
    return F.sha2(data, 256)


def short_hash(digest: Column, length: int = 12) -> Column:
    """Prefix of a hex digest, used to version changed objects."""
    return F.substring(digest, 1, length)


def byte_length(data: Column) -> Column:
    """Number of bytes (not characters)."""
    return F.octet_length(data).cast("bigint")
