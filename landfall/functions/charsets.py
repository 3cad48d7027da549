"""Text of pages in the charset they are written in: byte-order marks, declared single-byte sets, UTF-8, windows-1252."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from landfall.functions.binding import let

# Single-byte charsets and the names by which pages declare them.
SINGLE_BYTE = {
    "cp1250": ("windows-1250", "cp1250", "x-cp1250"), "cp1251": ("windows-1251", "cp1251", "x-cp1251"),
    "cp1252": ("windows-1252", "cp1252", "x-cp1252", "iso-8859-1", "iso8859-1", "iso_8859-1", "latin1", "l1", "us-ascii", "ascii"),
    "cp1253": ("windows-1253", "cp1253", "x-cp1253"), "cp1254": ("windows-1254", "cp1254", "x-cp1254", "iso-8859-9", "latin5"),
    "cp1255": ("windows-1255", "cp1255", "x-cp1255"), "cp1256": ("windows-1256", "cp1256", "x-cp1256"),
    "cp1257": ("windows-1257", "cp1257", "x-cp1257"), "cp1258": ("windows-1258", "cp1258", "x-cp1258"),
    "cp874": ("windows-874", "tis-620", "iso-8859-11"), "cp866": ("ibm866", "cp866", "866"),
    "iso8859-2": ("iso-8859-2", "iso8859-2", "latin2", "l2"), "iso8859-3": ("iso-8859-3", "latin3"),
    "iso8859-4": ("iso-8859-4", "latin4"), "iso8859-5": ("iso-8859-5", "cyrillic"), "iso8859-6": ("iso-8859-6", "arabic"),
    "iso8859-7": ("iso-8859-7", "greek"), "iso8859-8": ("iso-8859-8", "hebrew"), "iso8859-10": ("iso-8859-10", "latin6"),
    "iso8859-13": ("iso-8859-13",), "iso8859-14": ("iso-8859-14",), "iso8859-15": ("iso-8859-15", "latin9"),
    "iso8859-16": ("iso-8859-16",), "koi8-r": ("koi8-r", "koi8"), "koi8-u": ("koi8-u",), "mac-roman": ("macintosh", "mac")}
# Byte-order marks and what they announce; longer ones first.
MARKS = ((b"\xff\xfe\x00\x00", "UTF-32LE"), (b"\x00\x00\xfe\xff", "UTF-32BE"), (b"\xff\xfe", "UTF-16LE"), (b"\xfe\xff", "UTF-16BE"))
DECLARED = r"(?i)<(?:meta\b[^>]*?\bcharset|\?xml\b[^>]*?\bencoding)\s*=\s*[\"']?\s*([a-z0-9_:.-]+)"

_UPPER = "".join(map(chr, range(0x80, 0x100)))
_UNKNOWN = "�"


def upper_half(codec: str) -> str:
    """The characters of the bytes 0x80 to 0xff, U+FFFD where there is none."""
    return bytes(range(0x80, 0x100)).decode(codec, "replace")


def html_text(data: Column) -> Column:
    """Markup as a string. Never fails; null gives null.

    A byte-order mark decides first, then the first charset that a ``meta`` element or an XML declaration anywhere in the
    page names, if it is a single-byte one that has all bytes of the page, then UTF-8 if valid, then windows-1252. Pages of
    ASCII alone are the same in all of these and are not searched. Latin 1 means windows-1252, as on the web. Declared
    sets of several bytes other than UTF-8, and damaged ones, are read as if nothing were declared. Half a character at the
    end of UTF-16 or UTF-32 becomes U+FFFD, as does what is not a character there.
    """
    def of(text: Column) -> Column:
        valid = F.is_valid_utf8(text)
        utf8 = F.when(text.startswith(_BOM), F.substring(text, 2, 0x7FFFFFFF)).otherwise(text)
        ascii_only = valid & (F.char_length(text) == F.octet_length(data))
        return F.when(ascii_only, text).when(valid & text.startswith(_BOM), utf8).otherwise(
            F.coalesce(_marked(data), let(F.decode(data, "ISO-8859-1"), lambda latin: F.coalesce(
                _declared(latin), F.when(valid, utf8), _western(latin)))))

    return let(data.cast("string"), of)


_BOM = "﻿"


def _marked(data: Column) -> Column:
    """Text after a byte-order mark of UTF-16 or UTF-32, null without one."""
    found = None
    for mark, charset in MARKS:
        width = 4 if charset.startswith("UTF-32") else 2
        body = F.substring(data, len(mark) + 1, 0x7FFFFFFF)
        odd = F.octet_length(body) % width
        whole = F.call_function("substring", body, F.lit(1), F.octet_length(body) - odd)
        text = F.concat(_decoded(whole, mark, charset), F.when(odd > 0, F.lit(_UNKNOWN)).otherwise(F.lit("")))
        begins = F.substring(data, 1, len(mark)) == F.lit(bytearray(mark))
        found = F.when(begins, text) if found is None else found.when(begins, text)
    return found


def _decoded(data: Column, mark: bytes, charset: str) -> Column:
    """Text of UTF-16 or UTF-32 bytes whose units are whole. ``decode`` refuses what is no character: it is replaced before."""
    # As hexadecimal digits: a surrogate without its other half; a code point beyond the last, or of a surrogate.
    units = F.regexp_replace(F.hex(data), r"(.{4})" if charset.startswith("UTF-16") else r"(.{8})", "$1 ")
    lead, trail, wrong, unknown = {
        "UTF-16LE": ("..D[89AB]", "..D[C-F]", "", "FDFF "), "UTF-16BE": ("D[89AB]..", "D[C-F]..", "", "FFFD "),
        "UTF-32LE": ("", "", r"..D[89A-F]0000 |(?!....(?:0.|10)00)\w{8} ", "FDFF0000 "),
        "UTF-32BE": ("", "", r"0000D[89A-F].. |(?!00(?:0.|10))\w{8} ", "0000FFFD ")}[charset]
    wrong = wrong or rf"{lead} (?!{trail})|(?<!{lead} ){trail} "
    mended = F.unhex(F.replace(F.regexp_replace(units, wrong, unknown), F.lit(" "), F.lit("")))
    if charset.startswith("UTF-32"):
        return F.decode(F.concat(F.lit(bytearray(mark)), mended), "UTF-32")  # reads the mark
    return F.decode(F.when(F.hex(data).rlike("D[89A-F]"), mended).otherwise(data), charset)  # most have no surrogates


def _declared(latin: Column) -> Column:
    """Text in the declared single-byte charset, null if there is none or it lacks a byte of the page."""
    names = [part for codec, aliases in SINGLE_BYTE.items() for name in aliases for part in (F.lit(name), F.lit(upper_half(codec)))]
    name = F.lower(F.regexp_extract(latin, DECLARED, 1))
    text = F.call_function("translate", latin, F.lit(_UPPER), F.try_element_at(F.create_map(*names), name))
    return let(text, lambda t: F.when(~F.contains(t, F.lit(_UNKNOWN)), t))


def _western(latin: Column) -> Column:
    """windows-1252; its five bytes without a character stay control characters."""
    table = "".join(chr(0x80 + i) if c == _UNKNOWN else c for i, c in enumerate(upper_half("cp1252")))
    return F.translate(latin, _UPPER, table)
