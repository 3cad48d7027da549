"""Pages in the charsets they are written in, against Python's own decoding."""

import pytest
from pyspark.sql import functions as F

from landfall.functions import charsets

PROSE = {"cp1251": "Решение суда", "koi8-r": "Решение суда", "iso8859-2": "Żółć rozstrzygnięcie", "cp1250": "Żółć – „cytat“", "iso8859-7": "Απόφαση",
         "cp1256": "قرار", "cp1255": "החלטה", "cp1252": "Décision – “x” €", "iso8859-15": "Décision €", "mac-roman": "Décision"}


def read(spark, values):
    rows = spark.createDataFrame([(i, None if v is None else bytearray(v)) for i, v in enumerate(values)], "i int, v binary")
    return [r[0] for r in rows.orderBy("i").select(charsets.html_text(F.col("v"))).collect()]


def test_declared_charsets_by_every_name(spark):
    pages, wanted = [], []
    for codec, prose in PROSE.items():
        for name in charsets.SINGLE_BYTE[codec]:
            for head in (f'<meta charset="{name.upper()}">', f"<META http-equiv=Content-Type content='text/html; charset={name}'>",
                         f'<?xml version="1.0" encoding="{name}"?>', "<p>" + "x" * 5000 + f"<meta charset={name}>"):
                pages.append((head + prose).encode(codec))
                wanted.append(head + prose)
    assert read(spark, pages) == wanted


@pytest.mark.parametrize("codec", list(charsets.SINGLE_BYTE))
def test_tables_are_those_of_the_codec(codec):
    half = charsets.upper_half(codec)
    assert len(half) == 128 and all(c == "�" or c.encode(codec) == bytes([0x80 + i]) for i, c in enumerate(half))


def test_marks_come_before_declarations(spark):
    text = '<meta charset="koi8-r">é 😀 я'
    pages = [b"\xef\xbb\xbf" + text.encode(), b"\xff\xfe" + text.encode("utf-16-le"), b"\xfe\xff" + text.encode("utf-16-be"),
             b"\xff\xfe\x00\x00" + text.encode("utf-32-le"), b"\x00\x00\xfe\xff" + text.encode("utf-32-be"), b"\xff\xfe", b"\xef\xbb\xbfabc"]
    assert read(spark, pages) == [text] * 5 + ["", "abc"]


def test_damaged_and_undeclared_pages(spark):
    lone = b"\xff\xfe" + "a".encode("utf-16-le") + b"\x00\xd8" + "b".encode("utf-16-le") + b"\x00\xdc" + b"c"
    values = [lone, b"\xfe\xff\xd8\x00\x00a\xdc\x00", "Décision".encode(), "Décision".encode("cp1252"), '<meta charset="utf-8">é'.encode("cp1252"),
              '<meta charset="windows-1253">'.encode() + b"\xaa\xc3\xa9", '<meta charset="shift_jis">é'.encode(), b'<meta charset="cp1251">plain', b"", None,
              b"\x81\xff", b"\xff\xfe\x00\x00a\x00\x00\x00\x00\xd8\x00\x00\x00\x00\x11\x00b", b"\x00\x00\xfe\xff\xff\xff\xff\xff\x00\x00\x00a"]
    assert read(spark, values) == ["a�b��", "�a�", "Décision", "Décision", '<meta charset="utf-8">é', '<meta charset="windows-1253">ªÃ©',
                                   '<meta charset="shift_jis">é', '<meta charset="cp1251">plain', "", None, "\x81ÿ", "a���", "�a"]
