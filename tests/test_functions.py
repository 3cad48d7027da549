"""Column expressions against fixed examples and the Python standard library."""

import datetime as dt
import hashlib
import os
import random
import re
from html import unescape
from urllib.parse import urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from landfall.functions import content, identity, markup, periods, urls


def column(spark, values, expr, schema="v string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r.out for r in rows.select("i", expr(F.col("v")).alias("out")).orderBy("i").collect()]


URLS = [
    "https://x.example/files/2023/march/ruling-00318.html",
    "https://x.example/abc5512.html",
    "https://x.example/tk77_2019.html",
    "https://x.example/qa12_08_qb13_08_qc14_08_.html",
    "http://h", "http://h/", "http://h/a/", "http://h/a/b.tar.gz", "http://h/.html", "http://h/..a",
    "http://h/a;p=1/b;q.pdf?x=/y.doc#/z.rtf", "//h/p/q.PDF", "a/b c - d.docx", "  http://h/x y.html", "http://h/a.",
    "http://h?x=/a/b.pdf", "http://h#/a.pdf", "", "mailto:a@b.c", "http://h/straße.html", "http://h/a%20b.htm",
    "http://h/x\ty\n.pdf", "http://h/_.-a-._.html", "http://h/a - b.html", "HTTP://H/A.RTF",
]


def expected_identifier(url):
    name = os.path.splitext(os.path.basename(urlparse(url).path))[0].strip("_-. ")
    return re.sub(r"\s+", " ", re.sub(r"\s*-\s*", "-", name.strip())).upper()


def test_identifiers_match_the_standard_library(spark):
    got = column(spark, URLS, identity.identifier_from_url)
    assert got == [expected_identifier(u) for u in URLS]
    assert got[:4] == ["RULING-00318", "ABC5512", "TK77_2019", "QA12_08_QB13_08_QC14_08"]


def test_normalize_identifier(spark):
    raw = ["QX - ZZ - 0042", "  REF-K77-15  ", "a   b", "straße"]
    assert column(spark, raw, identity.normalize_identifier) == [
        "QX-ZZ-0042", "REF-K77-15", "A B", "STRASSE"]


def test_extension_and_type(spark):
    got = column(spark, URLS, urls.extension)
    assert got == [os.path.splitext(urlparse(u).path)[1].lower() for u in URLS]
    names = ["/note-7.html", "/annex.PDF", "/annex.docx", "/annex", "/a.rtf?x=b.pdf", "/a.doc"]
    assert column(spark, names, identity.document_type) == ["html", "pdf", "doc", "html", "doc", "doc"]
    pairs = spark.createDataFrame(
        [("/a/b.html", "html"), ("/a/b.pdf", "pdf"), ("/a/b.docx", "doc"), ("/a/b", "pdf"), ("/a/b", "doc"),
         ("/a.php", "html")], "u string, t string")
    exts = [r[0] for r in pairs.select(identity.document_extension(F.col("u"), F.col("t"))).collect()]
    assert exts == [".html", ".pdf", ".docx", ".pdf", ".bin", ".html"]
    types = column(spark, ["html", "pdf", "doc", "other"], identity.content_type)
    assert types == ["text/html; charset=utf-8", "application/pdf", "application/msword", "application/octet-stream"]


def test_landing_and_curated_keys(spark):
    row = spark.range(1).select(
        identity.landing_key(F.lit("river_board"), F.lit("2023-07"), F.lit("RB-9"), F.lit(".html"),
                             F.lit(None).cast("string")).alias("a"),
        identity.landing_key(F.lit("river_board"), F.lit("2023-07"), F.lit("RB-9"), F.lit(".html"),
                             F.lit("f00d42")).alias("b"),
        identity.curated_key(F.lit("RULING-00318"), F.lit(".html")).alias("c"),
        identity.label_of_key(F.lit("river_board/2023-07/RB-9.html")).alias("d"),
    ).first()
    assert list(row) == ["river_board/2023-07/RB-9.html", "river_board/2023-07/RB-9__f00d42.html",
                         "RULING-00318.html", "2023-07"]


@pytest.mark.parametrize("base", ["http://h/en/cases/x.html?a=1#f", "https://h", "http://h/a//b/c", "http://h/a/b/"])
def test_resolve_matches_the_standard_library(spark, base):
    hrefs = ["/en/x.pdf", "x.html", "./x", "../x", "../../x/y", "../../../../z", "..", ".", "a/../b/./c/", "//other/p",
             "https://o.example/q?r#s", "?page=2", "#top", "", "x//y///z", "/a//b", "mailto:me@x", "x?y=../z", "/../q",
             "  spaced.html", "x/..", "/a/b/../c/./d.."]
    got = column(spark, hrefs, lambda h: urls.resolve(F.lit(base), h))
    assert got == [urljoin(base, h.strip()) for h in hrefs]


def test_same_request_key(spark):
    same = ["http://H/a?b=2&a=1#x", "HTTP://h/a?a=1&b=2", "http://h/a?a=1&&b=2"]
    assert len(set(column(spark, same, urls.same_request_key))) == 1
    other = ["http://h/a?a=1&b=2", "http://h/a?a=1", "http://h/a", "http://h/A", "https://h/a", "http://h/a?A=1"]
    assert len(set(column(spark, other, urls.same_request_key))) == len(other)
    assert len(set(column(spark, ["http://h", "http://h/", "http://h?", "http://h/?x", "http://h/?x="],
                          urls.same_request_key))) == 2


def canonical(spark, doc_type, values):
    return column(spark, [bytearray(v) for v in values],
                  lambda v: content.canonical_bytes(F.lit(doc_type), v), "v binary")


def test_canonical_bytes_equal_a_byte_regex(spark):
    every_byte = bytes(range(256))
    samples = [
        b"<html>x<!-- Elapsed time: 0.01 --></html>", b"<html>x<!-- Elapsed time: 9 --></html>",
        b"<!--elapsed TIME:\n1--><p>\xff\xfe<!-- Elapsed time: -->" + every_byte, b"<!-- other -->", b"", every_byte,
        "é<!-- Elapsed time: ü -->ß".encode(), b"<!-- Elapsed time: never closed",
    ]
    pattern = re.compile(rb"<!--\s*Elapsed time:.*?-->", re.I | re.S)
    got = canonical(spark, "html", samples)
    assert [bytes(b) for b in got] == [pattern.sub(b"", s) for s in samples]
    assert got[0] == got[1]
    assert [bytes(b) for b in canonical(spark, "pdf", samples)] == samples


def test_hash_and_length(spark):
    values = [b"abc", b"", "é".encode()]
    got = column(spark, [bytearray(v) for v in values], content.sha256_hex, "v binary")
    assert got == [hashlib.sha256(v).hexdigest() for v in values]
    assert got[0].startswith("ba7816bf") and got[0].endswith("15ad")
    assert column(spark, [bytearray(v) for v in values], content.byte_length, "v binary") == [3, 0, 2]
    assert column(spark, [got[0]], content.short_hash) == [got[0][:12]]


def test_html_text_never_fails(spark):
    values = ["é".encode(), b"caf\xe9 \x93q\x94", b"\xef\xbb\xbfx", b"\x81"]
    got = column(spark, [bytearray(v) for v in values], content.html_text, "v binary")
    assert got == ["é", "café “q”", "x", "\x81"]


def test_site_date(spark):
    texts = ["31/01/2024", " 1/2/2024 ", "30/02/2024", "01/01/24", "", None, "2024-01-01", "29/02/2023", "29/02/2024",
             "1/1/+2024", " 5/6/2020"]
    assert column(spark, texts, periods.site_date) == [
        dt.date(2024, 1, 31), dt.date(2024, 2, 1), None, None, None, None, None, None, dt.date(2024, 2, 29), None,
        dt.date(2020, 6, 5)]


NESTED = """<!DOCTYPE html><html><head><style>div.content{}</style></head><body>
<!-- <div class="content">commented</div> --><script>"<div class='content'>"</script>
<div class="wrap"><div id='a' class="big content wide">one<div>two<nav>menu<nav>deep</nav>x</nav></div>
<p title="a > b" class=it's>three</p><BUTTON type=submit>go</BUTTON></div>tail</div>
<div class="contents">no</div><div class="content">second</div></body></html>"""


def test_first_subtree_and_drop(spark):
    def clean(html):
        inner = markup.first_subtree(html, "div", "content")
        return markup.drop_elements(inner, ["script", "style", "nav", "button"])

    assert column(spark, [NESTED, "<p>none</p>", None], clean) == [
        'one<div>two</div>\n<p title="a > b" class=it\'s>three</p>', None, None]


def test_subtrees_are_outermost_and_ordered(spark):
    html = '<div class="content">a<div class="content">b</div></div>x<DIV CLASS=content>c</div><div class="content">d'
    assert column(spark, [html, ""], lambda h: markup.subtrees(h, "div", "content")) == [
        ['a<div class="content">b</div>', "c", "d"], []]


ITEM = '<li class="each-item">'


@pytest.mark.parametrize(("html", "inside"), [
    (f"<ul>{ITEM}a{ITEM}b<li>c</ul>after", ["a", "b"]),
    (f"<ul>{ITEM}a<ul>{ITEM}in{ITEM}in2</ul>b</li>{ITEM}c</li></ul>", [f"a<ul>{ITEM}in{ITEM}in2</ul>b", "in", "in2", "c"]),
    (f"{ITEM}a</li>x</li>{ITEM}b", ["a", "b"]),
    (f"<div>{ITEM}a<div>d</div>{ITEM}b</div>t", ["a<div>d</div>", "b"]),
    (f"<ul>{ITEM}a</div><p>x{ITEM}b</ul>{ITEM}c<td></li>z</td>", ["a</div><p>x", "b", "c<td></li>z</td>"]),
    (f'{ITEM}<!-- <li> -->a<script>"</li>"</script>{ITEM}', ['<!-- <li> -->a<script>"</li>"</script>', ""]),
    ("<ul><li>plain</ul>", []), ("", [])])
def test_items_without_end_tags(spark, html, inside):
    assert column(spark, [html], lambda h: markup.items(h, "li", "each-item")) == [inside]


def random_list(pick, depth):
    """(markup, insides of its items in page order); end tags of items are left out here and there."""
    parts, insides = [], []
    for _ in range(pick.randrange(5)):
        inner, below = f"t{pick.randrange(9)}", []
        if depth and pick.random() < 0.4:
            more, below = random_list(pick, depth - 1)
            inner += more + pick.choice(["", "<p>u</p>"])
        wanted = pick.random() < 0.7
        insides += [inner] * wanted + below
        parts.append((ITEM if wanted else "<li>") + inner + pick.choice(["", "</li>"]))
    kind = pick.choice(["ul", "ol"])
    return f"<{kind}>{''.join(parts)}</{kind}>", insides


def test_items_of_random_lists(spark):
    samples = [random_list(random.Random(seed), 3) for seed in range(60)]
    assert column(spark, [h for h, _ in samples], lambda h: markup.items(h, "li", "each-item")) == [i for _, i in samples]


def test_drop_elements_edges(spark):
    pages = ["<nav>a", "</nav>a<nav>b</nav>c", "a<script>if(a<b){'</nav>'}</script>b", "x<nav/>y", "plain", "", "\x01<p>\x01<nav>\x01</nav>\x01",
             "<nav>a</nav><nav>b</nav>", "<navigation>k</navigation>", "<nav><form>x</nav>y"]
    got = column(spark, pages, lambda h: markup.drop_elements(h, ["nav", "form", "script"]))
    assert got == ["", "</nav>ac", "ab", "xy", "plain", "", "\x01<p>\x01\x01", "", "<navigation>k</navigation>", "y"]


def test_attributes(spark):
    tags = ['<a href="x">', "<a target href='y z'>", "<a data-href=n HREF = u>", "<a>", '<a title="href=\'q\'" href="r">',
            '<a href="a?b=1&amp;c=2">', "<a href=foo/>", '<a href="">', "<br/href=k>"]
    assert column(spark, tags, lambda t: markup.attribute(t, "href")) == [
        "x", "y z", "u", None, "r", "a?b=1&c=2", "foo/", "", "k"]
    classes = ['<p class="a title b">', '<p class="subtitle">', "<p class=title>", "<p>", "<p class='Title'>"]
    assert column(spark, classes, lambda t: markup.has_class(t, "title")) == [True, False, True, False, False]


def test_body_of(spark):
    pages = ["<html><head><title>t</title></head><body class=x>in</body></html>", "<p>x</p>",
             "<!DOCTYPE html><html><head><title>t</title></head><p>x</html>", "<body>a<body>b"]
    assert column(spark, pages, markup.body_of) == ["in", "<p>x</p>", "<p>x", "a<body>b"]


def test_entities_match_the_standard_library(spark):
    texts = ["a &amp; b &lt;x&gt; &#233;&#xE9; &eacute; &apos;&quot; &unknownname; & &;", "no", "&nbsp;", "&#128512;",
             "&hearts;&euro;"]
    assert column(spark, texts, markup.decode_entities) == [unescape(t) for t in texts]
    assert column(spark, ["&#55296;&#1114112;"], markup.decode_entities) == ["&#55296;&#1114112;"]


def test_text(spark):
    assert column(spark, ["<b>x</b> y", "plain <i>z</i>", "<br>t", "  <b>q</b>", "<b>only</b>", ""],
                  markup.leading_text) == [" y", "plain ", "t", "  ", "", ""]
    assert column(spark, ["<p>a</p><p>b</p>c<!-- n -->d", "  &nbsp;x ", "<p></p>"], markup.text_nodes) == [
        "a b c d", "x", ""]


def test_long_pages_do_not_exhaust_the_stack(spark):
    deep = "<div class='content'>" + "<div a b c=d>" * 5000 + "x" + "</div>" * 5000 + "</div>"
    words = "<div class='content'><p " + "w " * 50000 + ">" + "<b>t</b>" * 20000 + "</div>"
    inner = column(spark, [deep, words], lambda h: F.length(markup.first_subtree(h, "div", "content")), "v string")
    assert inner == [len(deep) - len("<div class='content'>") - 6, len(words) - len("<div class='content'>") - 6]
    assert column(spark, [words], lambda h: F.length(markup.text_nodes(h))) == [2 * 20000 - 1]


def random_page(rng, depth=0):
    """(page, page without nav and form, insides of the outermost content divs) of a random well-nested tree."""
    page, kept, parts = "", "", []
    for _ in range(rng.randint(0, 4)):
        choice = rng.randint(0, 6)
        if choice == 0 or depth > 4:
            text = rng.choice(["text", " a &amp; b ", "x > y", "é", "'quote\"", ""])
            page, kept = page + text, kept + text
        elif choice == 1:
            text = rng.choice(["<!-- <nav> <div class='content'> -->", "<script>if (a<b) '</nav></div>'</script>",
                               "<br>", "<img class=content src='a>b'/>"])
            page += text
            kept += "" if text.startswith("<script") else text
        else:
            name = rng.choice(["div", "nav", "form", "p", "DIV", "section"])
            attributes = rng.choice(["", " class=content", " id='n' class=\"big content\"", " title='<nav>'", " class='contents'",
                                     ' a data-x="1 > 0 <div class=content>" b=c'])
            inner, inner_kept, inner_parts = random_page(rng, depth + 1)
            opened, closed = f"<{name}{attributes}>", f"</{name}>"
            page += opened + inner + closed
            kept += "" if name in ("nav", "form") else opened + inner_kept + closed
            is_content = name.lower() == "div" and attributes.endswith(("=content", 'content"'))
            parts += [inner] if is_content else inner_parts
    return page, kept, parts


def test_random_trees(spark):
    import random
    rng = random.Random(11)
    samples = [random_page(rng) for _ in range(400)]
    pages = [s[0] for s in samples]
    assert sum(len(s[2]) > 1 for s in samples) > 10
    assert column(spark, pages, lambda h: markup.drop_elements(h, ["nav", "form", "script"])) == [s[1] for s in samples]
    assert column(spark, pages, lambda h: markup.subtrees(h, "div", "content")) == [s[2] for s in samples]
    assert column(spark, pages, lambda h: markup.first_subtree(h, "div", "content")) == [
        s[2][0] if s[2] else None for s in samples]
