"""HTML subtrees as column expressions: no explode, no shuffle, no UDF.

A page is cut at the tags that matter (a *boundary* pattern) into text runs and
tags. One pass over the few boundary tags with a running depth finds the
subtrees, and the remaining pieces are joined again. The state of the pass is a
handful of integers plus one entry per subtree found.

Subtrees are source slices: nothing is re-serialised, entities and attribute
quoting stay as they were. An element that is never closed reaches to the end
of the page; stray closing tags are ignored. List items may omit their end
tags: these are cut with a stack of the open lists and containers.

The functions named ``sql_*`` map SQL text to SQL text, so that nested use stays
one text; the others take and return columns.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from html.entities import name2codepoint

from pyspark.sql import Column

from landfall.functions.binding import EDGE_SPACE, bind, let_sql, quote

# Attribute part of a tag. Quotes only count after "=", so that a stray
# apostrophe cannot swallow the page; possessive loops do not use the stack.
_ATTRIBUTES = r"""(?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+"""
# Comments, scripts and styles are taken whole: tags inside them are text. Without an end they reach to the end of the page.
_OPAQUE = rf"<!--.*?-->|<(?:script(?=[\s/>]){_ATTRIBUTES}>.*?(?:</script\s*+>|\z)|style(?=[\s/>]){_ATTRIBUTES}>.*?(?:</style\s*+>|\z))"
# Any tag with "<" in a quoted value, taken whole as well: the value may look like a tag.
_QUOTING = (r"""<[a-z](?:[^>=]++|=\s*+"[^"<]*+"|=\s*+'[^'<]*+'|=(?!\s*+["']))*+=\s*+(?:"[^"]*+"|'[^']*+')"""
            rf"{_ATTRIBUTES}>")
ANY_TAG = rf"(?is){_OPAQUE}|</?[a-z]{_ATTRIBUTES}>"
# One name=value pair of a tag, starting at an attribute boundary.
_PAIR = r"""(?s)(?<=[\s"'/])[^\s"'<>/=]++\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)"""
_REFERENCE = r"&(?:#0*[0-9]{1,7}|#[xX]0*[0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,31});"
_ENTITIES = ",".join(f"{name}:{code}" for name, code in {**name2codepoint, "apos": 39}.items())

# Elements that never have content.
_VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")

# Containers that an item may be in, and how strong they are: no end tag reaches over a stronger one.
_CONTAINERS = {"ul": 100, "ol": 100, "menu": 100, "dir": 100, "div": 150, "td": 160, "table": 190}
_WEAK = 100
_SPANS = 100


def _words(values: Sequence[str]) -> str:
    return ", ".join(map(quote, values))


def boundary(*names: str) -> str:
    """Pattern for the opening and closing tags of ``names`` (and parts that may hide some)."""
    return rf"(?is){_OPAQUE}|</?(?:{'|'.join(names)})(?=[\s/>]){_ATTRIBUTES}>|{_QUOTING}"


# --- SQL text ---------------------------------------------------------------


def sql_find_all(text: str, pattern: str) -> str:
    return f"regexp_extract_all({text}, {quote(pattern)}, 0)"


def sql_tag_name(tag: str) -> str:
    pattern = quote(r"^</?([a-zA-Z][^\s/>]*)")
    return f"lower(regexp_extract({tag}, {pattern}, 1))"


def sql_decode_entities(text: str) -> str:
    def character(ref: str) -> str:
        code = (
            f"CASE WHEN lower(left({ref}, 3)) = '&#x' THEN CAST(conv(substring({ref}, 4, length({ref}) - 4), 16, 10) AS INT)"
            f" WHEN left({ref}, 2) = '&#' THEN CAST(substring({ref}, 3, length({ref}) - 3) AS INT)"
            f" ELSE CAST(try_element_at(str_to_map({quote(_ENTITIES)}), substring({ref}, 2, length({ref}) - 2)) AS INT) END"
        )
        return bind(code, lambda c: (
            f"IF({c} > 0 AND {c} <= 1114111 AND {c} NOT BETWEEN 55296 AND 57343,"
            f" decode(unhex(lpad(hex({c}), 8, '0')), 'UTF-32'), {ref})"))

    def replaced(plain: str) -> str:
        refs = f"transform({sql_find_all(plain, _REFERENCE)}, ref -> {character('ref')})"
        runs = f"split({plain}, {quote(_REFERENCE)}, -1)"
        return f"array_join(flatten(zip_with({runs}, {refs}, (run, ref) -> array(run, ref))), '')"

    return bind(text, lambda plain: f"IF(contains({plain}, '&'), {replaced(plain)}, {plain})")


def sql_attribute(tag: str, name: str) -> str:
    named = quote(rf"(?i)\A{name}\s*+=")
    pair = f"get(filter({sql_find_all(tag, _PAIR)}, pair -> pair RLIKE {named}), 0)"
    before_value = quote(r"(?s)\A[^=]*+=\s*+")
    return bind(f"regexp_replace({pair}, {before_value}, '')", lambda raw: sql_decode_entities(
        f"IF(left({raw}, 1) IN ('\"', '\\''), substring({raw}, 2, length({raw}) - 2), {raw})"))


def sql_classes(tag: str) -> str:
    return f"split(coalesce({sql_attribute(tag, 'class')}, ''), '\\\\s+')"


def sql_has_class(tag: str, name: str) -> str:
    return f"array_contains({sql_classes(tag)}, {quote(name)})"


def _sql_describe(tag: str, hit: Callable[[str, str], str]) -> str:
    """Struct of a tag's ``name``, ``step`` (1 opens, -1 closes, 0 neither) and whether it is an opening tag that is looked for."""
    def build(name: str) -> str:
        whole = f"({name} IN ('', 'script', 'style', {_words(_VOID)}) OR endswith({tag}, '/>'))"
        return (
            f"named_struct('name', {name},"
            f" 'step', CASE WHEN startswith({tag}, '</') THEN -1 WHEN {whole} THEN 0 ELSE 1 END,"
            f" 'hit', IF(startswith({tag}, '</') OR {name} = '', false, {hit(name, tag)}))"
        )

    return bind(sql_tag_name(tag), build)


def _sql_cut(html: str, pattern: str, hit: Callable[[str, str], str],
             use: Callable[[str, str, str], str], only_first: bool = False) -> str:
    """Find the outermost subtrees whose opening tag satisfies ``hit(name, tag)``.

    ``use(page, pieces, spans)`` gets the page, the alternating array run, tag,
    run, ... and the spans as tag numbers (1-based, opening and closing tag). Tag
    n sits at position 2n of ``pieces``.
    """
    def state(name: str = "s.name", depth: str = "s.depth", first: str = "s.first", spans: str = "s.spans") -> str:
        return (f"named_struct('at', s.at + 1, 'name', {name}, 'depth', {depth}, 'first', {first}, 'spans', {spans})")

    def and_span(first: str, last: str) -> str:
        return f"array_append(s.spans, named_struct('first', {first}, 'last', {last}))"

    start = ("named_struct('at', 0, 'name', '', 'depth', 0, 'first', 0,"
             " 'spans', CAST(array() AS ARRAY<STRUCT<first: INT, last: INT>>))")
    wanted = "tag.hit AND size(s.spans) = 0" if only_first else "tag.hit"
    advance = (
        f"CASE WHEN s.depth = 0 AND NOT ({wanted}) THEN {state()}"
        f" WHEN s.depth = 0 AND tag.step = 0 THEN {state(spans=and_span('s.at + 1', 's.at + 1'))}"
        f" WHEN s.depth = 0 THEN {state(name='tag.name', depth='1', first='s.at + 1')}"
        f" WHEN tag.name <> s.name THEN {state()}"
        f" WHEN s.depth + tag.step = 0 THEN {state(depth='0', spans=and_span('s.first', 's.at + 1'))}"
        f" ELSE {state(depth='s.depth + tag.step')} END"
    )
    finish = f"IF(s.depth > 0, {and_span('s.first', 's.at + 1')}, s.spans)"

    def outermost(described: str) -> str:
        return f"aggregate({described}, {start}, (s, tag) -> {advance}, s -> {finish})"

    def scan(page: str, pieces: str) -> str:
        tags = f"filter({pieces}, (piece, n) -> n % 2 = 1)"
        described = f"transform({tags}, t -> {_sql_describe('t', hit)})"
        return bind(outermost(described), lambda found: use(page, pieces, found))

    return bind(html, lambda page: bind(_sql_pieces(page, pattern), lambda pieces: scan(page, pieces)))


def _sql_items(html: str, element: str, hit: Callable[[str, str], str], use: Callable[[str, str, str], str]) -> str:
    """Find all subtrees of an element whose end tag may be omitted, in order of their opening tags.

    One pass with a stack of open elements: an ``element`` ends the one it follows directly, and an end tag ends all that
    is open inside its own element. An end tag without one, or behind a stronger container, is ignored.
    """
    no_spans = "CAST(array() AS ARRAY<STRUCT<first: INT, last: INT>>)"
    strength = " ".join(f"WHEN {quote(name)} THEN {rank}" for name, rank in _CONTAINERS.items())

    def rank(name: str) -> str:
        return f"CASE {name} {strength} ELSE {_WEAK} END"

    def keep(last: str) -> str:
        """How many open elements a tag leaves open; ``last`` is the place of the last one of its name."""
        barred = f"exists(slice(s.open, {last} + 1, size(s.open) - {last}), o -> o.rank > {rank('tag.name')})"
        return (f"CASE WHEN tag.step > 0 AND tag.name = {quote(element)} AND {last} = size(s.open) AND {last} > 0 THEN {last} - 1"
                f" WHEN tag.step < 0 AND {last} > 0 AND NOT {barred} THEN {last} - 1 ELSE size(s.open) END")

    def ended(from_: str) -> str:
        return (f"transform(filter(slice(s.open, {from_} + 1, size(s.open) - {from_}), o -> o.hit),"
                " o -> named_struct('first', o.first, 'last', s.at + 1))")

    def after(opened: str, spans: Callable[[], str]) -> str:
        # Spans are put aside in blocks, so that none is copied for every later one.
        aside = f"IF(size(s.spans) < {_SPANS}, s.aside, array_append(s.aside, s.spans))"
        kept = bind(f"IF(size(s.spans) < {_SPANS}, s.spans, {no_spans})", lambda rest: spans().replace("s.spans", rest))
        return f"named_struct('at', s.at + 1, 'open', {opened}, 'spans', {kept}, 'aside', {aside})"

    def step(kept: str) -> str:
        opened = f"array(named_struct('name', tag.name, 'rank', {rank('tag.name')}, 'first', s.at + 1, 'hit', tag.hit))"
        left = f"IF({kept} = size(s.open), s.open, slice(s.open, 1, {kept}))"
        return after(f"IF(tag.step > 0, concat({left}, {opened}), {left})",
                     lambda: f"IF({kept} = size(s.open), s.spans, concat(s.spans, {ended(kept)}))")

    position = "array_position(reverse(transform(s.open, o -> o.name)), tag.name)"
    last = f"CAST(IF({position} > 0, size(s.open) + 1 - {position}, 0) AS INT)"
    single = after("s.open", lambda: "array_append(s.spans, named_struct('first', s.at + 1, 'last', s.at + 1))")
    other = "named_struct('at', s.at + 1, 'open', s.open, 'spans', s.spans, 'aside', s.aside)"
    start = ("named_struct('at', 0, 'open', CAST(array() AS ARRAY<STRUCT<name: STRING, rank: INT, first: INT, hit: BOOLEAN>>),"
             f" 'spans', {no_spans}, 'aside', CAST(array() AS ARRAY<ARRAY<STRUCT<first: INT, last: INT>>>))")
    advance = f"CASE WHEN tag.step <> 0 THEN {bind(last, lambda at: bind(keep(at), step))} WHEN tag.hit THEN {single} ELSE {other} END"
    finish = f"array_sort(flatten(array_append(s.aside, concat(s.spans, {ended('0')}))))"

    def scan(page: str, pieces: str) -> str:
        tags = f"filter({pieces}, (piece, n) -> n % 2 = 1)"
        spans = f"aggregate(transform({tags}, t -> {_sql_describe('t', hit)}), {start}, (s, tag) -> {advance}, s -> {finish})"
        return bind(spans, lambda found: use(page, pieces, found))

    pattern = boundary(element, *_CONTAINERS)
    return bind(html, lambda page: bind(_sql_pieces(page, pattern), lambda pieces: scan(page, pieces)))


def _sql_pieces(page: str, pattern: str) -> str:
    """Alternating text runs and tags.

    Tags are fenced by a control character and the page is split there: the
    pattern runs once. Pages that contain the character are matched twice.
    """
    fence = quote("\x01")
    runs, tags = f"split({page}, {quote(pattern)}, -1)", sql_find_all(page, pattern)
    fenced = f"regexp_replace({page}, {quote(pattern)}, concat({fence}, '$0', {fence}))"
    return (f"IF(contains({page}, {fence}), flatten(zip_with({runs}, {tags}, (run, tag) -> array(run, tag))),"
            f" split({fenced}, {fence}, -1))")


def _sql_between(pieces: str, first: str, last: str) -> str:
    return f"array_join(slice({pieces}, {first}, greatest({last} - ({first}) + 1, 0)), '')"


def _sql_inside(pieces: str, span: str) -> str:
    return _sql_between(pieces, f"{span}.first * 2 + 1", f"{span}.last * 2 - 1")


def sql_drop_subtrees(html: str, pattern: str, hit: Callable[[str, str], str]) -> str:
    def keep(page: str, pieces: str, spans: str) -> str:
        edge = "named_struct('first', 0, 'last', 0)"
        end = f"named_struct('first', CAST((size({pieces}) + 1) / 2 AS INT), 'last', 0)"
        gap = _sql_between(pieces, "l.last * 2 + 1", "r.first * 2 - 1")
        gaps = f"zip_with(array_prepend({spans}, {edge}), array_append({spans}, {end}), (l, r) -> {gap})"
        return f"IF(size({spans}) = 0, {page}, array_join({gaps}, ''))"

    return _sql_cut(html, pattern, hit, keep)


def _sql_is(element: str, css_class: str) -> Callable[[str, str], str]:
    return lambda name, tag: f"IF({name} = {quote(element)}, {sql_has_class(tag, css_class)}, false)"


def sql_drop_elements(html: str, names: Sequence[str]) -> str:
    return sql_drop_subtrees(html, boundary(*names), lambda name, tag: f"{name} IN ({_words(names)})")


def sql_first_subtree(html: str, element: str, css_class: str) -> str:
    return _sql_cut(html, boundary(element), _sql_is(element, css_class),
                    lambda page, pieces, spans: f"IF(size({spans}) > 0, "
                    + bind(f"get({spans}, 0)", lambda span: _sql_inside(pieces, span)) + ", NULL)", only_first=True)


def sql_subtrees(html: str, element: str, css_class: str) -> str:
    return _sql_cut(html, boundary(element), _sql_is(element, css_class),
                    lambda page, pieces, spans: f"transform({spans}, span -> {_sql_inside(pieces, 'span')})")


def sql_items(html: str, element: str, css_class: str) -> str:
    return _sql_items(html, element, _sql_is(element, css_class),
                      lambda page, pieces, spans: f"transform({spans}, span -> {_sql_inside(pieces, 'span')})")


def sql_body_of(html: str) -> str:
    tag = rf"(?=[\s/>]){_ATTRIBUTES}>"
    around = quote(rf"(?is)<!doctype[^>]*+>|<head{tag}.*?</head\s*+>|</?(?:html|body){tag}")
    before, after = quote(rf"(?is)\A.*?<body{tag}"), quote(r"(?is)</body\s*+>(?:(?!</body\b).)*+\z")
    has_body = quote(r"(?i)<body[\s/>]")
    return bind(html, lambda page: (
        f"IF({page} RLIKE {has_body}, regexp_replace(regexp_replace({page}, {before}, ''), {after}, ''),"
        f" regexp_replace({page}, {around}, ''))"))


def sql_opening_tags(html: str, element: str) -> str:
    found = sql_find_all(html, rf"(?is){_OPAQUE}|<{element}(?=[\s/>]){_ATTRIBUTES}>|{_QUOTING}")
    return f"filter({found}, tag -> {sql_tag_name('tag')} = {quote(element)})"


def sql_strip(text: str) -> str:
    return f"regexp_replace({text}, {quote(EDGE_SPACE)}, '')"


def sql_all_text(html: str) -> str:
    """All text of a fragment, one blank where markup separated it, untrimmed."""
    markup = rf"(?:<!--.*?-->|</?[a-z!]{_ATTRIBUTES}>)++"
    edges, inner = quote(rf"(?is)\A{markup}|{markup}\z"), quote(rf"(?is){markup}")
    return sql_decode_entities(f"regexp_replace(regexp_replace({html}, {edges}, ''), {inner}, ' ')")


def sql_text_nodes(html: str) -> str:
    return sql_strip(sql_all_text(html))


def sql_leading_text(inner: str) -> str:
    child = rf"<!--.*?-->|<([a-z][^\s/>]*+)(?=[\s/>]){_ATTRIBUTES}>.*?</\1\s*+>|</?[a-z]{_ATTRIBUTES}>"
    pattern = quote(rf"(?is)\A(?:{child})*+([^<]++)")
    return sql_decode_entities(f"regexp_extract({inner}, {pattern}, 2)")


# --- columns ----------------------------------------------------------------


def tag_name(tag: Column) -> Column:
    """Element name in lower case; ``''`` for a comment."""
    return let_sql(tag, sql_tag_name)


def attribute(tag: Column, name: str) -> Column:
    """Decoded value of an attribute of an opening tag, null if absent."""
    return let_sql(tag, lambda t: sql_attribute(t, name))


def has_class(tag: Column, name: str) -> Column:
    """Whether an opening tag carries the class (case-sensitive, as in CSS)."""
    return let_sql(tag, lambda t: sql_has_class(t, name))


def drop_elements(html: Column, names: Sequence[str]) -> Column:
    """The page without the given elements and everything inside them."""
    return let_sql(html, lambda h: sql_drop_elements(h, names))


def first_subtree(html: Column, element: str, css_class: str) -> Column:
    """Markup inside the first ``element`` with the class; null if there is none."""
    return let_sql(html, lambda h: sql_first_subtree(h, element, css_class))


def subtrees(html: Column, element: str, css_class: str) -> Column:
    """Markup inside every outermost ``element`` with the class, in page order."""
    return let_sql(html, lambda h: sql_subtrees(h, element, css_class))


def items(html: Column, element: str, css_class: str) -> Column:
    """Markup inside every ``element`` with the class, in page order, ones inside others included; end tags may be omitted."""
    return let_sql(html, lambda h: sql_items(h, element, css_class))


def body_of(html: Column) -> Column:
    """Inside of ``<body>``; a page without one loses doctype, head and html tags."""
    return let_sql(html, sql_body_of)


def opening_tags(html: Column, element: str) -> Column:
    """Opening tags of ``element`` outside comments and scripts, in page order."""
    return let_sql(html, lambda h: sql_opening_tags(h, element))


def text_nodes(html: Column) -> Column:
    """All text of a fragment, one blank where markup separated it, trimmed."""
    return let_sql(html, sql_text_nodes)


def leading_text(inner: Column) -> Column:
    """First text that is a direct child: child elements in front of it are skipped."""
    return let_sql(inner, sql_leading_text)


def decode_entities(text: Column) -> Column:
    """Replace character references; unknown names stay as they are."""
    return let_sql(text, sql_decode_entities)
