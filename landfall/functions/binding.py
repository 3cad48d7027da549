"""Small helpers for building larger column expressions."""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F

_names = count()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use the result several times in ``body``.

    Without the binding, an expression mentioned n times is evaluated n times
    whenever it sits inside a lambda or a conditional branch, where common
    subexpressions are not shared.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def let_sql(value: Column, body: Callable[[str], str]) -> Column:
    """``let`` with a body written as SQL text; it gets the name bound to the value.

    Deeply nested higher-order functions are much cheaper to send to the JVM as
    one text than node by node.
    """
    name = f"b{next(_names)}"
    return F.element_at(F.call_function("transform", F.array(value), F.expr(f"{name} -> {body(name)}")), 1)


def bind(value: str, body: Callable[[str], str]) -> str:
    """``let`` within SQL text."""
    name = f"b{next(_names)}"
    return f"element_at(transform(array({value}), {name} -> {body(name)}), 1)"


def quote(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def blank_to_null(value: Column) -> Column:
    """Null for the empty string, so that ``coalesce`` treats it as missing."""
    return F.nullif(value, F.lit(""))


def first_present(*values: Column) -> Column:
    """First value that is neither null nor the empty string (null if none is)."""
    return F.coalesce(*(blank_to_null(v) for v in values))


# Unicode white space as str.strip() sees it: the White_Space property plus the
# four ASCII separators 0x1c-0x1f.
_SPACE = r"[\s\x1c-\x1f]"
EDGE_SPACE = rf"(?U)^{_SPACE}++|{_SPACE}++\z"


def strip_space(value: Column) -> Column:
    """Trim Unicode white space from both ends."""
    return F.regexp_replace(value, EDGE_SPACE, "")


def collapse_space(value: Column) -> Column:
    """Replace every run of Unicode white space by one blank."""
    return F.regexp_replace(value, rf"(?U){_SPACE}++", " ")


def tighten_hyphens(value: Column) -> Column:
    """Remove white space on either side of a hyphen."""
    return F.regexp_replace(value, rf"(?U){_SPACE}*+-{_SPACE}*+", "-")
