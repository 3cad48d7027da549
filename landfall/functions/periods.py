"""Calendar windows: alignment, labels and tiling as date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Window sizes, with the trunc() unit and the step of each.
SIZES = {
    "monthly": ("MM", "INTERVAL 1 MONTH"),
    "weekly": ("WEEK", "INTERVAL 7 DAY"),
    "yearly": ("YEAR", "INTERVAL 1 YEAR"),
}


def check_size(size: str) -> str:
    if size not in SIZES:
        raise ValueError(f"Unsupported partition size: {size!r}")
    return size


def _by_size(size: Column | str, pick) -> Column:
    """One expression per size; a column selects per row and rejects unknown values."""
    if isinstance(size, str):
        return pick(check_size(size))
    branches = None
    for name in SIZES:
        branches = (F if branches is None else branches).when(size == name, pick(name))
    unknown = F.concat(F.lit("Unsupported partition size: "), F.coalesce(size, F.lit("null")))
    return branches.otherwise(F.raise_error(unknown))


def align(day: Column, size: Column | str) -> Column:
    """First day of the month, ISO week or year that ``day`` falls in."""
    return _by_size(size, lambda s: F.trunc(day, SIZES[s][0]))


def label(day: Column, size: Column | str) -> Column:
    """``2024-01``, ``2024-W05`` (ISO year and week) or ``2024``."""
    def text(s: str) -> Column:
        if s == "monthly":
            return F.date_format(day, "yyyy-MM")
        if s == "weekly":
            return F.format_string("%04d-W%02d", F.extract(F.lit("YEAROFWEEK"), day), F.weekofyear(day))
        return F.date_format(day, "yyyy")

    return _by_size(size, text)


def window_starts(start: Column, end: Column, size: Column | str) -> Column:
    """Array of aligned starts tiling the half-open range ``[start, end)``.

    Starts are aligned before stepping: stepping months from the 31st drifts.
    """
    def tile(s: str) -> Column:
        unit, step = SIZES[s]
        return F.sequence(F.trunc(start, unit), F.date_sub(end, 1), F.expr(step))

    return _by_size(size, tile)


def window_end(aligned: Column, size: Column | str) -> Column:
    """Last day of the window that starts on ``aligned``."""
    return _by_size(size, lambda s: F.date_sub((aligned + F.expr(SIZES[s][1])).cast("date"), 1))


def site_date(text: Column) -> Column:
    """Parse ``day/month/year`` after trimming; null when missing or invalid.

    The shape is checked first: the year must have four digits, and the
    date parser alone would accept a sign in front of it.
    """
    from landfall.functions.binding import strip_space

    clean = strip_space(text)
    return F.when(clean.rlike(r"^\d{1,2}/\d{1,2}/\d{4}\z"), F.try_to_date(clean, "d/M/yyyy"))
