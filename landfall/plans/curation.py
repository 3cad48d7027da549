"""A curation run: a date slice of the landing zone into the curated zone."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame

from landfall.operators import curate
from landfall.operators.frontier import check_range
from landfall.sources.staging import stage
from landfall.sources.zones import CuratedZone, LandingZone


def curate_range(landing: LandingZone, curated: CuratedZone, start: date, end: date, *,
                 run_seq: int | None = None) -> DataFrame:
    """Curate records published in ``[start, end)``; returns the one-row summary.

    Without ``run_seq`` the run takes the next number. A number belongs to its window: another
    window is refused it, the same one replaces what it wrote before.

    The cleaned rows are written once, with their bytes in a column of their
    own; metadata and the summary are read from that table without them.
    """
    check_range(start, end)
    run_seq = curated.claim(f"{start}..{end}" if run_seq is not None else f"{start}..{end} {uuid.uuid4().hex}", run_seq)
    chosen = stage(landing.current_between(start, end), "slice")
    rows, failures = curate.transform(chosen, landing.objects_for(chosen), curated.hashes(before=run_seq, asked=chosen))
    curated.write_run("curated", rows, run_seq)
    curated.write_run("curation_failures", failures, run_seq)
    return summary(curated, run_seq)


def summary(curated: CuratedZone, run_seq: int) -> DataFrame:
    """Counts of a finished curation run, from its tables."""
    return curate.summary(curated.read_run("curated", run_seq), curated.read_run("curation_failures", run_seq))
