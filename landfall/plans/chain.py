"""Ingest, then curate the same range."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from landfall.plans.curation import curate_range
from landfall.plans.ingest import ingest
from landfall.sources.zones import CuratedZone, LandingZone


def ingest_and_curate(listings: DataFrame, fetches: DataFrame, landing: LandingZone, curated: CuratedZone,
                      start: date, end: date, *, run_id: str, run_seq: int,
                      recheck: bool = False, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(reconciliation, curation summary). Curation runs only after ingest succeeded."""
    reconciliation = ingest(listings, fetches, landing, run_id=run_id, run_seq=run_seq, recheck=recheck, limit=limit)
    return reconciliation, curate_range(landing, curated, start, end, run_seq=run_seq)
