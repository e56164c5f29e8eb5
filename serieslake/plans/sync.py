"""One ingestion run: compare a listing with the manifest, save the manifest, report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame

from serieslake.operators import manifest as M
from serieslake.plans.lake import Lake
from serieslake.schemas import MANIFEST
from serieslake.session import materialize

TABLE = "bronze.manifest"


class SyncFailed(Exception):
    """Some files could not be fetched; the manifest is saved, and their rows are as before."""


def plan(lake: Lake, listing: DataFrame, *, landed: DataFrame | None = None, sources: Sequence[str] | None = None) -> DataFrame:
    """What to do with each listed or known file; written out, as several steps read it."""
    M.check_listing(listing)
    if landed is not None:
        listing = M.with_landed(listing, landed)
    known = lake.read(TABLE, empty=MANIFEST)
    return materialize(M.plan_sync(known, listing, sources=sources), "sync-plan")


def finish(lake: Lake, planned: DataFrame, run_at: dt.datetime, *, fetched: DataFrame | None = None) -> DataFrame:
    """Save the manifest, then return the run's counts per source or raise ``SyncFailed``."""
    if fetched is not None:
        planned = materialize(M.with_fetched(planned, fetched), "sync-done")
    lake.publish(M.apply_sync(planned, run_at), TABLE, run_at=run_at)
    failed = M.failures(planned)
    if failed:
        raise SyncFailed(f"{failed} files could not be fetched")
    return M.run_summary(planned)
