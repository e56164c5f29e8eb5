"""The manifest of landed files: what is new, changed, unchanged, failed or gone."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from serieslake.functions import instant
from serieslake.operators.checks import duplicate_keys
from serieslake.operators.rules import RuleViolation
from serieslake.schemas import MANIFEST

KEY = ("source", "relative_path")
ACTIVE, REMOVED = "active", "removed"
NEW, CHANGED, SKIPPED, FAILED, GONE, KEPT = "new", "changed", "skipped", "failed", "removed", "kept"

_OPTIONAL = {"content_hash": "string", "content_bytes": "bigint", "landed": "boolean", "failed": "boolean"}


def _complete(listing: DataFrame) -> DataFrame:
    """Add the optional listing columns that are absent."""
    absent = {n: F.lit(None).cast(t) for n, t in _OPTIONAL.items() if n not in listing.columns}
    return listing.withColumns(absent) if absent else listing


def with_landed(listing: DataFrame, landed: DataFrame) -> DataFrame:
    """Mark which listed files have a landed copy; ``landed`` holds (source, relative_path)."""
    present = landed.select(*KEY).distinct().withColumn("landed", F.lit(True))
    return listing.join(present, list(KEY), "left").withColumn("landed", F.coalesce("landed", F.lit(False)))


def check_listing(listing: DataFrame) -> None:
    """A file listed twice would be synced twice; raise instead."""
    _once(listing, "listed")


def _once(files: DataFrame, what: str) -> None:
    twice = duplicate_keys(files, KEY).limit(1).collect()
    if twice:
        raise RuleViolation(f"{what} more than once: {twice[0]['source']}/{twice[0]['relative_path']}")


def _differs() -> Column:
    """Whether a listed file differs from what the manifest knows of it.

    The content hash decides if the listing has one.  Otherwise size and time decide, each
    only as far as the listing states it.
    """
    by_hash = ~F.col("l.content_hash").eqNullSafe(F.col("m.content_hash"))
    by_stat = (F.col("l.size_bytes").isNotNull() & ~F.col("l.size_bytes").eqNullSafe(F.col("m.size_bytes"))) | (
        F.col("l.last_modified").isNotNull() & ~F.col("l.last_modified").eqNullSafe(F.col("m.last_modified"))
    )
    return F.when(F.col("l.content_hash").isNotNull(), by_hash).otherwise(by_stat)


def plan_sync(manifest: DataFrame, listing: DataFrame, *, sources: Sequence[str] | None = None) -> DataFrame:
    """One full outer join gives every file its action.

    ``listing`` has source, relative_path, remote_url, size_bytes, last_modified, and
    optionally content_hash, landed (is the copy there) and failed (could not be fetched).
    Only files of ``sources`` (default: all) can be found removed.
    """
    joined = manifest.alias("m").join(
        _complete(listing).alias("l"),
        (F.col("m.source") == F.col("l.source")) & (F.col("m.relative_path") == F.col("l.relative_path")),
        "full_outer",
    )
    listed, known = F.col("l.source").isNotNull(), F.col("m.source").isNotNull()
    stale = (
        ~known | (F.col("m.status") != ACTIVE) | _differs() | ~F.coalesce(F.col("l.landed"), F.lit(True))
    )
    in_scope = F.lit(True) if sources is None else F.col("m.source").isin(*sources)
    action = (
        F.when(~listed & (F.col("m.status") == ACTIVE) & in_scope, GONE)
        .when(~listed, KEPT)
        .when(~stale, SKIPPED)
        .when(F.coalesce(F.col("l.failed"), F.lit(False)), FAILED)
        .when(~known, NEW)
        .otherwise(CHANGED)
    )
    return joined.select(
        F.coalesce("m.source", "l.source").alias("source"),
        F.coalesce("m.relative_path", "l.relative_path").alias("relative_path"),
        action.alias("action"),
        F.when(known, F.struct("m.*")).alias("before"),
        F.when(listed, F.struct("l.*")).alias("listed"),
    )


def with_fetched(plan: DataFrame, fetched: DataFrame) -> DataFrame:
    """Enter what was fetched: (source, relative_path, content_hash, content_bytes).

    A file that was to be fetched and is not there has failed; one that is there twice is an error.
    """
    _once(fetched, "fetched")
    got = fetched.select(
        *KEY, F.struct("content_hash", "content_bytes", F.lit(True).alias("done")).alias("_got")
    )
    due = F.col("action").isin(NEW, CHANGED)
    entered = F.col("listed").withField("content_hash", F.col("_got.content_hash")).withField(
        "content_bytes", F.col("_got.content_bytes").cast("bigint")
    )
    return plan.join(got, list(KEY), "left").select(
        *KEY,
        F.when(due & F.col("_got.done").isNull(), FAILED).otherwise(F.col("action")).alias("action"),
        "before",
        F.when(due & F.col("_got.done").isNotNull(), entered).otherwise(F.col("listed")).alias("listed"),
    )


def apply_sync(plan: DataFrame, run_at: dt.datetime) -> DataFrame:
    """The manifest after a run: first_seen_at never moves, nothing is deleted.

    A failed file keeps its row as it was, and a failed new file gets none.
    """
    now = instant(run_at)
    action = F.col("action")
    fetched = action.isin(NEW, CHANGED)
    seen = fetched | (action == SKIPPED)

    def when_seen(field: str) -> Column:
        return F.when(seen, F.col(f"listed.{field}")).otherwise(F.col(f"before.{field}"))

    hashed = F.when(fetched, F.coalesce("listed.content_hash", "before.content_hash")).otherwise(F.col("before.content_hash"))
    size = F.when(fetched, F.coalesce("listed.size_bytes", "listed.content_bytes")).otherwise(when_seen("size_bytes"))
    columns = {
        "source": F.col("source"),
        "relative_path": F.col("relative_path"),
        "remote_url": when_seen("remote_url"),
        "size_bytes": size,
        "last_modified": when_seen("last_modified"),
        "content_hash": hashed,
        "status": F.when(seen, ACTIVE).when(action == GONE, REMOVED).otherwise(F.col("before.status")),
        "first_seen_at": F.coalesce("before.first_seen_at", now),
        "last_seen_at": F.when(seen, now).otherwise(F.col("before.last_seen_at")),
        "last_ingested_at": F.when(fetched, now).otherwise(F.col("before.last_ingested_at")),
    }
    kept = plan.filter(~((action == FAILED) & F.col("before").isNull()))
    return kept.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in MANIFEST.fields])


def to_fetch(plan: DataFrame) -> DataFrame:
    """Files to land in this run."""
    return plan.filter(F.col("action").isin(NEW, CHANGED)).select("source", "relative_path", "listed.remote_url")


def run_summary(plan: DataFrame) -> DataFrame:
    """Counts per source: listed, new, changed, skipped, failed, removed."""
    count = lambda *actions: F.count_if(F.col("action").isin(*actions))
    return plan.groupBy("source").agg(
        F.count_if(F.col("listed").isNotNull()).alias("n_listed"),
        *[count(a).alias(f"n_{a}") for a in (NEW, CHANGED, SKIPPED, FAILED, GONE)],
        (F.count_if(F.col("before.status") == ACTIVE)).alias("active_before"),
        (F.count_if(F.col("before.status") == ACTIVE) - count(GONE)
         + F.count_if(F.col("action").isin(NEW, CHANGED) & ~F.col("before.status").eqNullSafe(ACTIVE))
         ).alias("active_after"),
    )


def failures(plan: DataFrame) -> int:
    """How many files could not be fetched; save the manifest first, then let the run fail on it."""
    return plan.filter(F.col("action") == FAILED).count()
