"""Bring overlapping releases together: one row per key, the preferred release wins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from serieslake.functions import to_type

RANK = "_release_rank"
KEYS = ("series_id", "year", "period")
TIE_BREAK = ("value", "footnote_codes")


#: Published values have few decimals; sums of decimals are exact, so equal totals tie.
VALUE = "decimal(28,10)"


def observation_types(value: str = VALUE) -> dict[str, str]:
    return {"series_id": "string", "year": "int", "period": "string", "value": value, "footnote_codes": "string"}


def stack_releases(releases: Sequence[DataFrame]) -> DataFrame:
    """All rows of all releases, the most preferred release first in the list."""
    ranked = [df.withColumn(RANK, F.lit(rank)) for rank, df in enumerate(releases, start=1)]
    return reduce(DataFrame.unionByName, ranked)


def typed(df: DataFrame, types: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Trim and type text columns; unparsable text becomes NULL."""
    return df.select(*[to_type(name, dtype).alias(name) for name, dtype in types.items()], *keep)


def first_by(order: Sequence[str], prefer_present: str | None = None) -> list[Column]:
    """Sort columns for ``keep_first``; ``prefer_present`` puts rows with that column set first."""
    by = [F.col(name).asc_nulls_last() for name in order]
    return [F.col(prefer_present).isNull(), *by] if prefer_present else by


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key.

    Spark limits every key to one row per input partition before the shuffle, so a key
    that holds most rows arrives as a handful of candidates.
    """
    spot = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_spot", spot).filter("_spot = 1").drop("_spot")


def reconcile(
    releases: Sequence[DataFrame],
    *,
    types: Mapping[str, str] | None = None,
    keys: Sequence[str] = KEYS,
    tie_break: Sequence[str] = TIE_BREAK,
    prefer_present: str | None = None,
    by: str | None = None,
) -> DataFrame:
    """Union, type and deduplicate releases.

    With ``by``, one of the keys, the rows are distributed by it alone; then totals, best periods and joins by it
    shuffle no more.  Its values must be light (``layout.if_light``), as a task takes all rows of one.

    A preferred release wins even with a NULL value, unless ``prefer_present`` names the
    column that must be set.  Rows that repeat a key within one release are ordered by
    ``tie_break``, so the outcome does not depend on the order of the input.
    """
    rows = typed(stack_releases(releases), types or observation_types(), keep=[RANK])
    return keep_first(rows.repartition(by) if by else rows, keys, first_by([RANK, *tie_break], prefer_present)).drop(RANK)


def overlay(releases: Sequence[DataFrame], keys: Sequence[str] = KEYS) -> DataFrame:
    """``reconcile`` for typed releases that each hold a key at most once, and no NULL keys.

    Rows of a later release show where no earlier one has their key.  Nothing is sorted, and
    a large history is not shuffled as long as the keys that overlay it are small enough
    to broadcast.
    """
    rows, covered = releases[0], releases[0].select(*keys)
    for release in releases[1:]:
        rows = rows.unionByName(release.join(covered, list(keys), "left_anti"))
        covered = covered.unionAll(release.select(*keys))
    return rows
