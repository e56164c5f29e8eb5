"""Answers over observations: totals, best period, range statistics, alignment, growth."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from serieslake.operators.reconcile import RANK, keep_first, observation_types, stack_releases, typed


def period_totals(
    observations: DataFrame, parts: Sequence[str], *, keys: Sequence[str] = ("series_id", "year"),
    period: str = "period", value: str = "value", total: str = "total_value",
) -> DataFrame:
    """Sum per key over the named parts.  An aggregate stored beside its parts is not a part."""
    return observations.filter(F.col(period).isin(*parts)).groupBy(*keys).agg(F.sum(value).alias(total))


def reconciled_totals(
    releases: Sequence[DataFrame], parts: Sequence[str], *, types: Mapping[str, str] | None = None,
    series: str = "series_id", year: str = "year", period: str = "period", value: str = "value",
    total: str = "total_value",
) -> DataFrame:
    """``period_totals`` over ``reconcile``, in one shuffle instead of two and without a sort.

    Per part and release it keeps whether there is a row, and the smallest value, which is
    what the tie-break of ``reconcile`` picks.  Those are plain numbers, so they are
    hash-aggregated before and after the shuffle, and all parts of a (series, year) meet in
    one row.
    """
    wanted = {n: t for n, t in (types or observation_types()).items() if n in (series, year, period, value)}
    rows = typed(stack_releases(releases), wanted, keep=[RANK])
    rows = rows.filter(F.col(series).isNotNull() & F.col(year).isNotNull() & F.col(period).isin(*parts))
    ranks = range(1, len(releases) + 1)
    found, winners = [], []
    for i, part in enumerate(parts):
        choice = F.lit(None)
        for rank in reversed(ranks):
            here = (F.col(period) == part) & (F.col(RANK) == rank)
            found += [
                F.max(F.when(here, F.lit(1))).alias(f"_any_{i}_{rank}"),
                F.min(F.when(here, F.col(value))).alias(f"_low_{i}_{rank}"),
            ]
            choice = F.when(F.col(f"_any_{i}_{rank}").isNotNull(), F.col(f"_low_{i}_{rank}")).otherwise(choice)
        winners.append(choice.alias(f"_part_{i}"))
    values = [F.col(f"_part_{i}") for i in range(len(parts))]
    added = reduce(Column.__add__, [F.coalesce(v, F.lit(0).cast("int")) for v in values])
    summed = F.when(F.coalesce(*values).isNotNull(), added)
    return rows.groupBy(series, year).agg(*found).select(series, year, *winners).select(series, year, summed.alias(total))


def best_period(
    totals: DataFrame, *, key: str = "series_id", period: str = "year", total: str = "total_value",
    best: str = "best_year",
) -> DataFrame:
    """Per key the period with the largest total; the earliest of equals; a NULL total comes last."""
    order = [F.col(total).desc_nulls_last(), F.col(period).asc()]
    return keep_first(totals, [key], order).select(key, F.col(period).alias(best), total)


def with_dimension(result: DataFrame, dimension: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Attach dimension columns; a key without a dimension row drops out."""
    return result.join(dimension.select(key, *columns), key, "inner")


def range_summary(
    df: DataFrame, *, year: str, value: str, first: int, last: int, where: Column | None = None,
    population: bool = False, measure: str = "population",
) -> DataFrame:
    """Count, mean and standard deviation of a yearly measure over an inclusive range.

    The deviation is the sample one unless ``population`` is set.  One row always: an
    empty range gives count 0 and NULLs.
    """
    rows = df.filter(F.col(year).between(first, last))
    if where is not None:
        rows = rows.filter(where)
    spread = F.stddev_pop(value) if population else F.stddev_samp(value)
    return rows.agg(
        F.count("*").alias("n_years"),
        F.avg(value).alias(f"mean_{measure}"),
        spread.alias(f"stddev_{measure}"),
    ).select(F.lit(first).alias("year_start"), F.lit(last).alias("year_end"), "*")


#: A yearly measure of so many rows is broadcast: some 30 MB in a task.
MOST_YEARLY_ROWS = 1_000_000


def aligned_series(
    observations: DataFrame, yearly: DataFrame, *, on: str = "year", columns: Sequence[str], measure: str,
    most_rows: int = MOST_YEARLY_ROWS, salts: int = 64,
) -> DataFrame:
    """Each observation with the outside measure of its year, NULL where that year has none.

    A year may hold a large part of all observations, so they are never shuffled by year alone.  The measure's rows are counted
    (keep it as a stored table); up to ``most_rows`` are broadcast, more are copied ``salts`` times and joined by year and salt.
    Order by year when reading: a stored table has no order.
    """
    side = yearly.select(F.col(on).alias("_on"), F.col(measure))
    if side.count() <= most_rows:
        return observations.join(F.broadcast(side), observations[on] == side["_on"], "left").select(*columns, measure)
    copies = side.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = observations.withColumn("_salt", F.pmod(F.xxhash64(*observations.columns), F.lit(salts)).cast("int"))
    same = (F.col(on) == F.col("_on")) & (F.col("_salt") == F.col("_copy"))
    return salted.join(copies, same, "left").select(*columns, measure)


def yearly_profile(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Count, sum, mean, minimum and maximum per key; sums of decimals, so exact in any order."""
    return df.groupBy(*keys).agg(
        F.count(value).alias("n"),
        F.sum(value).alias("total"),
        (F.sum(value).cast("double") / F.count(value)).alias("mean"),
        F.min(value).alias("smallest"),
        F.max(value).alias("largest"),
    )


def distribution(df: DataFrame, column: str, count: str = "n_series") -> DataFrame:
    """How many rows have each value."""
    return df.groupBy(column).agg(F.count("*").alias(count))


def growth(df: DataFrame, keys: Sequence[str], *, year: str, value: str) -> DataFrame:
    """Change of a measure between a key's first and last year, absolute and in percent."""
    known = df.filter(F.col(value).isNotNull())
    ends = known.groupBy(*keys).agg(
        F.min(year).alias("first_year"), F.max(year).alias("last_year"),
        F.min_by(value, year).alias("first_value"), F.max_by(value, year).alias("last_value"),
    )
    change = F.col("last_value") - F.col("first_value")
    percent = F.when(F.col("first_value") != 0, change * 100 / F.col("first_value"))
    return ends.select("*", change.alias("change"), percent.alias("change_pct"))


def parts_check(
    observations: DataFrame, parts: Sequence[str], aggregate: str, *, keys: Sequence[str] = ("series_id", "year"),
    period: str = "period", value: str = "value", tolerance: float = 0.0,
) -> DataFrame:
    """Compare a stored yearly average with the mean of its parts, in one pass.

    ``agrees`` is NULL where the aggregate or the parts are missing, or only some parts
    are present.
    """
    is_part = F.col(period).isin(*parts) & F.col(value).isNotNull()
    added = F.sum(F.when(is_part, F.col(value))).cast("double")
    rows = observations.filter(F.col(period).isin(*parts, aggregate)).groupBy(*keys).agg(
        F.count_if(is_part).alias("n_parts"),
        F.when(F.count_if(is_part) > 0, added / F.count_if(is_part)).alias("mean_of_parts"),
        F.max(F.when(F.col(period) == aggregate, F.col(value))).cast("double").alias("stored"),
    )
    comparable = (F.col("n_parts") == len(parts)) & F.col("stored").isNotNull()
    close = F.abs(F.col("stored") - F.col("mean_of_parts")) <= tolerance
    return rows.withColumn("agrees", F.when(comparable, close))
