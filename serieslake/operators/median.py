"""Exact medians of groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from serieslake.session import materialize

DIGIT_BITS = 13


def exact_median(df: DataFrame, keys: Sequence[str], units: str, *, scale: int = 0) -> DataFrame:
    """Exact median per key of a BIGINT column that counts units of ``10 ** -scale``.

    Spark's own ``median`` keeps the distinct values of a group in one task.  Here the two middle
    ranks are found digit by digit: each pass counts the next bits, 13 at most, of the values that share
    the bits found so far.  A pass is a scan with a partial aggregation, so a task passes
    on no more than 8,192 counts per middle rank, however many rows a group has.  Bits that all values
    of every group share take no pass; the whole range of BIGINT is allowed.

    Groups, their sizes and the ranks in search are written to the scratch folder; they
    are broadcast only if those files are below the broadcast threshold.  Each pass reads
    ``df`` again, so it should be a stored table.
    """
    whole = not keys
    keys = list(keys) or ["_all"]
    rows = df.withColumn("_all", F.lit(0)) if whole else df
    values = rows.filter(F.col(units).isNotNull()).select(*keys, F.col(units).cast("bigint").alias("_u"))
    groups = materialize(
        values.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_u").alias("_low"), F.max("_u").alias("_high")),
        "median-groups",
    )
    left = groups.agg(F.max(F.length(F.bin(F.col("_low").bitwiseXOR(F.col("_high")))))).first()[0] or 1
    middle = F.array_distinct(F.array(F.expr("(_n + 1) div 2"), F.expr("_n div 2 + 1")))
    shared = F.shiftright("_low", left) if left < 64 else F.lit(0).cast("bigint")
    ranks = groups.select(*keys, F.explode(middle).alias("_rank"), shared.alias("_found"))
    even = -(-left // -(-left // DIGIT_BITS))  # passes of equal width
    while left > 0:
        step = min(even, left)
        left -= step
        ranks = materialize(_next_digit(values, ranks, keys, left, step), "median-ranks")
    middles = (F.min("_found").cast("decimal(38,0)") + F.max("_found").cast("decimal(38,0)")).cast("double")
    found = ranks.groupBy(*keys).agg((middles / F.lit(2.0) / F.lit(float(10**scale))).alias("median"))
    return found.drop("_all") if whole else found


def _next_digit(values: DataFrame, ranks: DataFrame, keys: Sequence[str], below: int, step: int) -> DataFrame:
    """Extend each rank's found prefix by ``step`` bits, leaving ``below`` bits unknown."""
    probes = ranks.select(*keys, "_found").distinct().alias("p")
    rows = values.alias("v")
    same_prefix = F.shiftright("v._u", below + step) == F.col("p._found") if below + step < 64 else F.lit(True)
    counts = (
        rows.join(probes, _same(keys, "v", "p") & same_prefix)
        .groupBy(*[F.col(f"p.{k}").alias(k) for k in keys], F.col("p._found"), F.shiftright("v._u", below).alias("_next"))
        .agg(F.count("*").alias("_c"))
    )
    running = Window.partitionBy(*keys, "_found").orderBy("_next").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumn("_upto", F.sum("_c").over(running)).alias("c")
    here = (F.col("r._rank") > F.col("c._upto") - F.col("c._c")) & (F.col("r._rank") <= F.col("c._upto"))
    return (
        ranks.alias("r")
        .join(counts, _same(keys, "r", "c") & (F.col("r._found") == F.col("c._found")) & here)
        .select(
            *[F.col(f"r.{k}").alias(k) for k in keys],
            (F.col("r._rank") - (F.col("c._upto") - F.col("c._c"))).alias("_rank"),
            F.col("c._next").alias("_found"),
        )
    )


def _same(keys: Sequence[str], left: str, right: str) -> Column:
    return reduce(Column.__and__, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys], F.lit(True))
