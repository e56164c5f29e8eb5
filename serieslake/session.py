"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What a cluster job should run with.  Shuffle partitions are set high and left to
# adaptive execution to coalesce; skewed join partitions are split at run time even
# where that costs one more exchange.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # No call site per column expression; it makes building large plans slow.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

SHUFFLE_PARTITION = 256 << 20
# What a session is built for unless told: the largest single shuffle of a job.
SHUFFLE_BYTES, CORES = 1 << 40, 400


def sized_for(shuffle_bytes: int, cores: int, most: int | None = None) -> dict[str, str]:
    """Settings for jobs that shuffle up to ``shuffle_bytes`` at once on ``cores``.

    Adaptive execution joins shuffle partitions that turn out small but does not split those
    of an aggregation or window, so their number has to suit the largest shuffle.  ``most`` caps
    it where the bookkeeping of so many costs more than larger partitions that spill.
    """
    partitions = max(2 * cores, -(-shuffle_bytes // SHUFFLE_PARTITION))
    partitions = partitions if most is None else min(partitions, most)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_PARTITION // 2),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.files.maxPartitionBytes": str(SHUFFLE_PARTITION),
    }


_local_roots: dict[str, str] = {}


def build_session(
    app: str = "serieslake", master: str | None = None, *, shuffle_bytes: int = SHUFFLE_BYTES, cores: int = CORES, **extra: str
) -> SparkSession:
    """A session whose partitions suit shuffles of ``shuffle_bytes`` on ``cores``; ``extra`` overrides any setting."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **sized_for(shuffle_bytes, cores), **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may go without it; there a temporary folder stands in, one
    per application.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/serieslake"
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.conf.get("spark.app.id")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="serieslake-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch root; never handed out twice."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Jobs run herein remove their shuffle files when they end, rather than when the driver collects garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    This cuts the lineage so that a lost executor costs no recomputation, and it gives
    the optimizer the true size, so that a later join broadcasts only what is small.
    Nothing reads the shuffles behind a written table, so their files go at once.
    """
    path = scratch_path(df.sparkSession, label)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _literal(value: object) -> Column:
    if isinstance(value, list):
        return F.array(*[_literal(item) for item in value])
    if isinstance(value, tuple):
        return F.struct(*[_literal(item) for item in value])
    return F.lit(value)


def control_rows(spark: SparkSession, rows: Sequence[tuple], columns: dict[str, str]) -> DataFrame:
    """A handful of driver values (a log line, rule counts) as a one-partition DataFrame of literals."""
    names, dtypes = list(columns), list(columns.values())
    if not rows:
        return spark.range(0, 0, 1, 1).select(*[F.lit(None).cast(t).alias(n) for n, t in columns.items()])
    typed = [
        F.struct(*[_literal(v).cast(t).alias(n) for n, t, v in zip(names, dtypes, row, strict=True)]) for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*typed)))
