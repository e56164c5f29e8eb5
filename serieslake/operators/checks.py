"""Checks on whole inputs: headers, freshness, duplicate keys."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from serieslake.functions import instant
from serieslake.sources.files import list_files, store_of


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; counted before the shuffle."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


LONGEST_HEADER = 1 << 20


def _first_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def first_line(uri: str) -> str:
        store, path = store_of(uri)
        line = b""
        with store.open_input_stream(path) as stream:  # decompresses by the name's ending
            while b"\n" not in line:
                if len(line) > LONGEST_HEADER:
                    raise ValueError(f"{uri}: no line break within {LONGEST_HEADER} bytes")
                block = stream.read(1 << 16)
                if not block:
                    break
                line += block
        return line.split(b"\n", 1)[0].rstrip(b"\r").decode("utf-8", "replace")

    for batch in batches:
        yield batch.assign(header=[first_line(uri) for uri in batch["path"]])


def headers(spark: SparkSession, root: str, *, glob: str | None = None, sep: str = "\t") -> DataFrame:
    """The header fields of every file below ``root`` that a scan reads; only the first line of a file is read."""
    files = list_files(spark, root, glob=glob, hidden=False).filter("size_bytes > 0").select("path", "relative_path")
    lines = files.mapInPandas(_first_lines, "path string, relative_path string, header string")
    fields = F.transform(F.split("header", sep), lambda name: F.lower(F.trim(name)))
    return lines.select("relative_path", fields.alias("found"))


def drift_report(found: DataFrame, declared: T.StructType) -> DataFrame:
    """Per file: columns that are missing, extra, or in another order than declared."""
    expected = F.array(*[F.lit(f.name.lower()) for f in declared.fields])
    shared_found = F.filter("found", lambda n: F.array_contains(expected, n))
    shared_expected = F.filter(expected, lambda n: F.array_contains("found", n))
    return found.select(
        "relative_path",
        F.array_join(F.array_except(expected, "found"), ",").alias("missing"),
        F.array_join(F.array_except("found", expected), ",").alias("extra"),
        (shared_found != shared_expected).alias("reordered"),
        (F.col("found") != expected).alias("drifted"),
    )


def freshness(
    df: DataFrame, key: str, at: str, run_at: dt.datetime, *, limit: dt.timedelta
) -> DataFrame:
    """Per source the newest timestamp, its age at ``run_at`` in seconds, and whether it is too old."""
    newest = df.groupBy(key).agg(F.max(at).alias("newest"))
    age = F.timestamp_diff("SECOND", F.col("newest").cast("timestamp"), instant(run_at))
    return newest.withColumn("age_seconds", age).withColumn(
        "stale", F.coalesce(F.col("age_seconds") > int(limit.total_seconds()), F.lit(True))
    )
