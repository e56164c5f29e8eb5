"""How rows lie: distributed once by a key that all later steps group by, unless one key is too heavy for a task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A task sorts so many rows of one key, about a gigabyte of observations, without trouble.
MOST_ROWS = 10_000_000


def heaviest(tables: Sequence[DataFrame], key: str) -> int:
    """Rows of the most frequent key over all tables; only that column is read, and tasks count before they shuffle."""
    keys = reduce(DataFrame.unionByName, [table.select(F.trim(key).alias("key")) for table in tables])
    return keys.groupBy("key").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0


def if_light(tables: Sequence[DataFrame], key: str, most_rows: int = MOST_ROWS) -> str | None:
    """``key`` if none of its values has more than ``most_rows`` rows, else None: then steps shuffle by all of their own keys."""
    return key if heaviest(tables, key) <= most_rows else None
