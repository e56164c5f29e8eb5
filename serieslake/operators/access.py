"""Column masks and row filters for readers of the published tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mask_columns(df: DataFrame, columns: Sequence[str], *, salt: str) -> DataFrame:
    """Replace values by a salted digest: still joinable and countable, no longer readable."""
    digest = {c: F.sha2(F.concat(F.lit(salt), F.col(c).cast("string")), 256) for c in columns}
    return df.withColumns(digest)


def entitled_rows(df: DataFrame, entitlements: DataFrame, reader: str, key: str) -> DataFrame:
    """Rows whose ``key`` the reader is entitled to; ``entitlements`` holds (reader, key)."""
    allowed = entitlements.filter(F.col("reader") == reader).select(key)
    return df.join(allowed, key, "left_semi")
