"""Content fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha256(content: str | Column) -> Column:
    return F.sha2(content, 256)


def valid_utf8(content: str | Column) -> Column:
    """Whether bytes (or text) are well-formed UTF-8."""
    return F.is_valid_utf8(content)


def byte_length(content: str | Column) -> Column:
    return F.octet_length(content).cast("bigint")
