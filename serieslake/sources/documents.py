"""Nested JSON documents that hold their records in one array."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def document_schema(record: T.StructType, field: str = "data") -> T.StructType:
    return T.StructType([T.StructField(field, T.ArrayType(record))])


def read_documents(
    spark: SparkSession, path: str | list[str], record: T.StructType, *, field: str = "data", lines: bool = False
) -> DataFrame:
    """One row per document with its declared record array.

    A whole-file document cannot be split: one file is one task.  Publish large ones as
    JSON lines (``lines=True``), which split.
    """
    return spark.read.schema(document_schema(record, field)).option("multiLine", str(not lines).lower()).json(path)


def flatten(documents: DataFrame, field: str = "data") -> DataFrame:
    """One row per array element, its struct fields as columns under their own names."""
    return documents.select(F.inline(F.col(field)))
