"""Declared shapes of the raw files and of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T


def text_schema(*names: str) -> T.StructType:
    """All-string, all-nullable: raw extracts are typed only after they are trimmed."""
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def lookup_schema(code: str, text: str) -> T.StructType:
    """The usual five-column code list."""
    return text_schema(code, text, "display_level", "selectable", "sort_sequence")


# The column layouts of the published files.
SERIES = text_schema(
    "series_id", "sector_code", "class_code", "measure_code", "duration_code", "seasonal",
    "base_year", "footnote_codes", "begin_year", "begin_period", "end_year", "end_period",
)
OBSERVATIONS = text_schema("series_id", "year", "period", "value", "footnote_codes")
SECTOR = lookup_schema("sector_code", "sector_name")
CLASS = lookup_schema("class_code", "class_text")
MEASURE = lookup_schema("measure_code", "measure_text")
DURATION = lookup_schema("duration_code", "duration_text")
SEASONAL = text_schema("seasonal_code", "seasonal_text")
PERIOD = text_schema("period", "period_abbr", "period_name")
FOOTNOTE = text_schema("footnote_code", "footnote_text")

# One element of the population document's ``data`` array; names as published.  Numbers are read as
# text, quoted or not, and typed later.
POPULATION_RECORD = T.StructType([
    T.StructField("Nation ID", T.StringType()),
    T.StructField("Nation", T.StringType()),
    T.StructField("Year", T.StringType()),
    T.StructField("Population", T.StringType()),
])

# Quarter codes, and the code of the yearly average stored beside them.
QUARTERS = ("Q01", "Q02", "Q03", "Q04")
ANNUAL = "Q05"

MANIFEST = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("relative_path", T.StringType(), False),
    T.StructField("remote_url", T.StringType()),
    T.StructField("size_bytes", T.LongType()),
    T.StructField("last_modified", T.StringType()),
    T.StructField("content_hash", T.StringType()),
    T.StructField("status", T.StringType(), False),
    T.StructField("first_seen_at", T.TimestampType(), False),
    T.StructField("last_seen_at", T.TimestampType(), False),
    T.StructField("last_ingested_at", T.TimestampType()),
])
