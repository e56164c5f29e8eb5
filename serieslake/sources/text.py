"""Padded, tab-separated text extracts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MALFORMED = "_malformed"
#: Lines of one compressed file, which a single task reads.
LINES_PER_FILE = 4_000_000


def _options(sep: str, header: bool, check_header: bool = True) -> dict[str, str]:
    return {
        "sep": sep,
        "header": str(header).lower(),
        "ignoreLeadingWhiteSpace": "true",
        "ignoreTrailingWhiteSpace": "true",
        "enforceSchema": str(not check_header).lower(),
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": MALFORMED,
    }


def _with_malformed(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])


def read_padded(
    spark: SparkSession, path: str | list[str], schema: T.StructType, *, sep: str = "\t", header: bool = True,
    check_header: bool = True, malformed: bool = False,
) -> DataFrame:
    """Scan an extract with a declared schema; both sides of every field are trimmed.

    The header is compared with the declared names, case aside, so that swapped or renamed
    columns stop the scan; without ``check_header`` columns are taken by position.  A blank
    field is NULL.  With ``malformed=True`` the whole line is kept in
    ``_malformed`` where its field count is wrong; otherwise such a line is filled up
    with NULLs or cut.
    """
    declared = _with_malformed(schema) if malformed else schema
    reader = spark.read.schema(declared).options(**_options(sep, header, check_header))
    if malformed:
        # The field count of a line is known only when all of its fields are parsed.
        reader = reader.option("columnPruning", "false")
    return reader.csv(path)


def stream_padded(
    spark: SparkSession, path: str, schema: T.StructType, *, sep: str = "\t", malformed: bool = False, **options: str
) -> DataFrame:
    """The same scan as a file stream: each newly landed file is read once."""
    declared = _with_malformed(schema) if malformed else schema
    reader = spark.readStream.schema(declared).options(**_options(sep, header=True)).options(**options)
    if malformed:
        reader = reader.option("columnPruning", "false")
    return reader.csv(path)


def split_malformed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Well-formed rows, and the raw lines of the others."""
    # Spark refuses to read the malformed column alone, as a plain count would; so the
    # filters always look at a field as well.
    read = F.length(F.coalesce(F.col(df.columns[0]), F.lit(""))) >= 0
    good = df.filter(F.col(MALFORMED).isNull() & read).drop(MALFORMED)
    bad = df.filter(F.col(MALFORMED).isNotNull() & read)
    return good, bad


def write_padded(df: DataFrame, path: str, widths: Mapping[str, int], *, sep: str = "\t", mode: str = "error", compression: str = "none") -> None:
    """Write an extract with padded fields: positive widths pad right, negative pad left.

    Values longer than their width are kept whole.  The scans read compressed files as well (padding is most of a
    line); such a file cannot be split, so it holds ``LINES_PER_FILE`` at most.
    """

    def padded(name: str):
        text = F.coalesce(F.col(name).cast("string"), F.lit(""))
        width = widths.get(name, 0)
        fill = F.repeat(F.lit(" "), F.greatest(F.lit(abs(width)) - F.length(text), F.lit(0)))
        return (F.concat(text, fill) if width > 0 else F.concat(fill, text)).alias(name)

    lines = 0 if compression == "none" else LINES_PER_FILE
    (
        df.select(*[padded(name) for name in df.columns])
        .write.mode(mode)
        .options(sep=sep, header="true", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
        .options(compression=compression, maxRecordsPerFile=lines)
        .csv(path)
    )
