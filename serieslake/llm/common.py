"""What the text operators share: columns by name, slices of long texts, per-batch functions."""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Characters of text that a task holds split into words at a time.
SLICE = 1_000_000

_GAP = re.compile(r"[ \n]")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(text: str, size: int = SLICE) -> Iterator[str]:
    """The text in pieces of about ``size``, cut only before a space or a line feed."""
    start = 0
    while len(text) - start > size:
        gap = _GAP.search(text, start + size)
        if gap is None:
            break
        yield text[start : gap.start()]
        start = gap.start()
    yield text[start:] if start else text


def portions(texts: list[str], size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of the list that hold about ``size`` characters each, one text at least."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= size:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column's texts; null reads as empty."""
    values = batch.column(batch.schema.get_field_index(column))
    return [text or "" for text in values.to_pylist()]


def on_batches(df: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType) -> DataFrame:
    """Apply ``make`` to each non-empty Arrow batch of ``df``; the rows never leave their partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = make(batch)
                if made.num_rows:
                    yield made

    return df.mapInArrow(run, schema)


def with_added(df: DataFrame, added: str) -> StructType:
    """The schema of ``df`` followed by the fields of the DDL string ``added``."""
    return StructType([*df.schema.fields, *StructType.fromDDL(added).fields])


@functools.cache
def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def crc32_of(column: str):
    """crc32 of a column's value as text; a null reads as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


#: Characters of long texts that one task takes on.
TASK_CHARACTERS = 4 << 20
MOST_TASKS = 50_000


def long_parts(texts: DataFrame, size: int, behind: int = 0, ahead: int = 0) -> DataFrame:
    """Parts of ``size`` characters of each text of ``texts(row, ..., text)``: adds part, n_parts, before; spread over tasks.

    A text is cut in one pass by the task that reads it; the parts then go to other tasks by row and part.  Each
    shows up to ``behind`` characters of what precedes it, ``before`` of them, and up to ``ahead`` of what follows.
    """
    kept = [f.name for f in texts.schema.fields if f.name != "text"]
    schema = StructType([*(texts.schema[name] for name in kept), *StructType.fromDDL("part int, n_parts int, before int, text string").fields])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, text in enumerate(texts_of(batch)):
                n = max(1, -(-len(text) // size))
                for first in range(0, n, 64):  # a batch of some megabytes at a time
                    numbers = range(first, min(first + 64, n))
                    before = [min(behind, i * size) for i in numbers]
                    made = [text[i * size - b : (i + 1) * size + ahead] for i, b in zip(numbers, before, strict=True)]
                    rows = pa.array([k] * len(made))
                    columns = [batch.column(name).take(rows) for name in kept]
                    columns += [pa.array(numbers, pa.int32()), pa.array([n] * len(made), pa.int32()), pa.array(before, pa.int32()), pa.array(made, pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, names=[*kept, "part", "n_parts", "before", "text"])

    characters = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    tasks = min(max(1, -(-characters // TASK_CHARACTERS)), MOST_TASKS)
    return texts.select(*kept, "text").mapInArrow(cut, schema).repartition(tasks, "row", "part")


FILTER_BITS = 26


def hash_filter(df: DataFrame, column: str) -> np.ndarray:
    """A bit for each leading part of a 64-bit hash that occurs: 8 MB, however many rows there are.

    Tasks combine their bits in words of 64 before and after one shuffle; at most a million words reach the driver.
    """
    place = f"shiftrightunsigned(`{column}`, {64 - FILTER_BITS})"
    words = df.selectExpr(f"shiftright({place}, 6) AS word", f"shiftleft(1L, CAST({place} & 63 AS INT)) AS bits")
    found = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    whole = np.zeros(1 << FILTER_BITS - 6, np.int64)
    whole[np.asarray(found["word"].combine_chunks())] = np.asarray(found["bits"].combine_chunks())
    return whole.astype("<i8").view(np.uint8)


def may_hold(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """False for hashes that the filter's table does not hold."""
    place = hashes.view(np.uint64) >> np.uint64(64 - FILTER_BITS)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
