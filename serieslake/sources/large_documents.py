"""Whole-file JSON documents of any size, read by many tasks.

A file is cut into byte ranges.  For each range a task notes, for both cases at its beginning (outside and inside a
string, there also behind a backslash), in which case it ends and by how much the brackets nest deeper.  These small maps are composed over the
ranges of a file, so every range learns its depth.  Then each range gives the records that begin in it, and
reads on to the end of its last one.  UTF-8 only; a document whose brackets do not close is an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from serieslake.session import materialize
from serieslake.sources.files import MOST_TASKS, RANGE, list_files, store_of

PLAIN, STRING, ESCAPED = 0, 1, 2  # how a range begins or ends: outside a string, in one, in one behind a backslash
_QUOTE, _BACKSLASH = ord('"'), ord("\\")
_NESTS = np.zeros(256, np.int8)
_NESTS[list(b"{[")], _NESTS[list(b"}]")] = 1, -1
_KEY = re.compile(rb'"((?:[^"\\]|\\.)*)"\s*:\s*$', re.DOTALL)
LONGEST_KEY = 4096


def _quotes(data: np.ndarray) -> np.ndarray:
    """Places of quotation marks that no backslash escapes."""
    marks = np.flatnonzero(data == _QUOTE)
    behind = marks[(marks > 0) & (data[marks - 1] == _BACKSLASH)]
    escaped = []
    for mark in behind.tolist():
        first = mark
        while first and data[first - 1] == _BACKSLASH:
            first -= 1
        if (mark - first) % 2:
            escaped.append(mark)
    return np.setdiff1d(marks, escaped, assume_unique=True)


def _brackets(data: np.ndarray, quotes: np.ndarray, inside: bool) -> np.ndarray:
    """Places of brackets outside strings, if the data begin ``inside`` one."""
    places = np.flatnonzero(_NESTS[data])
    return places[(np.searchsorted(quotes, places) + inside) % 2 == 0]


def transitions(block: bytes) -> list[tuple[int, int]]:
    """For each way to begin: the way the block ends, and the change of depth."""
    made = []
    for begin in (PLAIN, STRING, ESCAPED):
        data = np.frombuffer(block, np.uint8)[begin == ESCAPED :]
        quotes = _quotes(data)
        inside = (begin != PLAIN) ^ (len(quotes) % 2 == 1)
        trailing = len(data) - len(block[len(block) - len(data) :].rstrip(b"\\"))
        if begin == ESCAPED and not block:
            made.append((ESCAPED, 0))
            continue
        end = (ESCAPED if trailing % 2 else STRING) if inside else PLAIN
        made.append((end, int(_NESTS[data[_brackets(data, quotes, begin != PLAIN)]].sum())))
    return made


class _Scan:
    """The brackets of a block that begins in a known way and depth."""

    def __init__(self, block: bytes, begin: int, depth: int) -> None:
        self.skip = int(begin == ESCAPED)
        data = np.frombuffer(block, np.uint8)[self.skip :]
        self.places = _brackets(data, _quotes(data), begin != PLAIN)
        self.kinds = data[self.places]
        after = depth + np.cumsum(_NESTS[self.kinds].astype(np.int64))
        self.before = after - _NESTS[self.kinds]
        self.places = self.places + self.skip

    def opened(self, depth: int, kinds: bytes) -> np.ndarray:
        """Indexes of brackets of these kinds that open at this depth."""
        return np.flatnonzero((self.before == depth) & np.isin(self.kinds, list(kinds)))


def _key_before(stream, place: int) -> str | None:
    """The key that stands before the bracket at ``place``."""
    first = max(0, place - LONGEST_KEY)
    stream.seek(first)
    found = _KEY.search(stream.read(place - first))
    return found[1].decode("utf-8", "replace") if found else None


def _ranges(spark: SparkSession, path: str, range_bytes: int) -> DataFrame:
    """path, size_bytes, range of every range of the files at or below ``path``."""
    files = list_files(spark, path, hidden=False).filter("size_bytes > 0").select("path", "size_bytes")
    last = F.ceil(F.col("size_bytes") / range_bytes).cast("long") - 1
    ranges = files.select("path", "size_bytes", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("range"))
    return materialize(ranges, "ranges")


def _spread(ranges: DataFrame) -> DataFrame:
    """The ranges over as many tasks, up to a limit: each reads the bytes of its own."""
    return ranges.repartition(min(max(ranges.count(), 1), MOST_TASKS), "path", "range")


def _block(stream, size: int, number: int, range_bytes: int) -> bytes:
    stream.seek(number * range_bytes)
    return stream.read(min(range_bytes, size - number * range_bytes))


def _rows(batches: Iterator[pa.RecordBatch], make, names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """One Arrow batch for each range, of the rows that ``make(stream, range)`` gives."""
    for batch in batches:
        for row in batch.to_pylist():
            store, inner = store_of(row["path"])
            with store.open_input_file(inner) as stream:
                rows = list(make(stream, row))
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _begins(ranges: DataFrame, range_bytes: int) -> DataFrame:
    """How and at which depth each range begins: the maps of the ranges before it, composed."""
    names = ["path", "size_bytes", "range", "ends", "deeper"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]

    def make(stream, row: dict) -> Iterator[tuple]:
        maps = transitions(_block(stream, row["size_bytes"], row["range"], range_bytes))
        yield row["path"], row["size_bytes"], row["range"], [end for end, _ in maps], [deeper for _, deeper in maps]

    maps = _spread(ranges).mapInArrow(lambda batches: _rows(batches, make, names, types), "path string, size_bytes long, range long, ends array<int>, deeper array<long>")

    def compose(rows: pd.DataFrame) -> pd.DataFrame:  # a row for each range of one file
        rows = rows.sort_values("range")
        begin, depth, begins, depths = PLAIN, 0, [], []
        for ends, deeper in zip(rows["ends"], rows["deeper"], strict=True):
            begins.append(begin)
            depths.append(depth)
            begin, depth = int(ends[begin]), depth + int(deeper[begin])
        if (begin, depth) != (PLAIN, 0):
            raise ValueError(f"{rows['path'].iloc[0]}: a string or bracket does not close")
        return rows[["path", "size_bytes", "range"]].assign(begin=begins, depth=depths)

    return materialize(maps.groupBy("path").applyInPandas(compose, "path string, size_bytes long, range long, begin int, depth long"), "begins")


def _sections(begins: DataFrame, range_bytes: int) -> DataFrame:
    """Adds the key and kind of the top-level member that is open where each range begins."""
    names, types = ["path", "range", "key", "kind"], [pa.string(), pa.int64(), pa.string(), pa.int32()]

    def make(stream, row: dict) -> Iterator[tuple]:
        scan = _Scan(_block(stream, row["size_bytes"], row["range"], range_bytes), row["begin"], row["depth"])
        opened = scan.opened(1, b"[{")
        if len(opened):
            place = row["range"] * range_bytes + int(scan.places[opened[-1]])
            yield row["path"], row["range"], _key_before(stream, place), int(scan.kinds[opened[-1]])

    last = _spread(begins).mapInArrow(lambda batches: _rows(batches, make, names, types), "path string, range long, key string, kind int")
    earlier = Window.partitionBy("path").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    member = F.when(F.col("kind").isNotNull(), F.struct("key", "kind"))
    open_ = F.last(member, ignorenulls=True).over(earlier)
    return materialize(begins.join(last, ["path", "range"], "left").withColumn("open", open_).select(*begins.columns, "open.key", "open.kind"), "sections")


def records(spark: SparkSession, path: str, field: str = "data", *, range_bytes: int = RANGE) -> DataFrame:
    """value: the text of every object in the top-level arrays named ``field`` of the documents at or below ``path``."""
    ranges = _sections(_begins(_ranges(spark, path, range_bytes), range_bytes), range_bytes)

    def make(stream, row: dict) -> Iterator[tuple]:
        block = _block(stream, row["size_bytes"], row["range"], range_bytes)
        offset = row["range"] * range_bytes
        scan = _Scan(block, row["begin"], row["depth"])
        wanted = row["key"] == field and row["kind"] == ord("[")
        closing = scan.places[np.flatnonzero((scan.before == 3) & (_NESTS[scan.kinds] < 0))]
        for k in np.flatnonzero(((scan.before == 1) & (_NESTS[scan.kinds] > 0)) | ((scan.before == 2) & (scan.kinds == ord("{")))).tolist():
            place = int(scan.places[k])
            if scan.before[k] == 1:
                wanted = scan.kinds[k] == ord("[") and _key_before(stream, offset + place) == field
            elif wanted:
                end = np.searchsorted(closing, place)
                whole = block[place : closing[end] + 1] if end < len(closing) else _rest(stream, row["size_bytes"], offset + place, range_bytes)
                yield (whole.decode("utf-8", "replace"),)

    return _spread(ranges).mapInArrow(lambda batches: _rows(batches, make, ["value"], [pa.string()]), "value string")


def _rest(stream, size: int, first: int, step: int) -> bytes:
    """The object that begins at ``first`` and ends behind the range."""
    held = b""
    while first + len(held) < size:
        stream.seek(first + len(held))
        held += stream.read(min(max(step, len(held)), size - first - len(held)))
        scan = _Scan(held, PLAIN, 0)
        closed = np.flatnonzero((scan.before == 1) & (_NESTS[scan.kinds] < 0))
        if len(closed):
            return held[: scan.places[closed[0]] + 1]
    raise ValueError("an object does not close")


def read_large_documents(spark: SparkSession, path: str, record: T.StructType, *, field: str = "data", range_bytes: int = RANGE) -> DataFrame:
    """``flatten(read_documents(...))`` for documents that no single task should read: one row per object of the array."""
    return records(spark, path, field, range_bytes=range_bytes).select(F.from_json("value", record).alias("record")).select("record.*")
