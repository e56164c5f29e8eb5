"""Files as they are: listed, landed and hashed by tasks, through the file-system library.

Spark's own readers pass over empty files and names that begin with ``_`` or ``.``; these do not.  Stores are
those that the library knows: local and mounted folders, HDFS, S3, GCS, ABFS.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fnmatch import fnmatchcase
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from serieslake.session import control_rows, materialize

# Spark's names of stores, and those of the file system library.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "wasbs": "abfs"}
#: Most tasks that list the folders of one level, and that hash ranges.
MOST_TASKS = 2000
#: Files are hashed in ranges of so many bytes; a task holds one block of a range at a time.
RANGE, BLOCK = 64 << 20, 4 << 20


def store_address(path: str) -> str:
    """A path as Spark gives it, for the file system library: its scheme, quoted, local ones with three slashes."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return "file:///" + quote(rest.lstrip("/"))
    return f"{SCHEMES.get(scheme, scheme)}:" + quote(rest, safe="/@:")


def store_of(path: str):
    """The store of a full path, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(store_address(path))


def qualified(spark: SparkSession, root: str) -> str:
    """The folder with its scheme; without one it lies in the session's default store."""
    root = root.rstrip("/")
    if ":/" in root:
        return root
    return spark.conf.get("spark.hadoop.fs.defaultFS", "file://").rstrip("/") + root


def _prefix(root: str, inner: str) -> str:
    """What stands before a path of the store in Spark's paths; some stores' paths hold the bucket."""
    scheme, _, rest = root.partition(":")
    if scheme == "file":
        return "file:"
    return f"{scheme}://{rest.lstrip('/').split('/', 1)[0]}" if inner.startswith("/") else f"{scheme}://"


def _listed(root: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    store, base = store_of(root)
    before = _prefix(root, base)
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            here = store.get_file_info(f"{base}/{folder}".rstrip("/"))
            found = [here] if here.type == fs.FileType.File else store.get_file_info(fs.FileSelector(here.path, allow_not_found=True))
            for start in range(0, len(found), 10_000):
                infos = found[start : start + 10_000]
                columns = {
                    "path": pa.array([before + info.path for info in infos], pa.string()),
                    "relative_path": pa.array([info.path[len(base) :].lstrip("/") or info.base_name for info in infos], pa.string()),
                    "is_dir": pa.array([info.type == fs.FileType.Directory for info in infos]),
                    "size_bytes": pa.array([info.size for info in infos], pa.int64()),
                    "modified_at": pa.array([None if info.mtime_ns is None else info.mtime_ns // 1000 for info in infos], pa.int64()).cast(pa.timestamp("us", "UTC")),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def list_files(spark: SparkSession, root: str, *, glob: str | None = None, hidden: bool = True) -> DataFrame:
    """path, relative_path, size_bytes, modified_at of every file below ``root`` (or ``root`` itself), whatever its name or size.

    Folders are listed level by level, each by one task; no listing reaches the driver.  ``glob`` is a pattern for
    file names; without ``hidden`` names that begin with ``_`` or ``.`` are left out.
    """
    root = qualified(spark, root)
    schema = "path string, relative_path string, is_dir boolean, size_bytes long, modified_at timestamp"
    folders, found = control_rows(spark, [("",)], {"folder": "string"}), []
    n = 1
    while n:
        level = folders.repartition(min(n, MOST_TASKS)) if n > 1 else folders
        listed = materialize(level.mapInArrow(lambda batches: _listed(root, batches), schema), "listing")
        found.append(listed.filter("NOT is_dir").drop("is_dir"))
        folders = listed.filter("is_dir").select("relative_path")
        n = folders.count()
    files = reduce(DataFrame.unionByName, found)
    name = F.element_at(F.split("relative_path", "/"), -1)
    if glob:
        pattern = glob

        def matching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([fnmatchcase(p.rsplit("/", 1)[-1], pattern) for p in batch.column(1).to_pylist()], pa.bool_()))

        files = files.mapInArrow(matching, files.schema)
    return files if hidden else files.filter(~name.rlike("^[_.]"))


def land_files(contents: DataFrame, root: str) -> DataFrame:
    """Write each row of ``contents(relative_path, content binary)`` as the file of that name below ``root``.

    A task that is run again writes the same bytes to the same names.  Returns relative_path, size_bytes and content_hash.
    """
    root = qualified(contents.sparkSession, root)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = store_of(root)
        for batch in batches:
            paths, data = batch.column(0).to_pylist(), [content or b"" for content in batch.column(1).to_pylist()]
            for path, content in zip(paths, data, strict=True):
                store.create_dir(f"{base}/{path}".rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(f"{base}/{path}", compression=None) as out:
                    out.write(content)
            hashes = [hashlib.sha256(content).hexdigest() for content in data]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(content) for content in data], pa.int64()), pa.array(hashes, pa.string())],
                names=["relative_path", "size_bytes", "content_hash"],
            )

    rows = contents.select("relative_path", "content").mapInArrow(run, "relative_path string, size_bytes long, content_hash string")
    return materialize(rows, "landed")


def _boundary(block: bytes, at: int) -> int:
    """The first place from ``at`` on, and at most three further, where no character goes on."""
    while at < len(block) and block[at] & 0xC0 == 0x80 and at < 3:
        at += 1
    return at


class _Utf8:
    """Checks bytes that come in blocks for well-formed UTF-8."""

    def __init__(self) -> None:
        import codecs

        self.decoder, self.valid = codecs.getincrementaldecoder("utf-8")(), True

    def feed(self, block: bytes, last: bool = False) -> None:
        try:
            if self.valid:
                self.decoder.decode(block, last)
        except UnicodeDecodeError:
            self.valid = False


def range_digest(stream, size: int, offset: int, length: int, block: int = BLOCK) -> tuple[str, bool]:
    """SHA-256 of a file's bytes from ``offset`` on, and whether the characters that begin there are well-formed.

    A character belongs to the range that holds its first byte, so up to three bytes behind the
    range are read too, and as many at its beginning are left to the range before.
    """
    digest, text = hashlib.sha256(), _Utf8()
    stream.seek(offset)
    left, first = min(length, size - offset), offset > 0
    while left > 0:
        data = stream.read(min(block, left))
        if not data:
            raise OSError(f"the file ended {left} bytes early")
        digest.update(data)
        text.feed(data[_boundary(data, 0) :] if first else data)
        left, first = left - len(data), False
    after = stream.read(min(3, size - offset - length)) if offset + length < size else b""
    text.feed(after[: _boundary(after, 0)], last=True)
    return digest.hexdigest(), text.valid


def content_digests(files: DataFrame, *, range_bytes: int = RANGE) -> DataFrame:
    """Add content_hash and valid_utf8 to ``files(path, size_bytes, ...)``, for files of any size.

    Ranges of a file are read by different tasks, a block at a time.  The hash is the SHA-256 of the content; of a file of
    several ranges it is the SHA-256 of their hashes (as hex digits, one after the other), so it can be made in parallel.
    """
    if range_bytes < 4:
        raise ValueError("a range holds at least one character: four bytes")
    last = F.greatest(F.ceil(F.col("size_bytes") / range_bytes) - 1, F.lit(0)).cast("long")
    ranges = files.select("path", "size_bytes", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("range"))
    n = files.agg(F.sum(last + 1)).first()[0] or 0
    ranges = ranges.repartition(max(1, min(n, MOST_TASKS)), "path", "range")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for path, size, number in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                store, inner = store_of(path)
                with store.open_input_file(inner) as stream:
                    made.append((path, number, *range_digest(stream, size, number * range_bytes, range_bytes)))
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made, strict=True)], names=["path", "range", "hash", "valid"])

    hashed = ranges.mapInArrow(run, "path string, range long, hash string, valid boolean")
    parts = hashed.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("range", "hash"))).alias("parts"), F.min("valid").alias("valid_utf8"))
    hashes = F.transform("parts", lambda part: part["hash"])
    root = F.when(F.size("parts") == 1, hashes[0]).otherwise(F.sha2(F.array_join(hashes, ""), 256))
    return files.join(parts.select("path", root.alias("content_hash"), "valid_utf8"), "path")
