"""Token ids of documents in Parquet files that can be read selectively.

Texts are put in order of doc_id by a range exchange, encoded by the tasks that write, and stored as
lists of integers with dictionary encoding, row groups and pages of a set size, and page indexes.  A
reader of counts or offsets never touches the ids, and a range of documents touches only its pages.

Null and empty texts hold the end id alone.  A null doc_id comes first.  Rows with equal doc_id are
ordered by text, and equal rows are kept each.  Other columns are not read.  An empty table gives
empty files.
"""

from __future__ import annotations

import functools
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from serieslake.llm.common import on_batches, portions, slices, texts_of
from serieslake.llm.words import byte_characters, chunks_of
from serieslake.session import materialize

#: Row groups of 32 MB, pages of at most 64 KB and 500 rows; a dictionary page holds any vocabulary up to 256k.
LAYOUT = {
    "compression": "zstd",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(64 << 10),
    "parquet.page.row.count.limit": "500",
    "parquet.enable.dictionary": "true",
    "parquet.dictionary.page.size": str(1 << 20),
}


class Encoder(dict):
    """Chunks and their ids as little-endian 32-bit words, from the tokenizers library; each chunk is encoded once."""

    def __init__(self, path: str, most: int = 450_000) -> None:
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.most = self.tokenizer.model, most
        self.characters = byte_characters()

    def __missing__(self, chunk: str) -> bytes:
        if len(self) > self.most:
            self.clear()
        if chunk.isalpha() and chunk.islower() and (chunk.isascii() or max(chunk) < "\u0300"):
            # Normal already and one pre-token: the library's model takes it as it is, byte by byte.
            shown = chunk if chunk.isascii() else "".join([self.characters[byte] for byte in chunk.encode()])
            ids = [token.id for token in self.model.tokenize(shown)]
        else:
            ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        made = self[chunk] = array("i", ids).tobytes()
        return made

    def encode(self, text: str) -> bytes:
        return b"".join([b"".join(map(self.__getitem__, chunks_of(part))) for part in slices(text)])


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def write_tokens(docs: DataFrame, path: str, target: str, end_id: int = 1) -> None:
    """Write ``docs(doc_id, text)`` as files of (part, doc_id, offset, n_tokens, ids) below ``target``.

    Parts ascend with doc_id and so do the rows in each; ``offset`` counts the ids before a row in its part.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    ordered = docs.select("doc_id", "text").repartitionByRange(*order[:2]).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, offset = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = texts_of(batch)
            for start, stop in portions(texts, 8_000_000):
                made = list(map(encoder(path).encode, texts[start:stop]))
                lengths = np.fromiter((len(b) // 4 + 1 for b in made), np.int64, len(made))
                ends = np.concatenate([[0], np.cumsum(lengths)])
                end = np.uint32(end_id).astype("<u4").tobytes()
                ids = np.frombuffer(end.join([*made, b""]), "<i4")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(made), part, np.int32)), batch.column("doc_id").slice(start, stop - start),
                        pa.array(offset + ends[:-1]), pa.array(lengths), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)),
                    ],
                    names=["part", "doc_id", "offset", "n_tokens", "ids"],
                )
                offset += int(ends[-1])

    made = ordered.mapInArrow(run, f"part int, doc_id {kind}, offset long, n_tokens long, ids array<int>")
    made.write.options(**LAYOUT).parquet(target)


def read_tokens(spark: SparkSession, target: str) -> DataFrame:
    """doc_id, start, n_tokens, ids; ``start`` counts the ids of all documents before.  Unused columns are not read."""
    stored = spark.read.parquet(target)
    totals = stored.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    begins = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("begin"))
    begins = materialize(begins, "begins")  # so that its size is known to the join
    return stored.join(begins, "part").select("doc_id", (F.col("begin") + F.col("offset")).alias("start"), "n_tokens", "ids")


def with_checksum(tokens: DataFrame) -> DataFrame:
    """The rows of ``read_tokens`` with the crc32 of their ids as little-endian words, in place of the ids."""
    kind = tokens.schema["doc_id"].dataType.simpleString()

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column("ids")
        ends = np.asarray(lists.offsets) * 4
        raw = memoryview(np.ascontiguousarray(np.asarray(lists.values), "<i4")).cast("B")
        sums = [zlib.crc32(raw[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        names = ["doc_id", "start", "n_tokens"]
        return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(sums, pa.int64())], names=[*names, "ids_crc32"])

    return on_batches(tokens.select("doc_id", "start", "n_tokens", "ids"), make, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
