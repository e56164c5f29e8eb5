"""Near-duplicates by SimHash, found through tables of distances to reference fingerprints.

The references are zero, the 64 single bits and some random fingerprints.  A fingerprint's
distances to the single bits of a block, relative to its distance to zero, spell out that block.
Fingerprints that differ in at most k bits agree on all but k of the blocks, so they share the
distance profile of one choice of the other blocks; equal profiles meet by a shuffle on them.  In
such a bucket, pairs whose distances to any random reference differ by more than k are dropped
(triangle inequality), and the rest are verified bit by bit.  With 8 blocks and k = 2 a bucket
holds at most 2^16 fingerprints, whatever the data.  Links leave a bucket as a spanning forest.

Null and empty texts have fingerprint zero and are linked like any other.  Repeated rows are kept
each, in one group.  A null doc_id is kept; it names a group only if the group has no other.  Other
columns are not read by ``near_groups`` and kept by ``keep_one``.  Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_digest

from serieslake.llm.common import on_batches, portions, slices, texts_of, with_added
from serieslake.llm.components import components
from serieslake.session import materialize

BLOCKS = 8
SEED = 42
_BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)
REFERENCES = np.concatenate([
    np.zeros(1, np.uint64), _BITS, np.random.default_rng(17).integers(0, 1 << 64, 15, np.uint64, endpoint=False),
])


def shingle_digests(words: list[bytes], length: int) -> bytes:
    """XXH64 of each run of ``length`` words, space-joined; of all words if there are fewer."""
    if not words:
        return b""
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths)
    begins = (ends - lengths).tolist()
    ends = (ends[min(length, len(words)) - 1 :] - 1).tolist()
    return b"".join([xxh64_digest(joined[a:b], SEED) for a, b in zip(begins, ends, strict=False)])


def fingerprints(texts: list[str], length: int) -> np.ndarray:
    """The SimHash of each text as int64: a bit is set if it is in over half of the shingle hashes."""
    out = np.zeros(len(texts), np.uint64)
    for start, stop in portions(texts):
        if stop == start + 1:
            ones, total, words = np.zeros(64, np.int64), 0, []
            parts = list(slices(texts[start]))
            for k, part in enumerate(parts):
                words += part.encode().lower().split()
                if len(words) < length and k < len(parts) - 1:
                    continue
                if total and len(words) < length:
                    break
                raw = shingle_digests(words, length)
                ones += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
                total += len(raw) // 8
                words = words[-(length - 1) :] if length > 1 else []
            out[start] = _packed((ones * 2 > total)[None])[0]
            continue
        raws = [shingle_digests(text.encode().lower().split(), length) for text in texts[start:stop]]
        counts = np.fromiter((len(raw) // 8 for raw in raws), np.int64, len(raws))
        bits = np.unpackbits(np.frombuffer(b"".join(raws), np.uint8).reshape(-1, 8), axis=1)
        filled = np.flatnonzero(counts)
        if len(filled):
            begins = np.cumsum(counts) - counts
            ones = np.add.reduceat(bits, begins[filled], axis=0, dtype=np.int32)
            out[start + filled] = _packed(ones * 2 > counts[filled, None])
    return out.view(np.int64)


def _packed(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1).view(">u8")[:, 0].astype(np.uint64)


def with_fingerprint(docs: DataFrame, length: int, name: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint of ``text`` as a long."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(fingerprints(texts_of(batch), length))], names=[*batch.schema.names, name]
        )

    return on_batches(docs, make, with_added(docs, f"{name} long"))


def bucket_links(members: np.ndarray, most: int, block: int = 2048) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that differ in at most ``most`` bits."""
    table = np.bitwise_count(members[:, None] ^ REFERENCES[65:]).astype(np.int8)
    parent = list(range(len(members)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    forest = []
    for a in range(0, len(members), block):
        for b in range(a, len(members), block):
            left, right = table[a : a + block], table[b : b + block]
            near = np.abs(left[:, None, 0] - right[None, :, 0]) <= most
            i, j = np.nonzero(np.triu(near, 1) if a == b else near)
            i, j = i + a, j + b
            for pivot in range(1, table.shape[1]):
                close = np.abs(table[i, pivot] - table[j, pivot]) <= most
                i, j = i[close], j[close]
            near = np.bitwise_count(members[i] ^ members[j]) <= most
            for x, y in zip(i[near].tolist(), j[near].tolist(), strict=True):
                p, q = root(x), root(y)
                if p != q:
                    parent[max(p, q)] = min(p, q)
                    forest.append((x, y))
    return forest


def fingerprint_links(classes: DataFrame, most: int) -> DataFrame:
    """a, b: links that connect all distinct ``classes.fp`` at ``most`` differing bits or fewer."""
    edges = np.linspace(0, 64, BLOCKS + 1).astype(int)
    masks = [
        np.bitwise_or.reduce(np.concatenate([_BITS[edges[b] : edges[b + 1]] for b in kept]))
        for kept in combinations(range(BLOCKS), BLOCKS - most)
    ]

    def profiles(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = np.asarray(batch.column("fp")).view(np.uint64)
        table = np.bitwise_count(fp[:, None] ^ REFERENCES[:65]).astype(np.int8)
        spelled = np.where(table[:, 1:] < table[:, :1], _BITS, np.uint64(0)).sum(1, dtype=np.uint64)
        key = (spelled[:, None] & np.array(masks)).ravel()
        choice = np.tile(np.arange(len(masks), dtype=np.int32), len(fp))
        return pa.RecordBatch.from_arrays(
            [pa.array(choice), pa.array(key.view(np.int64)), pa.array(np.repeat(fp, len(masks)).view(np.int64))],
            names=["choice", "profile", "fp"],
        )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((3, 0), np.int64)
        for batch in (*batches, None):
            if batch is not None:
                held = np.concatenate([held, np.array([np.asarray(c).astype(np.int64) for c in batch.columns])], axis=1)
            cut = np.flatnonzero(np.any(held[:2, 1:] != held[:2, :-1], axis=0)) + 1
            cut = [0, *cut.tolist()] + [held.shape[1]] * (batch is None)
            pairs = []
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                if b - a > 1:
                    members = held[2, a:b].view(np.uint64)
                    pairs += [(int(held[2, a + i]), int(held[2, a + j])) for i, j in bucket_links(members, most)]
            held = held[:, cut[-1] :]
            if pairs:
                a, b = zip(*pairs, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    keyed = on_batches(classes.select("fp"), profiles, "choice int, profile long, fp long")
    return keyed.repartition("choice", "profile").sortWithinPartitions("choice", "profile").mapInArrow(link, "a long, b long")


def grouped(marked: DataFrame, most: int) -> DataFrame:
    """fp, root for the distinct fingerprints of ``marked(fp)``; equal roots are one group."""
    classes = materialize(marked.select("fp").distinct(), "classes")
    linked = components(fingerprint_links(classes, most))
    return classes.join(linked, classes.fp == linked.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_groups(docs: DataFrame, length: int = 3, most: int = 2) -> DataFrame:
    """doc_id, fingerprint (hex), component_id (smallest doc_id reachable) of every row."""
    marked = materialize(with_fingerprint(docs.select("doc_id", "text"), length).drop("text"), "fingerprints")
    roots = materialize(grouped(marked, most), "groups")
    classes = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    named = classes.join(roots, "fp")
    ids = named.groupBy("root").agg(F.min("first").alias("component_id"))
    fp_ids = materialize(roots.join(ids, "root").select("fp", "component_id"), "group-ids")
    return marked.join(fp_ids, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, length: int = 3, most: int = 2) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group the one with the smallest doc_id.

    All columns are kept.  Among rows of one doc_id the first by its place in the input stays.
    """
    marked = materialize(
        with_fingerprint(docs, length, "_fp").withColumn("_row", F.monotonically_increasing_id()), "marked"
    )
    roots = materialize(grouped(marked.select(F.col("_fp").alias("fp")), most), "groups")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_row")
    first = marked.groupBy(F.col("_fp").alias("fp")).agg(F.min(order).alias("first"))
    kept = first.join(roots, "fp").groupBy("root").agg(F.min("first").alias("first")).select(F.col("first._row").alias("_row"))
    return marked.join(kept, "_row").select(*docs.columns)
