"""Text quality by nearest-neighbour voting among labelled latent-semantic vectors.

Terms are runs of three byte classes (letters, digits, marks ...), how large a share of the words repeats the word before,
and words and pairs of words, hashed.  Shapes and words weigh the same, whatever their number.
Their document frequencies are counted over all documents; the latent space is a truncated SVD of
the weighted labelled sample.  Sample vectors and projection are broadcast (at most
``2 * per_label`` rows), every document meets all of them in exact cosine products of blocks,
and its ``neighbours`` nearest vote by similarity.  Each label's votes are weighted to its share among
all learnable labels, as the sample takes up to ``per_label`` rows of each.

Null, empty and blank texts score the share of label 1 (0.5 if nothing can be learnt).  Labels other
than 0 and 1, null labels and labels without a document are not learnt from; of repeated labelled
rows one is.  Repeated rows are scored each.  Other columns are not read by ``score`` and kept by
``keep_good``.  Ties between neighbours fall to the row earlier in the sample.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from serieslake.llm.common import crc32_of, on_batches, slices, texts_of, with_added
from serieslake.llm.words import Memo

HELD_OUT = 5  # a row is held out if the crc32 of its id is divisible by this
THRESHOLD = 0.3


def _classes() -> np.ndarray:
    table = np.full(256, 11, np.uint16)
    table[128:] = 12
    for k, members in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", "|", ".", ",", "!", "?'\"", "$%&#*=_~^<>\\")):
        table[list(members.encode())] = k
    table[:32], table[10], table[9] = 13, 4, 3
    return table


CLASSES = _classes()
REPEATS = (0.03, 0.1, 0.3)  # each a term of its own: this share of the words equals the word before
SHAPES = 4096 + len(REPEATS)
BUCKETS = 8192  # of words and pairs of words
TERMS = SHAPES + BUCKETS

_WORD = re.compile(r"[^\W\d_]+")
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_hashes = Memo(lambda words: [xxh64_intdigest(word) for word in words], 200_000)


class Model(NamedTuple):
    terms: np.ndarray  # those in the sample
    weight: np.ndarray  # of each of them
    project: np.ndarray  # terms x latent
    vectors: np.ndarray  # sample x latent, of length one
    votes: np.ndarray  # sample x 2: the weight of each row for each label
    share: float  # of label 1
    neighbours: int
    shapes: int  # so many of the terms are no words


def term_counts(text: str) -> np.ndarray:
    """How often each term occurs in the text."""
    kinds = CLASSES[np.frombuffer(text.encode(), np.uint8)]
    counts = np.zeros(TERMS, np.float32)
    if len(kinds) > 2:
        counts[:4096] = np.bincount(kinds[:-2] * 256 + kinds[1:-1] * 16 + kinds[2:], minlength=4096)
    words = text.split()
    repeated = sum(map(eq, words, words[1:])) / max(1, len(words) - 1)
    counts[4096:SHAPES] = [100 * (repeated > share) for share in REPEATS]
    for part in slices(text):
        words = _WORD.findall(part.lower())
        hashes = np.fromiter(_hashes.values_of(words), np.uint64, len(words))
        pairs = (hashes[:-1] * _PAIR + hashes[1:]) * _PAIR
        buckets = np.concatenate([hashes, pairs]) % np.uint64(BUCKETS)
        counts[SHAPES:] += np.bincount(buckets.astype(np.int64), minlength=BUCKETS)
    return counts


def _counts(texts: list[str]) -> np.ndarray:
    return np.stack([term_counts(text) for text in texts])


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each term occurs, and how many there are; one row per task is gathered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(TERMS, np.int64), 0
        for batch in batches:
            for text in texts_of(batch):
                total += term_counts(text) > 0
                rows += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(TERMS + 1)), pa.array(np.append(total, rows))], names=["term", "n"]
        )

    rows = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(TERMS + 1, np.int64)
    for row in rows:
        n[row.term] = row.n
    return n[:-1], int(n[-1])


def held_out() -> Column:
    return crc32_of("doc_id") % HELD_OUT == 0


class Sample(list):
    """Rows of a sample, each as its terms and their counts: some 10 KB a row, where a dense one takes 49."""

    def dense(self, start: int, stop: int) -> np.ndarray:
        made = np.zeros((len(self[start:stop]), TERMS), np.float32)
        for row, (terms, counts) in zip(made, self[start:stop], strict=True):
            row[terms] = counts
        return made

    def terms(self) -> np.ndarray:
        present = np.zeros(TERMS, bool)
        for terms, _ in self:
            present[terms] = True
        return np.flatnonzero(present)


def labelled_sample(docs: DataFrame, labels: DataFrame, per_label: int) -> tuple[Sample, np.ndarray, np.ndarray]:
    """Term counts and labels of at most ``per_label`` rows of each label, and how many each has in all."""
    usable = labels.filter("quality in (0, 1) and doc_id is not null").filter(~held_out()).groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    totals = {row.quality: row["n"] for row in usable.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    chosen = [
        usable.filter(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label) for label in (0, 1)
    ]
    chosen = chosen[0].unionByName(chosen[1])  # at most 2 * per_label rows

    def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
        packed = []
        for text in texts_of(batch):
            counts = term_counts(text)
            terms = np.flatnonzero(counts)
            packed.append(terms.astype("<u2").tobytes() + counts[terms].tobytes())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(packed)], names=["doc_id", "quality", "packed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = on_batches(texts, pack, f"doc_id {kind}, quality int, packed binary")
    rows = sorted(rows.dropDuplicates(["doc_id"]).collect(), key=lambda r: r.doc_id)
    sample = Sample((np.frombuffer(r.packed, "<u2", len(r.packed) // 6), np.frombuffer(r.packed, np.float32, offset=len(r.packed) // 3)) for r in rows)
    return sample, np.array([r.quality for r in rows], int), np.array([totals.get(0, 0), totals.get(1, 0)], float)


def _weighted(counts: np.ndarray, weight: np.ndarray, shapes: int) -> np.ndarray:
    made = np.log1p(counts)
    made *= weight
    for block in (made[:, :shapes], made[:, shapes:]):
        block /= np.maximum(np.linalg.norm(block, axis=1, keepdims=True), 1e-12)
    return made


class _Blocks:
    """The weighted sample, made dense a block of rows at a time."""

    def __init__(self, sample: Sample, terms: np.ndarray, weight: np.ndarray, shapes: int, size: int = 256) -> None:
        self.sample, self.terms, self.weight, self.shapes, self.size = sample, terms, weight, shapes, size

    def _each(self) -> Iterator[tuple[slice, np.ndarray]]:
        for start in range(0, len(self.sample), self.size):
            rows = slice(start, start + self.size)
            yield rows, _weighted(self.sample.dense(rows.start, rows.stop)[:, self.terms], self.weight, self.shapes)

    def times(self, right: np.ndarray) -> np.ndarray:
        return np.concatenate([block @ right for _, block in self._each()])

    def transposed_times(self, right: np.ndarray) -> np.ndarray:
        return sum(block.T @ right[rows] for rows, block in self._each())


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def fit(docs: DataFrame, labels: DataFrame, per_label: int = 1500, latent: int = 48, neighbours: int = 15) -> Model | None:
    """The model, or None if there is no labelled document."""
    sample, label, totals = labelled_sample(docs, labels, per_label)
    if not len(label):
        return None
    frequency, rows = document_frequencies(docs)
    terms = sample.terms()
    weight = (np.log((1 + rows) / (1 + frequency[terms])) + 0.1).astype(np.float32)
    shapes = int((terms < SHAPES).sum())
    matrix = _Blocks(sample, terms, weight, shapes)
    latent = min(latent, len(sample), len(terms))
    rng = np.random.default_rng(5)
    basis = matrix.transposed_times(matrix.times(rng.standard_normal((len(terms), latent + 16)).astype(np.float32)))
    for _ in range(3):  # subspace iteration
        basis = matrix.transposed_times(matrix.times(np.linalg.qr(basis)[0]))
    basis = np.linalg.qr(basis)[0]
    project = basis @ np.linalg.svd(matrix.times(basis), full_matrices=False)[2][:latent].T
    found = np.bincount(label, minlength=2)
    vote = totals / totals.sum() / np.maximum(found, 1)
    votes = np.zeros((len(label), 2), np.float32)
    votes[np.arange(len(label)), label] = vote[label]
    return Model(terms, weight, project.astype(np.float32), _unit(matrix.times(project)).astype(np.float32), votes, float(totals[1] / totals.sum()), min(neighbours, len(label)), shapes)


def scores(model: Model | None, texts: list[str], block: int = 256) -> np.ndarray:
    """The share of label 1 among each text's neighbours, by similarity."""
    out = np.full(len(texts), 0.5 if model is None else model.share)
    if model is None:
        return out
    filled = [i for i, text in enumerate(texts) if text.strip()]
    for start in range(0, len(filled), block):
        rows = filled[start : start + block]
        vectors = _unit(_weighted(_counts([texts[i] for i in rows])[:, model.terms], model.weight, model.shapes) @ model.project)
        cosine = vectors @ model.vectors.T
        nearest = np.argpartition(-cosine, model.neighbours - 1, axis=1)[:, : model.neighbours]
        near = np.take_along_axis(cosine, nearest, axis=1).astype(np.float64)
        weight = np.maximum(near, 0) ** 8
        votes = np.einsum("ij,ijk->ik", weight, model.votes[nearest])
        total = votes.sum(1)
        out[rows] = np.where(total > 0, votes[:, 1] / np.where(total > 0, total, 1), model.share)
    return np.clip(out, 0, 1)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs(doc_id, text)``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores(sent.value, texts_of(batch)))], names=["doc_id", "score"])

    scored = on_batches(docs.select("doc_id", "text"), make, f"doc_id {kind}, score double")
    predicted = F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted"))


def keep_good(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs`` whose predicted label is 1, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(scores(sent.value, texts_of(batch)) >= THRESHOLD))

    return on_batches(docs, make, docs.schema)
