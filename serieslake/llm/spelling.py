"""Spelling variants: words one inserted, deleted or replaced letter apart, grouped under the frequent ones.

Every prefix of a word is a node of a trie and every suffix one of a trie of reversed words.  A node's number
follows from its letters: the last (up to) eight of them, packed, and the eight before, packed; a node deeper than 16
mixes earlier blocks of eight into the second number.  So tasks number the nodes of any word without a shared
table, exactly to depth 16.  A word stands at the pair (prefix, suffix) around each of its letters, skipping
it, and around each gap between letters.  Words that skip a letter at one pair differ in that letter; the word at
the gap of that pair lacks it.  So all words at a pair are near each other: at most one for each letter of the
alphabet and one for the gap, whatever the table holds.  They are counted and their best is found by one
window over the pairs; pairs of words are never written out.  Of equal letters in a row only the first
counts as deleted, so each neighbour counts once.

Null and empty texts hold no words; null ids read as the empty text.  Repeated rows count each.  Among near words of
equal count the smallest in code-point order is the form.  Other columns are not read, and a text is read in
slices.  An empty table, or one of rare words, gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from serieslake.llm.common import slices, texts_of
from serieslake.session import materialize

LEAST_LETTERS, LEAST_COUNT, CHANGED = 5, 3, 97
HELD = 400_000  # different words that a task counts before it passes them on
PORTION = 1 << 18  # pairs that a task makes at a time
PAIR = ["p_high", "p_low", "s_high", "s_low"]
GAP, AGAIN, LETTER = 0, 1, 2  # a word's part at a pair: it has nothing, a repeated letter, or a letter between
_RUN = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LETTERS},}}")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _lowered(text: str) -> str:
    """A-Z in lower case, no other letter."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def document_words(doc_id: str, text: str) -> Iterator[tuple[str, int]]:
    """Words of a text and how often they occur; a few lose a letter, as a checksum of the id and the word says."""
    found: Counter[str] = Counter()
    for part in slices(text):
        found.update(_RUN.findall(_lowered(part)))
    begin = crc32(f"{doc_id}:".encode())
    for word, n in found.items():
        h = crc32(word.encode(), begin)
        if h % CHANGED:
            yield word, n
        elif len(word) > LEAST_LETTERS:
            at = h % len(word)
            yield word[:at] + word[at + 1 :], n


def count_words(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """word, n over all texts; tasks count before they shuffle."""

    def sent(counts: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = defaultdict(int)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch), strict=True):
                for word, n in document_words(doc_id or "", text):
                    counts[word] += n
                if len(counts) > HELD:
                    yield sent(counts)
                    counts.clear()
        yield sent(counts)

    words = docs.select(F.col(key).cast("string"), "text").mapInArrow(run, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n"))


def node_numbers(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For a row of letters (1 to 255) for each word: both numbers of the nodes at depth 0, 1, 2 ..."""
    rows, depth = letters.shape
    high, low = np.zeros((rows, depth + 1), np.uint64), np.zeros((rows, depth + 1), np.uint64)
    for k in range(depth):
        if k % 8:
            high[:, k + 1], low[:, k + 1] = high[:, k], low[:, k] << np.uint64(8) | letters[:, k]
        else:
            mixed = high[:, k] * _MIX
            mixed ^= mixed >> np.uint64(29)
            high[:, k + 1], low[:, k + 1] = mixed * _MIX + low[:, k], letters[:, k]
    return high, low


def _pairs(ids: np.ndarray, counts: np.ndarray, words: list[str]) -> Iterator[pa.RecordBatch]:
    """The pairs of words of one length, in portions."""
    letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)
    p_high, p_low = node_numbers(letters.astype(np.uint64))
    s_high, s_low = (numbers[:, ::-1] for numbers in node_numbers(letters[:, ::-1].astype(np.uint64)))
    length = letters.shape[1]
    first = np.full(letters.shape, LETTER, np.int8)
    first[:, 1:][letters[:, 1:] == letters[:, :-1]] = AGAIN
    gap = np.full((len(words), length + 1), GAP, np.int8)
    for part, before, after in ((first, slice(0, length), slice(1, None)), (gap, slice(None), slice(None))):
        columns = [p_high[:, before], p_low[:, before], s_high[:, after], s_low[:, after]]
        wide = part.shape[1]
        for start in range(0, part.size, PORTION):
            at = np.arange(start, min(start + PORTION, part.size))
            row, place = at // wide, at % wide
            made = [pa.array(numbers[row, place].view(np.int64)) for numbers in columns]
            yield pa.RecordBatch.from_arrays([*made, pa.array(ids[row]), pa.array(counts[row]), pa.array(part[row, place])], names=[*PAIR, "id", "n", "part"])


def pairs(words: DataFrame) -> DataFrame:
    """The pairs of trie nodes of each word of ``words(id, n, word)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts = (np.asarray(batch.column(k)) for k in (0, 1))
            texts = batch.column(2).to_pylist()
            of_length: dict[int, list[int]] = defaultdict(list)
            for row, word in enumerate(texts):
                of_length[len(word)].append(row)
            for length, rows in of_length.items():
                step = max(1, PORTION // length)
                for start in range(0, len(rows), step):
                    at = rows[start : start + step]
                    yield from _pairs(ids[at], counts[at], [texts[row] for row in at])

    return words.select("id", "n", "word").mapInArrow(run, ", ".join(f"{name} long" for name in PAIR) + ", id long, n long, part byte")


def neighbours(words: DataFrame) -> DataFrame:
    """id, n_near, best (n and -id of the best near word) of each word that has a near one."""
    here = Window.partitionBy(*PAIR)
    ranked = here.orderBy(F.desc("n"), "id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rank = F.struct("n", (-F.col("id")).alias("id"))
    met = (
        pairs(words)
        .withColumns({"top": F.first(rank).over(ranked), "next": F.nth_value(rank, 2).over(ranked)})
        .withColumns({f"n_{part}": F.count_if(F.col("part") == part).over(here) for part in (GAP, AGAIN, LETTER)})
        .filter("next is not null")  # alone at the pair else
    )
    letter = F.col(f"n_{AGAIN}") + F.col(f"n_{LETTER}") - 1 + F.when(F.col("part") == LETTER, F.col(f"n_{GAP}")).otherwise(0)
    near = F.when(F.col("part") == GAP, F.col(f"n_{LETTER}")).otherwise(letter)
    best = F.when(F.col("top.id") == -F.col("id"), F.col("next")).otherwise(F.col("top"))
    return met.select("id", near.alias("near"), best.alias("best")).groupBy("id").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))


def _roots(forms: DataFrame, rounds: int) -> DataFrame:
    """id, root for ``forms(id, form)``: forms followed to the last, twice as far in each round."""
    roots = forms.withColumnRenamed("form", "root")
    for _ in range(rounds):
        further = roots.select(F.col("id").alias("root"), F.col("root").alias("further"))
        roots = materialize(roots.join(further, "root", "left").select("id", F.coalesce("further", "root").alias("root")), "roots")
    return roots


def variants(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """word, form, root, n, n_near, form_n of each word of at least ``LEAST_COUNT`` occurrences."""
    counted = materialize(count_words(docs, key).filter(F.col("n") >= LEAST_COUNT), "words")
    # Numbers ascend with the words, so that ties fall to the smaller.
    words = materialize(counted.repartitionByRange("word").sortWithinPartitions("word").select(F.monotonically_increasing_id().alias("id"), "word", "n"), "numbered")
    form = F.col("best.n") >= 2 * F.col("n")
    near = materialize(
        words.join(neighbours(words), "id", "left")
        .select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(form, -F.col("best.id")).alias("form_id"), F.when(form, F.col("best.n")).alias("form_n")),
        "near",
    )
    most = words.agg(F.max("n")).first()[0] or LEAST_COUNT
    steps = int(math.log2(most / LEAST_COUNT))  # each form occurs at least twice as often
    roots = _roots(near.filter("form_id is not null").select("id", F.col("form_id").alias("form")), steps.bit_length())
    named = words.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    roots = roots.join(named, "root").select("id", "root_word")
    forms = words.select(F.col("id").alias("form_id"), F.col("word").alias("form"))
    whole = near.join(roots, "id", "left").join(forms, "form_id", "left")
    return whole.select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
