"""Benchmark decontamination by templates: verbatim and re-parameterised items are found in documents.

Words are made canonical: numbers, names (capitalized within a sentence) and units become typed
placeholders, all else is lower-cased.  Windows of eight canonical words are hashed in three variants: names
as plain words (so that lost capitals and full stops do not matter), names within sentences as placeholders,
and every capitalized word as one (a sentence may begin with a name).  They are joined with those of the benchmark.  A filter of fixed size (8 MB) holds the benchmark's window hashes, so that
only windows that may match leave the scan; the join decides.  Matches of one document and item on
one alignment must fill the slots consistently (first words of sentences count in the third variant alone): one value of the item stands for one value in the
document, one name in the document for one of the item.  Windows with other values are dropped.
A document holds an item if ``least`` of its windows (all, if it has fewer) match, or as many of those that
have words enough beside the placeholders of a variant.

Windows with too few words beside numbers and units are hashed by their words as they are, and matched verbatim.
Items of fewer than eight words are matched as a whole, those of fewer than four where a line or a text is
nothing else (of items without a word, the characters).
Null and empty texts hold nothing and are held by nothing.  Items of equal text are one item, named by
the smallest id (null if none has one).  Repeated rows are reported once, and decisions depend on the text alone.  Other columns are not read, and kept by ``keep_clean``.  Empty tables give empty results.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import cache, reduce
from itertools import islice, product
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from serieslake.llm.common import hash_filter, may_hold, portions, slices, texts_of
from serieslake.session import materialize

WIDTH, FEWEST, LEAST, FIXED_WORDS = 8, 4, 6, 4

# Unit and number words.
UNITS = frozenset("""
mm cm dm m km in ft yd mi inch inches foot feet yard yards mile miles metre metres meter meters kilometre kilometres kilometer kilometers
mg g kg t oz lb lbs gram grams kilogram kilograms ton tons tonne tonnes ounce ounces pound pounds ml cl l litre litres liter liters gallon gallons pint pints
ms s sec min h hr hrs second seconds minute minutes hour hours day days week weeks month months year years kmh mph hz khz mhz ghz kb mb gb tb
cent cents dollar dollars euro euros usd eur gbp percent degree degrees watt watts volt volts joule joules
""".split())
NUMBERS = frozenset("""
zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen
twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion
""".split())

_WORD = re.compile(r"\d+(?:[.,:/]\d+)*|[^\W\d_]+(?:['’][^\W\d_]+)*|[$€£¥%°]")
_ENDS = re.compile(r"[.!?:;]\W*$")
_ENTRY = np.dtype([("word", "<u8"), ("kind", "u1"), ("ends", "u1")])
_PACKED = struct.Struct("<QBB")
NUMBER, UNIT, NAME = 1, 2, 3  # kinds of words; 0 is any other
_PLACEHOLDERS = np.array([0, *(xxh64_intdigest(f"<{kind}>") for kind in ("number", "unit", "name"))], np.uint64)
# Variants of windows: names as plain words, as placeholders within sentences, as placeholders everywhere.
PLAIN, WITHIN, EVERYWHERE = (0, 1, 2)
VERBATIM = 3  # the windows that have too few words beside placeholders in PLAIN, by their words
VARIANTS = (PLAIN, WITHIN, EVERYWHERE, VERBATIM)
LINE = 4  # whole lines and texts
_BASE = int(np.random.default_rng(31).integers(0, 1 << 63)) * 2 + 1
_BACK = pow(_BASE, -1, 1 << 64)


def _kind(word: str, lower: str) -> int:
    if word[0].isdigit() or lower in NUMBERS:
        return NUMBER
    if lower in UNITS or not word[0].isalpha():
        return UNIT
    return NAME if word[0].isupper() and not word.isupper() else 0


class _Entries(dict):
    """For each chunk its words, packed: hash, kind, sentence end.  Emptied when it holds too many."""

    def __init__(self, most: int = 650_000) -> None:
        super().__init__()
        self.most = most

    def __missing__(self, chunk: str) -> bytes:
        if len(self) > self.most:
            self.clear()
        ends = chunk[-1] in ".!?:;"
        word = chunk[:-1] if ends or chunk[-1] == "," else chunk
        if word.isalpha():  # one word and perhaps a mark, as most chunks are
            lower = word.lower()
            made = _PACKED.pack(xxh64_intdigest(lower), _kind(word, lower), ends)
        else:
            words = _WORD.findall(chunk)
            last = len(words) - 1 if _ENDS.search(chunk) else -1
            made = b"".join([_PACKED.pack(xxh64_intdigest(word.lower()), _kind(word, word.lower()), k == last) for k, word in enumerate(words)])
        self[chunk] = made
        return made


_chunks = _Entries()


def canonical(text: str) -> np.ndarray:
    return np.frombuffer(b"".join([b"".join(map(_chunks.__getitem__, part.split())) for part in slices(text)]), _ENTRY)


def slots_of(words: np.ndarray, owner: np.ndarray, variant: int) -> np.ndarray:
    """Which words are placeholders in this variant."""
    if variant == VERBATIM:
        return np.zeros(len(words), bool)
    if variant == EVERYWHERE:
        return words["kind"] > 0
    slot = (words["kind"] == NUMBER) | (words["kind"] == UNIT)
    if variant == WITHIN:
        slot[1:] |= (words["kind"][1:] == NAME) & (words["ends"][:-1] == 0) & (owner[1:] == owner[:-1])
    return slot


@cache
def _powers(base: int, size: int) -> np.ndarray:
    factors = np.full(size, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


def _mixed(hashes: np.ndarray, seed: int) -> np.ndarray:
    hashes = hashes + np.uint64(seed)
    hashes ^= hashes >> np.uint64(31)
    hashes *= np.uint64(0x94D049BB133111EB)
    hashes ^= hashes >> np.uint64(29)
    return hashes


def template_windows(words: np.ndarray, owner: np.ndarray, width: int, variant: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``width`` words within one text that the variant takes, and where they begin."""
    count = len(words) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    slot = slots_of(words, owner, PLAIN if variant == VERBATIM else variant)
    filled = np.zeros(len(words) + 1, np.int32)
    np.cumsum(slot, out=filled[1:])
    enough = width - (filled[width:] - filled[:-width]) >= min(FIXED_WORDS, width)
    at = np.flatnonzero((owner[:count] == owner[width - 1 :]) & (enough != (variant == VERBATIM)))
    if variant == VERBATIM:  # few, so each by itself
        factors = _powers(_BASE, WIDTH)
        sums = np.zeros(len(at), np.uint64)
        for k in range(width):
            sums += words["word"][at + k] * factors[k]
        return _mixed(sums, 8 * width + variant), at
    token = words["word"].copy()
    filled = np.flatnonzero(slot)
    token[filled] = _PLACEHOLDERS[words["kind"][filled]]
    # Differences of prefix sums of powers, divided by the power at the window's begin.
    size = 1 << len(words).bit_length()
    token *= _powers(_BASE, size)[: len(words)]
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(token, out=sums[1:])
    hashes = _mixed((sums[width:] - sums[:-width]) * _powers(_BACK, size)[:count], 8 * width + variant)
    return hashes[at], at


def _slots(slot: np.ndarray, surface: list[str], at: int, width: int) -> tuple[list[int], list[str]]:
    """Places and values of the slots in the window at ``at`` of one text."""
    places = [k for k in range(at, at + width) if slot[k]]
    return places, [surface[k] for k in places]


def _line(words: list[str], text: str) -> int:
    """Hash of a line or text of few words; without a word, of its characters."""
    return xxh64_intdigest(" ".join(words) or "".join(text.split()), 8 * len(words) + LINE)


def short_lines(text: str) -> Iterator[tuple[int, int]]:
    """Hash and first character of each line of fewer than ``FEWEST`` words, and of the whole text if it is as short."""
    many, at = 0, 0
    for line in text.split("\n"):
        words = [found[0].lower() for found in islice(_WORD.finditer(line), FEWEST)]
        many += len(words)
        if len(words) < FEWEST and (words or line.strip()):
            yield _line(words, line), at
        at += len(line) + 1
    if many < FEWEST and "\n" in text and text.strip():
        yield _line(_surface(text), text), 0


def _surface(text: str) -> list[str]:
    return [word.lower() for part in slices(text) for chunk in part.split() for word in _WORD.findall(chunk)]


KEYS = ["key1", "key2"]
LEVELS = (0, 1, 2, 3)


def _keyed(docs: DataFrame) -> DataFrame:
    """Two hashes of the text stand for it."""
    return docs.withColumns({"key1": F.xxhash64("text"), "key2": F.xxhash64(F.lit(1), "text")})


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """item, item_id, hash, variant, at, width, level, levels, places, values for each distinct benchmark text.

    A window of level k has words enough in the first k variants, ``levels`` holds how many have k and more (from 0).
    """
    items = benchmark.filter("text is not null").groupBy("text").agg(F.min("item_id").alias("item_id")).withColumn("item", F.xxhash64("text"))
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, item_id, text in zip(batch.column("item").to_pylist(), batch.column("item_id").to_pylist(), texts_of(batch), strict=True):
                words, surface = canonical(text), _surface(text)
                width = min(WIDTH, len(words))
                if width >= FEWEST:
                    owner = np.zeros(len(words), np.int64)
                    level = np.zeros(len(words), np.int64)
                    found = {variant: template_windows(words, owner, width, variant) for variant in VARIANTS}
                    for variant in (PLAIN, WITHIN, EVERYWHERE):
                        level[found[variant][1]] += 1  # each variant has placeholders where the one before has them
                    windows = len(words) - width + 1
                    levels = [int((level[:windows] >= k).sum()) for k in LEVELS]
                    for variant, (hashes, at) in found.items():
                        slot = slots_of(words, owner, variant)
                        rows += [
                            (item, item_id, h, variant, a, width, int(level[a]), levels, *_slots(slot, surface, a, width))
                            for h, a in zip(hashes.view(np.int64).tolist(), at.tolist(), strict=True)
                        ]
                elif text.strip():
                    h = int(np.uint64(_line(surface, text)).view(np.int64))
                    rows.append((item, item_id, h, LINE, 0, width, 0, [1, 0, 0, 0], [], []))
            if rows:
                whole, many = pa.int32(), pa.list_(pa.int32())
                kinds = [pa.int64(), batch.schema.field("item_id").type, pa.int64(), whole, whole, whole, whole, many, many, pa.list_(pa.string())]
                names = ["item", "item_id", "hash", "variant", "at", "width", "level", "levels", "places", "values"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    schema = f"item long, item_id {kind}, hash long, variant int, at int, width int, level int, levels array<int>, places array<int>, values array<string>"
    return materialize(items.mapInArrow(run, schema), "benchmark-windows")


def matches(docs: DataFrame, benchmark: DataFrame, least: int = LEAST) -> DataFrame:
    """key1, key2, item_id, n_windows, coverage, reparameterised, first_word of each text and item it holds."""
    windows = benchmark_windows(benchmark)
    sent = docs.sparkSession.sparkContext.broadcast(hash_filter(windows, "hash"))
    found = [row.width for row in windows.select("width").distinct().collect()]  # WIDTH and less
    widths, short = [width for width in found if width >= FEWEST], any(width < FEWEST for width in found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for batch in batches:
            texts, picked, rows = texts_of(batch), [], []
            for start, stop in portions(texts):
                words = [canonical(text) for text in texts[start:stop]]
                owner = np.repeat(np.arange(stop - start), [len(w) for w in words])
                joined, begins = np.concatenate(words), np.cumsum([0, *map(len, words)])
                for width, variant in product(widths, VARIANTS):
                    hashes, at = template_windows(joined, owner, width, variant)
                    hit = np.flatnonzero(may_hold(bits, hashes))
                    slot = slots_of(joined, owner, variant) if len(hit) else None
                    surface: dict[int, list[str]] = {}
                    for h, a in zip(hashes[hit].view(np.int64).tolist(), at[hit].tolist(), strict=True):
                        k = int(owner[a])
                        if k not in surface:
                            surface = {k: _surface(texts[start + k])}
                        begin = int(begins[k])
                        picked.append(start + k)
                        rows.append((h, a - begin, *_slots(slot[begin : begin + len(words[k])], surface[k], a - begin, width)))
            for k, text in enumerate(texts if short else ()):
                lines = list(short_lines(text))
                hashes = np.array([h for h, _ in lines], np.uint64)
                for i in np.flatnonzero(may_hold(bits, hashes)).tolist():
                    picked.append(k)
                    rows.append((int(hashes[i].view(np.int64)), len(_surface(text[: lines[i][1]])), [], []))
            if rows:
                kept = [batch.column(name).take(pa.array(picked)) for name in KEYS]
                types = [pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.string())]
                made = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([*kept, *made], names=[*KEYS, "hash", "doc_at", "doc_places", "doc_values"])

    schema = "key1 long, key2 long, hash long, doc_at int, doc_places array<int>, doc_values array<string>"
    found = _keyed(docs.select("text")).mapInArrow(run, schema).dropDuplicates([*KEYS, "hash", "doc_at"])
    joined = materialize(found.join(windows, "hash").withColumn("shift", F.col("doc_at") - F.col("at")), "template-matches")
    joined = joined.withColumn("starts", F.col("variant") == EVERYWHERE)  # these may not outvote the others
    alignment = [*KEYS, "item", "shift", "starts"]
    slots = joined.select(*alignment, F.inline(F.arrays_zip("places", "values", "doc_values"))).distinct()
    # Each value of the item keeps the document's value that it has most often; ties fall to the smaller.
    votes = slots.groupBy(*alignment, "values", "doc_values").agg(F.count("*").alias("n"))
    ranked = Window.partitionBy(*alignment, "values").orderBy(F.desc("n"), "doc_values")
    back = Window.partitionBy(*alignment, "doc_values").orderBy(F.desc("n"), "values")
    odd = (
        votes.withColumn("rank", F.row_number().over(ranked)).withColumn("back", F.row_number().over(back))
        # Two different numbers may become equal; two names may not become one.
        .filter((F.col("rank") > 1) | ((F.col("back") > 1) & ~F.col("doc_values").rlike("^[0-9]")))
        .select(*alignment, "values", "doc_values")
    )
    wrong = slots.join(odd, [*alignment, "values", "doc_values"], "left_semi").groupBy(*alignment).agg(F.collect_set("places").alias("wrong"))
    checked = joined.join(wrong, alignment, "left")
    consistent = checked.filter(F.col("wrong").isNull() | ~F.arrays_overlap("wrong", "places"))
    places = consistent.groupBy(*KEYS, "item", "at").agg(
        F.first("item_id").alias("item_id"), F.first("level").alias("level"), F.first("levels").alias("levels"),
        F.min("doc_at").alias("first_word"), F.max(F.col("values") != F.col("doc_values")).alias("reparameterised"),
    )
    held = places.groupBy(*KEYS, "item").agg(
        F.first("item_id").alias("item_id"), F.count("*").alias("n_windows"), F.first("levels").alias("levels"),
        F.min("first_word").alias("first_word"), F.max("reparameterised").alias("reparameterised"),
        *(F.count_if(F.col("level") >= k).alias(f"n{k}") for k in LEVELS),
    )
    of = {k: F.col("levels")[i] for i, k in enumerate(LEVELS)}
    enough = held.filter(reduce(or_, ((of[k] > 0) & (F.col(f"n{k}") >= F.least(F.lit(least), of[k])) for k in LEVELS)))
    return enough.select(*KEYS, "item_id", "n_windows", (F.col("n_windows") / F.col("levels")[0]).alias("coverage"), "reparameterised", "first_word")


def leaks(docs: DataFrame, benchmark: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, item_id, n_windows, coverage, reparameterised, first_word of each document and item it holds."""
    held = materialize(matches(docs, benchmark, least), "leaks")
    return _keyed(docs.select("doc_id", "text")).drop("text").distinct().join(held, KEYS).drop(*KEYS)


def keep_clean(docs: DataFrame, benchmark: DataFrame, least: int = LEAST) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns."""
    held = materialize(matches(docs, benchmark, least).select(F.col("key1").alias("_key1"), F.col("key2").alias("_key2")).distinct(), "leaking")
    return docs.join(held, (F.xxhash64("text") == F.col("_key1")) & (F.xxhash64(F.lit(1), "text") == F.col("_key2")), "left_anti")
