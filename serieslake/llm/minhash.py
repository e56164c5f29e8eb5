"""MinHash fingerprints of documents, their likeness, and near-duplicate classes.

A text's fingerprint holds, for each of 64 universal hash permutations (multiply, add, shift), the
least value (16 bits of it) over its shingles of five words, lower-cased; a text of fewer words is
one shingle, and all texts without words share one fingerprint.  The share of equal places estimates
the Jaccard likeness.

Near-duplicates are found among the different texts: those that share one of 16 bands of 4 places are
candidates, joined in Spark to the first text of each band.  The shingle sets of each connected group of candidates
are then compared, in pairs of blocks of bounded size, and links of a Jaccard likeness of 0.8 and more make the
classes.  No pairs leave a task but a spanning forest of its links.

Null texts read as empty.  Rows with equal doc_id are ordered by a hash of the text, a null doc_id comes last;
repeated rows are kept each.  Other columns are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from serieslake.llm.common import hash_filter, may_hold, on_batches, portions, slices, texts_of
from serieslake.llm.components import components
from serieslake.llm.words import Memo
from serieslake.session import materialize

SHINGLE, PLACES, BANDS = 5, 64, 16
_rng = np.random.default_rng(99)
_FACTOR = _rng.integers(0, 1 << 63, PLACES, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _rng.integers(0, 1 << 63, PLACES, np.uint64)
_STEPS = _rng.integers(0, 1 << 63, SHINGLE, np.uint64) * np.uint64(2) + np.uint64(1)
_EMPTY = np.uint64((1 << 64) - 1)

_words = Memo(lambda words: [xxh64_intdigest(word) for word in words])


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word."""
    made = []
    for part in slices(text):
        words = part.lower().split()
        made.append(np.fromiter(_words.values_of(words), np.uint64, len(words)))
    return made[0] if len(made) == 1 else np.concatenate(made)


def shingles(words: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of five words, of all words if there are fewer."""
    size = min(SHINGLE, len(words))
    if not size:
        return words
    count = len(words) - size + 1
    made = np.full(count, size, np.uint64)
    for k in range(size):
        made += words[k : k + count] * _STEPS[k]
    made ^= made >> np.uint64(29)
    made *= np.uint64(0xBF58476D1CE4E5B9)
    made ^= made >> np.uint64(32)
    return made


def least(segments: list[np.ndarray]) -> np.ndarray:
    """For each segment of shingles and each permutation the least value; all bits for an empty segment."""
    lengths = np.fromiter(map(len, segments), np.int64, len(segments)) + 1
    ends = np.cumsum(lengths)
    marks = ends - 1
    held = np.empty(int(ends[-1]), np.uint64)
    for segment, end in zip(segments, ends.tolist(), strict=True):
        held[end - 1 - len(segment) : end - 1] = segment
    out = np.empty((len(segments), PLACES), np.uint64)
    work = np.empty_like(held)
    for k in range(PLACES):
        np.multiply(held, _FACTOR[k], out=work)
        work += _SHIFT[k]
        work[marks] = _EMPTY
        out[:, k] = np.minimum.reduceat(work, ends - lengths)
    return out


def _short(values: np.ndarray) -> np.ndarray:
    """16 bits of each least value; its high bits are mostly zero, so all are mixed in."""
    return ((values ^ values >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48)).astype(np.uint16)


def signatures(texts: list[str]) -> np.ndarray:
    """The fingerprints of the texts: rows x places."""
    made = [_short(least([shingles(word_hashes(text)) for text in texts[a:b]])) for a, b in portions(texts)]
    return np.concatenate(made) if made else np.zeros((0, PLACES), np.uint16)


def edited(text: str, following: str) -> str:
    """The text with its last third of characters replaced by as many from the start of the next one."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def pair_signatures(texts: list[str], changed: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints of texts and of their edited forms; the part they share is hashed once."""
    segments = []
    for text, other in zip(texts, changed, strict=True):
        a, b = word_hashes(text), word_hashes(other)
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[:n] != b[:n])
        same = int(differ[0]) if len(differ) else n
        if same < SHINGLE:
            segments += [a[:0], shingles(a), shingles(b)]
        else:
            rest = same - SHINGLE + 1
            tails = [w[rest:] if len(w) - rest >= SHINGLE else w[:0] for w in (a, b)]
            segments += [shingles(a[:same]), *map(shingles, tails)]
    part = least(segments).reshape(-1, 3, PLACES)
    return _short(np.minimum(part[:, 0], part[:, 1])), _short(np.minimum(part[:, 0], part[:, 2]))


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of equal places, row by row."""
    return (a == b).mean(1)


def _raw(signature: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(signature, ">u2").tobytes()
    return pa.array([raw[i : i + 2 * PLACES] for i in range(0, len(raw), 2 * PLACES)], pa.binary())


_NUMBERS = "n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_NAMES = [field.split()[0] for field in _NUMBERS.split(", ")]


def _compare(ids: list[pa.Array], texts: list[str]) -> list[pa.Array]:
    """Results of all texts but the last, each with the text behind it; ``ids`` go before them."""
    changed = [edited(text, following) for text, following in zip(texts, texts[1:], strict=False)]
    own, other = pair_signatures(texts[:-1], changed)
    behind = np.concatenate([own[1:], signatures(texts[-1:])])
    return [
        *ids, pa.array(list(map(len, texts[:-1])), pa.int64()), pa.array([hashlib.sha256(c.encode()).hexdigest() for c in changed], pa.string()),
        _raw(own), _raw(other), pa.array(likeness(own, other)), pa.array(likeness(own, behind)),
    ]


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, key (a hash of the text) and the compressed text, so that less is shuffled."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
        packed = [zstandard.compress(text.encode(), 1) for text in texts_of(batch)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(packed, pa.binary())], names=["doc_id", "key", "packed"])

    return on_batches(docs.select("doc_id", "text", _key().alias("key")), pack, f"doc_id {kind}, key string, packed binary")


def _key():
    """128 bits that stand for a text."""
    return F.md5(F.coalesce("text", F.lit("")))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row of ``docs(doc_id, text)`` and of its edited text, and their likeness.

    The next document is the one behind in descending order of doc_id; behind the last comes the first.
    Rows are put in order by a range exchange; only a task's first and last text wait for the others.
    ``key`` is a hash of the text.  The result is read from stored tables, so it may be used more than once.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    result = f"doc_id {kind}, key string, {_NUMBERS}"
    names = ["doc_id", "key", *_NAMES, "part", "role", "text"]
    order = [F.col("doc_id").desc_nulls_last(), F.col("key"), F.col("packed")]
    ordered = _packed(docs).repartitionByRange(*order[:2]).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, held_ids = TaskContext.get().partitionId(), None, None
        blank = [pa.nulls(1, kind) for kind in (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64())]

        def edge(role: str, ids: list[pa.Array], text: str) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*ids, *blank, pa.array([part], pa.int32()), pa.array([role]), pa.array([text])], names=names)

        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                texts = [zstandard.decompress(raw).decode() for raw in batch.column("packed").to_pylist()]
                ids = [batch.column("doc_id"), batch.column("key")]
                if held is None:
                    yield edge("first", [c[:1] for c in ids], texts[0])
                for a, b in portions(texts):
                    here, keys = texts[a:b], [c[a:b] for c in ids]
                    if held is not None:
                        here, keys = [held, *here], [pa.concat_arrays(pair) for pair in zip(held_ids, keys, strict=True)]
                    if len(here) > 1:
                        made = _compare([c[:-1] for c in keys], here)
                        n = len(here) - 1
                        yield pa.RecordBatch.from_arrays(
                            [*made, pa.array(np.full(n, part, np.int32)), pa.nulls(n, pa.string()), pa.nulls(n, pa.string())], names=names
                        )
                    held, held_ids = here[-1], [c[-1:] for c in keys]
        if held is not None:
            yield edge("last", held_ids, held)

    made = materialize(ordered.mapInArrow(run, f"{result}, part int, role string, text string"), "fingerprints")
    firsts = made.filter("role = 'first'").select("part", F.col("text").alias("first"))
    lasts = made.filter("role = 'last'").select("part", "doc_id", "key", "text")
    parts = Window.orderBy("part")  # one row per part that holds rows
    whole = parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    behind = F.coalesce(F.lead("first").over(parts), F.first("first").over(whole))
    edges = lasts.join(firsts, "part").select("doc_id", "key", "text", behind.alias("behind"))

    def finish(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for i, (text, following) in enumerate(zip(texts_of(batch), texts_of(batch, "behind"), strict=True)):
            ids = [batch.column("doc_id")[i : i + 1], batch.column("key")[i : i + 1]]
            rows.append(pa.RecordBatch.from_arrays(_compare(ids, [text, following]), names=["doc_id", "key", *_NAMES]))
        return pa.Table.from_batches(rows).combine_chunks().to_batches()[0]

    finished = materialize(on_batches(edges, finish, result), "edge-fingerprints")
    return made.filter("role is null").select("doc_id", "key", *_NAMES).unionByName(finished)


#: Shingles laid side by side in a matrix, and pairs of sets listed, at a time.
COLUMNS, PAIRS = 1024, 1 << 20


def _ranges(first: np.ndarray, number: np.ndarray) -> np.ndarray:
    """The numbers from each first one on, as many as given."""
    ends = np.cumsum(number)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + number, number)


def _holders(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The different shingles in order; where each one's holders begin, how many there are; the holders."""
    held = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    order = np.argsort(held)
    held = held[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(held)), bool), held[1:] != held[:-1]]))
    owners = np.repeat(np.arange(len(sets)), list(map(len, sets)))[order]
    return held[first], first, np.diff(first, append=len(held)), owners


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set on the left shares with each on the right; the sets are without repeats.

    Shingles with many holders are counted by products of 0/1 matrices, others by listing the pairs of their holders.
    """
    counts = np.zeros((len(left), len(right)), np.int32)
    a = _holders(left)
    b = a if right is left else _holders(right)
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    sides = [(first[at], number[at], owners) for (_, first, number, owners), at in ((a, i), (b, j))]
    (first_a, number_a, owners_a), (first_b, number_b, owners_b) = sides
    pairs = number_a * number_b
    frequent = pairs * 256 > counts.size
    common, rare = np.flatnonzero(frequent), np.flatnonzero(~frequent)
    for at in range(0, len(common), COLUMNS):
        chosen, held = common[at : at + COLUMNS], []
        for (first, number, owners), size in zip(sides, counts.shape, strict=True):
            held.append(np.zeros((size, len(chosen)), np.float32))
            held[-1][owners[_ranges(first[chosen], number[chosen])], np.repeat(np.arange(len(chosen)), number[chosen])] = 1
        counts += (held[0] @ held[1].T).astype(np.int32)
    ends = np.cumsum(pairs[rare])
    for chosen in np.split(rare, np.searchsorted(ends, np.arange(PAIRS, ends[-1] if len(ends) else 0, PAIRS))):
        shingle, nth = np.repeat(chosen, pairs[chosen]), _ranges(np.zeros(len(chosen), np.int64), pairs[chosen])
        i = owners_a[first_a[shingle] + nth // number_b[shingle]]
        j = owners_b[first_b[shingle] + nth % number_b[shingle]]
        np.add.at(counts.reshape(-1), i * len(right) + j, 1)
    return counts


def jaccard_forest(sets: list[np.ndarray], least_likeness: float, others: list[np.ndarray] | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of shingle sets (without repeats) that are that alike.

    With ``others``, of the pairs of one of ``sets`` and one of ``others``, which are numbered behind them.
    """
    right = sets if others is None else others
    shared = shared_counts(sets, right)
    sizes = [np.fromiter(map(len, side), np.int64, len(side)) for side in (sets, right)]
    alike = np.empty(shared.shape, bool)
    for row, here in enumerate(shared):
        alike[row] = here >= least_likeness * (sizes[0][row] + sizes[1] - here)
    behind = 0 if others is None else len(sets)
    back = alike if others is None else np.ascontiguousarray(alike.T)
    rest, forest = np.ones(behind + len(right), bool), []
    for seed in range(len(rest)):
        front = [seed] if rest[seed] else []
        rest[seed] = False
        while front:
            i = front.pop()
            row, start = (alike[i], behind) if i < len(sets) else (back[i - behind], 0)
            near = (np.flatnonzero(row & rest[start : start + len(row)]) + start).tolist()
            rest[near] = False
            forest += [(i, j) for j in near]
            front += near
    return forest


def near_classes(docs: DataFrame, prints: DataFrame, least_likeness: float = 0.8, block: int = 2048, block_bytes: int = 8 << 20) -> DataFrame:
    """key, root of each text that has near-duplicates; ``prints(key, fingerprint)`` are of the texts of ``docs``.

    A group of candidates is dealt to as many blocks as hold about ``block`` texts and ``block_bytes`` of their sets each.
    """
    texts = materialize(prints.groupBy("key").agg(F.first("fingerprint").alias("fingerprint")), "texts")  # equal texts are one
    width = 2 * PLACES // BANDS
    bands = texts.select("key", F.explode(F.array(*[
        F.xxhash64(F.lit(k), F.substring("fingerprint", F.lit(1 + k * width), F.lit(width))) for k in range(BANDS)
    ])).alias("band"))
    first = bands.groupBy("band").agg(F.min("key").alias("b"), F.max("key").alias("other")).filter("b <> other")
    candidates = bands.join(first.drop("other"), "band").filter("key <> b").select(F.col("key").alias("a"), "b")
    groups = materialize(components(candidates), "candidates")
    sent = docs.sparkSession.sparkContext.broadcast(hash_filter(groups.select(F.xxhash64("node").alias("hash")), "hash"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()  # a task gives each text's set once, however many copies it holds
        for batch in batches:
            nodes, rows = batch.column("node").to_pylist(), []
            for row in np.flatnonzero(may_hold(sent.value, np.asarray(batch.column("hash")))).tolist():
                if nodes[row] not in seen:
                    seen.add(nodes[row])
                    rows.append(row)
            if rows:
                picked = batch.take(pa.array(rows))
                made = [np.unique(shingles(word_hashes(text))).tobytes() for text in texts_of(picked)]
                yield pa.RecordBatch.from_arrays([picked.column("node"), pa.array(made, pa.binary())], names=["node", "set"])

    keyed = docs.select("text", _key().alias("node"))
    found = keyed.withColumn("hash", F.xxhash64("node")).mapInArrow(sets, "node string, set binary")
    held = materialize(found.join(groups, "node").dropDuplicates(["node"]), "sets")
    blocks = F.ceil(F.greatest(F.count("*") / block, F.sum(F.length("set")) / block_bytes)).cast("int")
    large = materialize(held.groupBy("root").agg(blocks.alias("blocks")).filter("blocks > 1"), "blocks")  # few, so the sets stay
    dealt = held.join(large, "root", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = dealt.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    pairs = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "root", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), (F.col("own") > F.col("other")).alias("second"), "node", "set"
    )

    def verify(group: pa.Table) -> pa.Table:
        sides: tuple[list, list] = ([], [])
        for node, raw, second in zip(group["node"].to_pylist(), group["set"].to_pylist(), group["second"].to_pylist(), strict=True):
            sides[second].append((node, np.frombuffer(raw, np.uint64)))
        sets, others = ([s for _, s in side] for side in sides)
        # a pair of two blocks leaves out what each block finds by itself
        links = jaccard_forest(sets, least_likeness, None if group["p"][0].equals(group["q"][0]) else others)
        nodes = [node for side in sides for node, _ in side]
        return pa.table([pa.array([nodes[i] for i, _ in links], pa.string()), pa.array([nodes[j] for _, j in links], pa.string())], names=["a", "b"])

    return components(pairs.groupBy("root", "p", "q").applyInArrow(verify, "a string, b string")).select(F.col("node").alias("key"), "root")


def fingerprints_and_classes(docs: DataFrame) -> DataFrame:
    """``fingerprint_documents`` with fingerprints in hex and ``class_id``, the smallest doc_id of its near-duplicates."""
    made = fingerprint_documents(docs)
    near = materialize(near_classes(docs, made.select("key", "fingerprint")), "near-classes")
    ids = made.groupBy("key").agg(F.min("doc_id").alias("id")).join(near, "key", "left").withColumn("root", F.coalesce("root", "key"))
    ids = materialize(ids, "ids")
    named = ids.join(ids.groupBy("root").agg(F.min("id").alias("class_id")), "root").select("key", "class_id")
    shown = {name: F.lower(F.hex(name)) for name in ("fingerprint", "edited_fingerprint")}
    return made.join(named, "key").drop("key").withColumns(shown)
