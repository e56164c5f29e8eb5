"""Token counts of whole texts by a compiled finite-state tokenizer.

A text is cut into chunks.  Each chunk becomes a state map: what it emits and in which state it
leaves the transducer, as a function of the state it is entered in.  Behind a border of pre-tokens (white
space, a mark or digit behind a letter) nothing depends on the entry, so a map is the head up to the first border, a count, and the
tail behind the last.  A chunk within a run of letters has no border; its map goes from the token over its left border to the
token over its right one (``run_maps``).  Maps compose associatively; those of a long text, made by different tasks, are
combined in order.  A chunk without a border that is no run of plain letters (half a million symbols in a row, say) is kept
as it is and joined to its neighbours.

Null and empty texts have no tokens.  Repeated rows are counted each; other columns are not read,
so their names cannot clash.  An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable
from itertools import accumulate, islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from serieslake.llm.common import long_parts, on_batches, portions, slices, texts_of
from serieslake.llm.run_maps import RunMaps, joined, packed, unpacked
from serieslake.llm.transducer import Transducer
from serieslake.llm.words import WHITE, Memo, Pretokens, chunks_of
from serieslake.session import materialize


#: Letters whose normal form, in lower case, is one letter and joins nothing behind it.
PLAIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017f\u0391-\u03a1\u03a3-\u03a9\u03b1-\u03c9\u0410-\u044f\u3041-\u3096\u30a1-\u30fa\u3400-\u4dbf\u4e00-\u9fff"
# Places where a pre-token ends whatever stands around them.
_BORDER = regex.compile(rf"(?<=[{PLAIN}])(?=[\p{{P}}--[']]|[0-9])|(?<=[0-9])(?=[0-9]|[{PLAIN}])", regex.VERSION1)
_RUN = re.compile(f"[{PLAIN}]+")
_RUN_BEGIN = regex.compile(rf"((?:.*[\p{{P}}0-9--[']])?)([{PLAIN}]+)", regex.DOTALL | regex.VERSION1)
_RUN_END = regex.compile(rf"([{PLAIN}]+)((?:[\p{{P}}0-9].*)?)", regex.DOTALL | regex.VERSION1)
AROUND = 64  # characters that a part shows of its neighbours; no token is longer


class StateMap(NamedTuple):
    """``closed``: the chunk holds a border; else the whole of it is ``head``, and ``links`` its map if it lies within a run of letters."""

    head: str
    count: int
    tail: str
    closed: bool
    links: bytes = b""


class TokenCounter:
    def __init__(self, path: str) -> None:
        self.transducer = Transducer(path)
        self.pretokens = Pretokens(Tokenizer.from_file(path))
        self.memo = Memo(self._new)
        self.runs = RunMaps(self.transducer)
        if self.runs.longest > AROUND - 8:
            raise ValueError(f"{path} has tokens of {self.runs.longest} bytes")

    def _new(self, chunks: list[str]) -> list[int]:
        split = [self.pretokens.split(chunk) for chunk in chunks]
        number: dict[bytes, int] = {}
        index = [[-1 if piece is None else number.setdefault(piece, len(number)) for piece in pieces] for pieces in split]
        counts = [*self.transducer.counts(list(number)).tolist(), 1]  # at -1: a special string
        return [sum([counts[i] for i in pieces]) for pieces in index]

    def count(self, chunks: list[str]) -> int:
        return sum(self.memo.values_of(chunks))

    def counts(self, texts: list[str]) -> list[int]:
        totals: list[int] = []
        for start, stop in portions(texts):
            if stop == start + 1:
                totals.append(sum(self.count(chunks_of(part)) for part in slices(texts[start])))
                continue
            split = [chunks_of(text) for text in texts[start:stop]]
            values = self.memo.values_of([chunk for chunks in split for chunk in chunks])
            totals += [sum(islice(values, len(chunks))) for chunks in split]
        return totals

    def state_map(self, text: str, before: int = 0, size: int | None = None) -> StateMap:
        """The map of ``size`` characters of a text, ``before`` of which stand before them."""
        own = text[before : len(text) if size is None else before + size]
        if before >= AROUND and len(text) >= before + len(own) + AROUND and _RUN.fullmatch(text):
            symbols = self.runs.symbols
            around = symbols(text[:before])
            return StateMap(own, 0, "", False, packed(self.runs.links(around + symbols(text[before:]), len(around), len(symbols(own)))))
        gaps = [found.start() for found in (WHITE.search(own), _BORDER.search(own, 1)) if found is not None]
        if not gaps:
            return StateMap(own, 0, "", False)
        first = min(gaps)
        tail = own[max(len(own) - AROUND * 4, first) :]
        last = max([found.start() for found in (*WHITE.finditer(tail), *_BORDER.finditer(tail, 1))], default=None)
        if last is None:  # no border near the end: look through all
            tail = own[first:]
            last = max([found.start() for found in (*WHITE.finditer(tail), *_BORDER.finditer(tail, 1))], default=0)
        last += len(own) - len(tail)
        return StateMap(own[:first], self.count(chunks_of(own[first:last])), own[last:], True)

    def combine(self, a: StateMap, b: StateMap) -> StateMap:
        if not a.closed:
            return StateMap(a.head + b.head, b.count, b.tail, b.closed)
        if not b.closed:
            return StateMap(a.head, a.count, a.tail + b.head, True)
        return StateMap(a.head, a.count + b.count + self.piece(a.tail + b.head), b.tail, True)

    def finish(self, whole: StateMap) -> int:
        return whole.count + self.piece(whole.head) + self.piece(whole.tail)

    def piece(self, text: str) -> int:
        return self.count(chunks_of(text)) if text else 0

    def total(self, maps: list[StateMap]) -> int:
        """Tokens of the text that the maps make up, in order."""
        total, held = 0, []
        for one in (*maps, StateMap("", 0, "", True)):
            if not one.closed:
                held.append(one)
                continue
            total += self.between(held, one.head) + one.count
            held = [StateMap(one.tail, 0, "", False)]
        return total

    def between(self, held: list[StateMap], head: str) -> int:
        """Tokens of what stands between two borders: a tail, chunks without a border, a head."""
        maps = [one for one in held if one.links]
        begin, end = (_RUN_BEGIN.fullmatch(held[0].head) if maps else None), _RUN_END.fullmatch(head)
        if begin is None or end is None or len(maps) < len(held) - 1 or min(len(begin[2]), len(end[1])) < AROUND:
            return self._as_it_is([*(one.head for one in held), head])
        symbols = self.runs.symbols
        opening, closing = symbols(begin[2]), symbols(end[1], last=True)
        behind, ahead = symbols(maps[-1].head[-AROUND:]), symbols(maps[0].head[:AROUND])
        chain = self.runs.links(opening + ahead, 0, len(opening), first=True)
        for one in maps:
            chain = joined({0: chain[0]}, unpacked(one.links))
        chain = joined(chain, self.runs.links(behind + closing, len(behind), len(closing), last=True))
        (count,) = chain[0].values()
        return self.piece(begin[1]) + count + self.piece(end[2])

    def _as_it_is(self, parts: list[str]) -> int:
        return self.piece("".join(parts))


@functools.cache
def counter(path: str) -> TokenCounter:
    """One per Python worker and file; the compiled states stay for the next task."""
    return TokenCounter(path)


def scan(maps: list[StateMap], combine: Callable[[StateMap, StateMap], StateMap], block: int = 64) -> list[StateMap]:
    """All prefixes: scans of blocks, a scan over the blocks' totals, and the totals put before each block."""
    if len(maps) <= block:
        return list(accumulate(maps, combine))
    blocks = [list(accumulate(maps[i : i + block], combine)) for i in range(0, len(maps), block)]
    before = scan([b[-1] for b in blocks[:-1]], combine, block)
    return blocks[0] + [combine(p, m) for p, b in zip(before, blocks[1:], strict=True) for m in b]


def count_tokens(docs: DataFrame, path: str, chunk: int = 32_768) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every row of ``docs(doc_id, text)``.

    ``path`` names the tokenizer file; texts over ``chunk`` characters are cut into parts, which go to
    tasks of their own.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    long = F.coalesce(F.length("text"), F.lit(0)) > chunk

    def whole(batch: pa.RecordBatch) -> pa.RecordBatch:
        totals = counter(path).counts(texts_of(batch))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(totals, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    short = on_batches(rows.filter(~long), whole, f"doc_id {kind}, n_bytes long, n_tokens long")

    names = ["row", "part", "doc_id", "n_bytes"]

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        before = batch.column("before").to_pylist()
        made = [counter(path).state_map(text, k, chunk) for text, k in zip(texts_of(batch), before, strict=True)]
        columns = [batch.column(name) for name in names] + [pa.array(list(c)) for c in zip(*made, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=[*names, *StateMap._fields])

    numbered = materialize(rows.filter(long).withColumn("row", F.monotonically_increasing_id()), "long-texts")
    parts = long_parts(numbered, chunk, AROUND, AROUND)
    maps = on_batches(parts, make, f"row long, part int, doc_id {kind}, n_bytes long, head string, count long, tail string, closed boolean, links binary")

    def compose(pieces: pa.Table) -> pa.Table:
        count = counter(path)
        pieces = pieces.sort_by("part")
        maps = [StateMap(**row) for row in pieces.select(list(StateMap._fields)).to_pylist()]
        total = count.total(maps)
        first = pieces.slice(0, 1)
        return pa.table([first["doc_id"], first["n_bytes"], pa.array([total])], names=["doc_id", "n_bytes", "n_tokens"])

    counted = maps.groupBy("row").applyInArrow(compose, f"doc_id {kind}, n_bytes long, n_tokens long")
    return short.unionByName(counted)
