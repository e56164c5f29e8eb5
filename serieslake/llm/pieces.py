"""SentencePiece encoding of whole texts along best paths, and decoding.

The pieces of a model file span a lattice over the text; the best path through it is found in the max-plus
algebra.  In a UNIGRAM file a path scores the sum of its pieces (``Pieces``).  A BPE file merges pairs by rank
(``Merges``): there two neighbouring pieces score 0 if their border stands, which means that no merge would have crossed it, and minus
infinity if not; one path is left, the file's own encoding, as merging by fixed ranks never looks past a border that stands.

A long text is cut into chunks.  Each chunk yields a transfer matrix from every state at its left border to every
state at its right border; the state is how far a piece reaches past the border and, for BPE, also how far it reaches back.
Matrices combine associatively; a prefix scan gives the states at all borders, and each chunk is then
traced back by itself.  No piece passes a word's or line's end, so the paths all meet there; between two
such places the pieces are found once for every different unit.

Scores are added as integers (sixteen bits behind the point), hence exactly.  Ties fall to the earlier start of a piece, at the border of
chunks to the shorter reach; equal ranks of a BPE file merge from the left.  Other kinds of model files are refused.  Null and empty texts have no pieces.  Characters
outside the pieces become byte pieces.  Decoding restores the text, but for U+2581, which reads as a space.  Repeated rows are
encoded each.  Only the columns named in ``keep`` are read besides the text.  An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from serieslake.llm.common import long_parts, on_batches, slices, texts_of
from serieslake.llm.token_counts import scan
from serieslake.session import materialize

SPACE = "▁"
NEVER = -(1 << 61)
_CUT = "\x1f"
UNKNOWN_PENALTY = 10  # fixed value: an unknown character costs this more than the worst piece
POINT = 1 << 16  # scores are integers in units of its inverse


class Trace(NamedTuple):
    score: list[int]
    start: list[int]


def read_model(path: str):
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    return proto, model


class _Units(dict):
    """Units and their ids, found when first asked for; emptied when it holds too many."""

    def __init__(self, find: Callable[[str], bytes], most: int = 500_000) -> None:
        super().__init__()
        self.find, self.most = find, most

    def __missing__(self, unit: str) -> bytes:
        if len(self) > self.most:
            self.clear()
        made = self[unit] = self.find(unit)
        return made

    def ids_of(self, units: Iterable[str]) -> bytes:
        return b"".join(map(self.__getitem__, units))


class Pieces:
    """Paths of the best sum of scores."""

    behind = 0  # characters before a chunk that its matrix depends on

    def __init__(self, path: str) -> None:
        proto, model = read_model(path)
        if model.normalizer_spec.precompiled_charsmap or model.normalizer_spec.remove_extra_whitespaces:
            raise ValueError(f"{path} changes characters; only files that keep the text are read")
        normal, byte = proto.ModelProto.SentencePiece.NORMAL, proto.ModelProto.SentencePiece.BYTE
        self.prefix = SPACE * model.normalizer_spec.add_dummy_prefix
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == normal}
        self.scores = {p.piece: round(p.score * POINT) for p in model.pieces if p.type == normal}
        self.unknown = min(self.scores.values()) - UNKNOWN_PENALTY * POINT
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == byte}
        # Beginnings of pieces that are none themselves are known, at a score that never wins.
        self.known = {piece[:k]: NEVER for piece in self.ids for k in range(1, len(piece))} | self.scores
        self.reach = max(map(len, self.ids)) - 1
        if any(SPACE in piece.lstrip(SPACE) or "\n" in piece for piece in self.ids):
            raise ValueError(f"{path} has pieces that span words or lines")
        # Marks that no piece joins to a letter or digit before them are borders as well.
        self.marks = [m for m in ".," if not any(re.search(rf"[^\W_]\{m}", piece) for piece in self.ids)]
        self.mark_border = {m: re.compile(rf"\{m}(?<=[^\W_]\{m})") for m in self.marks}
        self.shown = [piece.piece.replace(SPACE, " ").encode() for piece in model.pieces]
        for value, i in self.bytes.items():
            self.shown[i] = bytes([value])
        # Of an unknown character its first byte has the whole score.
        self.score_of = np.zeros(len(model.pieces), np.int64)
        for piece, i in self.ids.items():
            self.score_of[i] = self.scores[piece]
        for value, i in self.bytes.items():
            self.score_of[i] = 0 if 0x80 <= value < 0xC0 else self.unknown
        self.memo = _Units(self.unit)

    def unit(self, text: str) -> bytes:
        """Ids of a text that no piece leaves."""
        return self.path(text, 0, len(text))

    def trace(self, text: str, begin: int, end: int, closed: range = range(0)) -> Trace:
        """Best scores of reaching each place from ``begin``; no piece begins in ``closed``."""
        score, start = [NEVER] * (end + 1), [-1] * (end + 1)
        score[begin] = 0
        scores, look = self.scores, self.known.get
        for at in range(begin, end):
            here = score[at]
            if here == NEVER or at in closed:
                continue
            if text[at] not in scores:
                cost = here + self.unknown
                if cost > score[at + 1]:
                    score[at + 1], start[at + 1] = cost, at
            for to in range(at + 1, end + 1):
                cost = look(text[at:to])
                if cost is None:
                    break
                cost += here
                if cost > score[to]:
                    score[to], start[to] = cost, at
        return Trace(score, start)

    def path(self, text: str, begin: int, end: int, closed: range = range(0)) -> bytes:
        """The ids along the best path, as 32-bit words."""
        return self.along(self.trace(text, begin, end, closed).start, text, begin, end)

    def along(self, start: list[int], text: str, begin: int, end: int) -> bytes:
        """The ids of the pieces that end at ``end``, at that piece's start, and so on back to ``begin``."""
        found, ids = array("i"), self.ids
        while end > begin:
            at = start[end]
            piece = text[at:end]
            if piece in ids:
                found.append(ids[piece])
            else:
                found.extend([self.bytes[b] for b in reversed(piece.encode())])
            end = at
        found.reverse()
        return found.tobytes()

    def units(self, marked: str) -> list[str]:
        """The text cut where no piece can pass: before space marks, around line feeds, before marks that end a word."""
        if _CUT in marked:
            return re.findall(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n", marked)
        for mark, border in self.mark_border.items():
            marked = border.sub(_CUT + mark, marked)
        marked = marked.replace("\n", f"{_CUT}\n{_CUT}")
        if SPACE * 2 in marked:
            marked = re.sub(f"(?<!{SPACE}){SPACE}", _CUT + SPACE, marked)
        else:
            marked = marked.replace(SPACE, _CUT + SPACE)
        return [unit for unit in marked.split(_CUT) if unit]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts."""
        made: list[bytes] = []
        for text in texts:
            parts = [part.replace(" ", SPACE) for part in slices(text)]  # cut before spaces and line feeds
            parts[0] = self.prefix + parts[0] if parts[0] else ""
            made.append(b"".join([self.memo.ids_of(self.units(part)) for part in parts]))
        return made

    def _meetings(self, text: str, size: int) -> tuple[int, int] | None:
        """The first word border past every incoming reach, and the last one in the chunk."""
        borders = re.compile(f"(?<=[^{SPACE}])(?={SPACE})")
        first = borders.search(text, self.reach, size)
        if first is None:
            return None
        tail = text.rfind(SPACE, 0, size)
        while tail > 0 and text[tail - 1] == SPACE:
            tail -= 1
        return (first.start(), tail) if tail >= first.start() else None

    def measured(self, text: str, before: int, size: int, first: bool, last: bool) -> bytes:
        """The transfer matrix of a chunk, packed; ``before`` characters of the text precede it."""
        return self.matrix(text[: size if last else None], size).tobytes()

    def settled(self, packed: list[bytes]) -> list[int]:
        """The states at all borders, from the matrices of all chunks."""
        return border_states([np.frombuffer(raw, np.int64).reshape(self.reach + 1, -1) for raw in packed])

    def traced(self, text: str, before: int, size: int, entry: int, leave: int) -> bytes:
        return self.between(text, size, entry, leave)

    def matrix(self, text: str, size: int) -> np.ndarray:
        """Best scores from each incoming to each outgoing reach; ``text`` shows what follows the chunk's ``size`` characters."""
        states = self.reach + 1
        out = np.full((states, states), NEVER, np.int64)
        ends = range(size, min(len(text), size + self.reach) + 1)
        meet = self._meetings(text, size)

        def leaving(begin: int) -> list[int]:
            # A piece that leaves the chunk begins in it.
            made = self.trace(text, begin, ends[-1], range(size, ends[-1])).score
            return [made[end] for end in ends]

        if meet is None:
            for i in range(min(states, size + 1)):
                out[i, : len(ends)] = leaving(i)
        else:
            a, b = meet
            middle = int(self.score_of[np.frombuffer(self.memo.ids_of(self.units(text[a:b])), "<i4")].sum()) if b > a else 0
            tail = np.array(leaving(b), np.int64)
            for i in range(states):
                out[i, : len(ends)] = self.trace(text, i, a).score[a] + middle + tail
        for i in range(size + 1, states):  # a chunk shorter than the reach into it
            out[i, i - size] = 0
        return np.maximum(out, NEVER)

    def between(self, text: str, size: int, entry: int, leave: int) -> bytes:
        """Ids of the pieces that begin in the chunk, given the states at its borders."""
        if entry > size:
            return b""
        closed, end = range(size, size + leave), size + leave
        meet = self._meetings(text, size)
        if meet is None:
            return self.path(text, entry, end, closed)
        a, b = meet
        return b"".join([self.path(text, entry, a), self.memo.ids_of(self.units(text[a:b])), self.path(text, b, end, closed)])

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.shown.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The max-plus product."""
    return np.maximum((a[:, :, None] + b[None]).max(1), NEVER)


def border_states(matrices: list[np.ndarray]) -> list[int]:
    """The reach at each border of the best path through all chunks, from the text's begin to its end."""
    before = [m[0] for m in scan(matrices, times)]
    states = [0]
    for k in range(len(matrices) - 1, 0, -1):
        states.append(int(np.argmax(before[k - 1] + matrices[k][:, states[-1]])))
    return [0, *states[::-1]]


NO_LEFT = -(1 << 40)  # the start of the piece before a text's or word's first
LONG_UNIT = 48

Links = dict[int, frozenset[int]]  # from each state at the left border: states at the right border with a standing path


class Merges(Pieces):
    """The encoding of a BPE file: pairs merge by rank, the leftmost of equals first."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        proto, model = read_model(path)
        self.rank = {p.piece: p.score for p in model.pieces if p.type == proto.ModelProto.SentencePiece.NORMAL}
        self.behind = self.longest = self.reach + 1
        self._halves: dict[str, tuple[str, str, float] | None] = {}
        self._stood: dict[tuple[str, str], bool] = {}

    def merged(self, text: str, least: int = 1) -> list[str]:
        """BPE by its definition, until ``least`` pieces are left."""
        parts = list(text)
        if len(parts) > LONG_UNIT:
            return self._merged_long(parts)
        rank, never = self.rank.get, float("-inf")
        ranks = [rank(pair, never) for pair in map(str.__add__, parts, parts[1:])]
        while len(parts) > least:
            best = max(ranks)
            if best == never:
                break
            at = ranks.index(best)
            made = parts[at] + parts[at + 1]
            parts[at : at + 2] = [made]
            del ranks[at]
            if at:
                ranks[at - 1] = rank(parts[at - 1] + made, never)
            if at < len(ranks):
                ranks[at] = rank(made + parts[at + 1], never)
        return parts

    def _merged_long(self, parts: list[str | None]) -> list[str]:
        """The same with a queue of pairs and links between neighbours."""
        after = [*range(1, len(parts)), -1]
        ahead = list(range(-1, len(parts) - 1))
        queue: list[tuple[float, int, int, str]] = []

        def push(left: int) -> None:
            right = after[left]
            if right >= 0 and (here := self.rank.get(parts[left] + parts[right])) is not None:
                heapq.heappush(queue, (-here, left, right, parts[left] + parts[right]))

        for k in range(len(parts) - 1):
            push(k)
        while queue:
            _, left, right, joined = heapq.heappop(queue)
            if parts[left] is None or parts[right] is None or after[left] != right or parts[left] + parts[right] != joined:
                continue
            parts[left], parts[right] = joined, None
            after[left] = after[right]
            if after[right] >= 0:
                ahead[after[right]] = left
            if ahead[left] >= 0:
                push(ahead[left])
            push(left)
        return [part for part in parts if part is not None]

    def unit(self, text: str) -> bytes:
        found, ids = array("i"), self.ids
        for piece in self.merged(text):
            if piece in ids:
                found.append(ids[piece])
            else:
                found.extend([self.bytes[b] for b in piece.encode()])
        return found.tobytes()

    def halves(self, piece: str) -> tuple[str, str, float] | None:
        """What a piece's last merge joined, and its rank; None of a single character."""
        if len(piece) == 1:
            return None
        if piece not in self._halves:
            parts = self.merged(piece, 2)
            self._halves[piece] = (*parts, self.rank[piece]) if len(parts) == 2 and piece in self.rank else None
        return self._halves[piece]

    def made(self, piece: str) -> bool:
        """Whether merging ever makes this piece."""
        return len(piece) == 1 or self.halves(piece) is not None

    def stands(self, left: str, right: str) -> bool:
        """Whether two made pieces stay unmerged side by side.

        Undoes the merges of both, the latest first, and looks at the two parts that meet at the
        border: they would have merged if their pair ranks before the merges that hid them.
        """
        if (known := self._stood.get((left, right))) is not None:
            return known
        if len(self._stood) > 300_000:
            self._stood.clear()
        pair, never = (left, right), float("-inf")
        left_hid = right_hid = never
        while True:
            across = self.rank.get(left + right, never)
            if across > never and across > left_hid and across >= right_hid:
                stood = False
                break
            a, b = self.halves(left), self.halves(right)
            if a is None and b is None:
                stood = True
                break
            if b is None or (a is not None and a[2] < b[2]):
                left_hid, left = a[2], a[1]
            else:
                right_hid, right = b[2], b[0]
        self._stood[pair] = stood
        return stood

    def chain(self, text: str, start: list[int | None], begin: int, end: int, closed: int, done: int | None = None) -> None:
        """Fill in where the last piece of the text up to each place begins, from ``begin`` (or behind ``done``) on; no piece begins from ``closed`` on."""
        ids = self.ids
        for to in range((begin if done is None else done) + 1, end + 1):
            for at in range(max(to - self.longest, begin), min(to, closed)):
                before = start[at]
                if before is None:
                    continue
                piece = text[at:to]
                if (piece in ids or len(piece) == 1) and self.made(piece) and (before == NO_LEFT or self.stands(text[before:at], piece)):
                    start[to] = at
                    break

    def _state(self, back: int, reach: int) -> int:
        return back * (self.reach + 1) + reach

    def links(self, text: str, before: int, size: int, first: bool, last: bool) -> Links:
        """The transfer matrix as its finite entries; a state is (characters back, characters ahead) of the piece at a border."""
        left, right = before, before + size
        end = right if last else min(len(text), right + self.reach)
        entries = [(0, 0)] if first else [
            (back, reach)
            for back in range(1, min(before, self.longest) + 1)
            for reach in range(0, min(self.longest - back, len(text) - left) + 1)
            if self.made(piece := text[left - back : left + reach]) and (piece in self.ids or len(piece) == 1)
        ]

        def leaving(start: list[int | None]) -> frozenset[int]:
            found = [(start[to], to) for to in range(right, end + 1)]
            return frozenset(self._state(right - at, to - right) for at, to in found if at is not None and at < right)

        def begun(entry: tuple[int, int], end: int) -> list[int | None]:
            start: list[int | None] = [None] * (end + 1)
            start[left + entry[1]] = left - entry[0] if entry[0] else NO_LEFT
            return start

        made: Links = {}
        meet = self._meetings(text[left:], size)
        if meet is None:
            known: dict[int, list[int | None]] = {}
            for entry in entries:
                if entry[1] > size:
                    made[self._state(*entry)] = frozenset([self._state(entry[0] + size, entry[1] - size)])
                    continue
                start = begun(entry, end)
                self._chain_until_known(text, start, left + entry[1], end, right, known)
                made[self._state(*entry)] = leaving(start)
            return made
        a, b = left + meet[0], left + meet[1]
        tail: list[int | None] = [None] * (end + 1)
        tail[b] = NO_LEFT
        self.chain(text, tail, b, end, right)
        out = leaving(tail)
        for entry in entries:
            start = begun(entry, a)
            self.chain(text, start, left + entry[1], a, a)
            if start[a] is not None:
                made[self._state(*entry)] = out
        return made

    def _chain_until_known(self, text: str, start: list, begin: int, end: int, closed: int, known: dict[int, list]) -> None:
        """Chains that agree on as many places as the longest piece has letters agree from there on: copy what is known."""
        step = 4 * self.longest
        at = begin
        while at < end:
            to = min(at + step, end)
            self.chain(text, start, begin, to, closed, at)
            for other in known.values():
                if to - self.longest > begin and start[to - self.longest + 1 : to + 1] == other[to - self.longest + 1 : to + 1]:
                    start[to + 1 :] = other[to + 1 :]
                    at = end
                    break
            else:
                at = to
        if len(known) < 8:
            known[begin] = start

    def measured(self, text: str, before: int, size: int, first: bool, last: bool) -> bytes:
        pairs = [(i, j) for i, out in self.links(text, before, size, first, last).items() for j in sorted(out)]
        return np.array(pairs, "<u2").reshape(-1, 2).tobytes()

    def settled(self, packed: list[bytes]) -> list[int]:
        maps: list[Links] = []
        for raw in packed:
            found: dict[int, list[int]] = {}
            for i, j in np.frombuffer(raw, "<u2").reshape(-1, 2).tolist():
                found.setdefault(i, []).append(j)
            maps.append({i: frozenset(out) for i, out in found.items()})
        reached = [links.get(0, frozenset()) for links in scan(maps, joined)]
        (state,) = [j for j in reached[-1] if j % (self.reach + 1) == 0]  # the last piece ends with the text
        states = [state]
        for k in range(len(maps) - 1, 0, -1):
            (state,) = [i for i in reached[k - 1] if states[-1] in maps[k].get(i, ())]
            states.append(state)
        return [0, *states[::-1]]

    def traced(self, text: str, before: int, size: int, entry: int, leave: int) -> bytes:
        """Ids of the pieces that begin in the chunk, given the states at its borders."""
        (back, reach), (_, further) = divmod(entry, self.reach + 1), divmod(leave, self.reach + 1)
        left, right = before, before + size
        begin, end = left + reach, right + further
        if begin > right:
            return b""
        start: list[int | None] = [None] * (end + 1)
        start[begin] = left - back if back else NO_LEFT
        meet = self._meetings(text[left:], size)
        if meet is None:
            self.chain(text, start, begin, end, right)
            return self.along(start, text, begin, end)
        a, b = left + meet[0], left + meet[1]
        self.chain(text, start, begin, a, a)
        tail: list[int | None] = [None] * (end + 1)
        tail[b] = NO_LEFT
        self.chain(text, tail, b, end, right)
        return b"".join([self.along(start, text, begin, a), self.memo.ids_of(self.units(text[a:b])), self.along(tail, text, b, end)])


def joined(a: Links, b: Links) -> Links:
    """The max-plus product where entries are 0 or minus infinity: what can be reached."""
    return {i: frozenset().union(*(b.get(j, frozenset()) for j in out)) for i, out in a.items()}


@functools.cache
def pieces(path: str) -> Pieces:
    """One per Python worker and file."""
    proto, model = read_model(path)
    kinds = {proto.TrainerSpec.UNIGRAM: Pieces, proto.TrainerSpec.BPE: Merges}
    if model.trainer_spec.model_type not in kinds:
        raise ValueError(f"{path} is neither a UNIGRAM nor a BPE file")
    return kinds[model.trainer_spec.model_type](path)


def _int_lists(raws: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(raw) // 4 for raw in raws)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(raws), "<i4")))


def encode(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), chunk: int = 32_768) -> DataFrame:
    """The ``keep`` columns and ``ids`` of every row of ``docs``; texts over ``chunk`` characters in parallel parts."""
    kept = docs.select(*keep, "text")
    schema = StructType([f for f in kept.schema.fields[:-1]] + StructType.fromDDL("ids array<int>").fields)
    long = F.coalesce(F.length("text"), F.lit(0)) > chunk

    def whole(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = _int_lists(pieces(path).encode(texts_of(batch)))
        return pa.RecordBatch.from_arrays([*(batch.column(name) for name in keep), ids], names=[*keep, "ids"])

    short = on_batches(kept.filter(~long), whole, schema)

    model = pieces(path)
    base = materialize(kept.filter(long).withColumn("_row", F.monotonically_increasing_id()), "long-texts")
    parts = materialize(long_parts(base.select(F.col("_row").alias("row"), "text"), chunk, model.behind, model.reach), "parts")

    def marked(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, bool, bool]]:
        """The characters of each part with those around it, how many precede it and how many are its own, and whether it is first or last."""
        columns = [batch.column(name).to_pylist() for name in ("part", "n_parts", "before")]
        for text, part, n, before in zip(texts_of(batch), *columns, strict=True):
            own = min(chunk, len(text) - before)
            front = pieces(path).prefix
            if part == 0:
                own += len(front)
            elif 0 < before == part * chunk:  # all that precedes is shown, and the prefix before it
                before += len(front)
            else:
                front = ""
            yield (front + text).replace(" ", SPACE), before, own, part == 0, part == n - 1

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [pieces(path).measured(*part) for part in marked(batch)]
        return pa.RecordBatch.from_arrays([batch.column("row"), batch.column("part"), pa.array(made, pa.binary())], names=["row", "part", "matrix"])

    def settle(group: pa.Table) -> pa.Table:
        group = group.sort_by("part")
        states = pieces(path).settled(group["matrix"].to_pylist())
        return pa.table([group["row"], group["part"], pa.array(states[:-1], pa.int32()), pa.array(states[1:], pa.int32())], names=["row", "part", "entry", "leave"])

    def trace(batch: pa.RecordBatch) -> pa.RecordBatch:
        states = zip(batch.column("entry").to_pylist(), batch.column("leave").to_pylist(), strict=True)
        made = [pieces(path).traced(*part[:3], i, j) for part, (i, j) in zip(marked(batch), states, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column("row"), batch.column("part"), _int_lists(made)], names=["row", "part", "ids"])

    matrices = on_batches(parts, measure, "row long, part int, matrix binary")
    states = matrices.groupBy("row").applyInArrow(settle, "row long, part int, entry int, leave int")
    traced = on_batches(parts.join(states, ["row", "part"]), trace, "row long, part int, ids array<int>")
    joined = traced.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("part", "ids"))).alias("parts"))  # one text's
    ids = joined.select(F.col("row").alias("_row"), F.flatten("parts.ids").alias("ids"))
    return short.unionByName(base.drop("text").join(ids, "_row").select(*keep, "ids"))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with its ``ids`` replaced by the text they stand for."""
    schema = StructType([f for f in encoded.schema.fields if f.name != "ids"] + StructType.fromDDL("text string").fields)
    names = [f.name for f in schema.fields[:-1]]

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [pieces(path).decode(ids or []) for ids in batch.column("ids").to_pylist()]
        return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(texts, pa.string())], names=[*names, "text"])

    return on_batches(encoded.select(*names, "ids"), make, schema)


def digests(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, n_pieces, ids_crc32, decoded_sha256, round_trip of ``encoded(doc_id, text_sha256, ids)``."""
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column("ids")
        ends, values = np.asarray(lists.offsets), np.ascontiguousarray(np.asarray(lists.values), "<i4")
        raw, sums, hashes = memoryview(values).cast("B"), [], []
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            sums.append(zlib.crc32(raw[4 * a : 4 * b]))
            hashes.append(hashlib.sha256(pieces(path).decode(values[a:b].tolist()).encode()).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(ends).astype(np.int64)), pa.array(sums, pa.int64()), pa.array(hashes, pa.string()), batch.column("text_sha256")],
            names=["doc_id", "n_pieces", "ids_crc32", "decoded_sha256", "text_sha256"],
        )

    schema = f"doc_id {kind}, n_pieces long, ids_crc32 long, decoded_sha256 string, text_sha256 string"
    made = on_batches(encoded.select("doc_id", "ids", "text_sha256"), make, schema)
    return made.withColumn("round_trip", F.col("decoded_sha256") == F.col("text_sha256")).drop("text_sha256")
