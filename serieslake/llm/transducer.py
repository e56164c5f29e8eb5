"""A BPE file as a deterministic transducer whose transitions carry emitted-token counts.

BPE is prefix-stable: dropping the last token of an encoding gives the encoding of the shorter
text.  So the encoding of a prefix is fixed by its last token and the encoding before that, and
the last token is the one suffix in the vocabulary that stands unmerged beside the last token
before it.  What a state must remember is hence the longest suffix that may still grow into a
token, with the last token and the relative count at each position in it.  States are finite in
number and compiled when first reached; a transition emits the change of the token count.
"""

from __future__ import annotations

import json

import numpy as np

from serieslake.llm.words import byte_characters

END = 256  # added to a byte that ends its pre-token
START = 0
_SHIFT, _ZERO = 7, 64  # a table entry holds the next state and, in the low bits, the emitted count


class Transducer:
    def __init__(self, path: str, most_states: int = 130_000) -> None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        suffix = model["end_of_word_suffix"]
        byte_of = {char: byte for byte, char in enumerate(byte_characters())}

        def symbols(token: str) -> str:
            ended = token.endswith(suffix) and token != suffix
            codes = [byte_of[c] for c in (token.removesuffix(suffix) if ended else token)]
            return "".join(map(chr, [*codes[:-1], codes[-1] + END] if ended else codes))

        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {(symbols(a), symbols(b)): i for i, (a, b) in enumerate(pairs)}
        self.tokens = {symbols(t) for t in model["vocab"]}
        self.growing = {t[:k] for t in self.tokens for k in range(1, len(t))} | {""}
        self.most_states = most_states
        self._halves: dict[str, tuple[str, str, int]] = {}  # of a token: what its last merge joined, and its rank
        self._whole: dict[str, bool] = {}
        self._forget()

    def _forget(self) -> None:
        first = ("", (None,), (0,))
        self.states, self.ids = [first], {first: START}
        self.column = np.full(2 * END, -1, np.int32)
        self.used = 0
        self.table = np.full((16_384, 128), -1, np.int32)

    def merge(self, text: str) -> list[str]:
        """BPE by its definition: the lowest-ranked pair first, from the left."""
        parts = list(text)
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), len(self.rank)))
            if (pair := (parts[best], parts[best + 1])) not in self.rank:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
            self._halves[parts[best]] = (*pair, self.rank[pair])
        return parts

    def _made(self, token: str) -> bool:
        """Whether BPE ever makes this token; its last merge is noted."""
        if token not in self._whole:
            self._whole[token] = self.merge(token) == [token]
        return self._whole[token]

    def _stands(self, left: str | None, right: str) -> bool:
        """Whether ``right`` is made by BPE and stays unmerged behind ``left``.

        Undoes the merges of both, the latest first, and looks at the two parts that meet at the
        border: they would have merged if their pair comes before the merges that hid them.
        """
        if not self._made(right) or left is None:
            return self._whole[right]
        never = len(self.rank)
        left_ends = right_ends = never
        while True:
            across = self.rank.get((left, right), never)
            if across < left_ends and across <= right_ends and across < never:
                return False
            a, b = self._halves.get(left), self._halves.get(right)
            if a is None and b is None:
                return True
            if b is None or a is not None and a[2] > b[2]:
                left_ends, left = a[2], a[1]
            else:
                right_ends, right = b[2], b[0]

    def _compile(self, state: int, symbol: int) -> int:
        tail, lasts, counts = self.states[state]
        grown = tail + chr(symbol)
        at = next(
            k for k, last in enumerate(lasts)
            if last is not False and grown[k:] in self.tokens and self._stands(last, grown[k:])
        )
        emitted = counts[at] + 1
        if symbol >= END:
            following = START
        else:
            # Only positions where a longer token may begin are kept.
            new = grown[at:]
            kept = [k for k, last in enumerate(lasts) if last is not False and grown[k:] in self.growing]
            cut = kept[0] if kept else len(grown)
            held = dict.fromkeys(kept)
            key = (
                grown[cut:],
                (*(lasts[k] if k in held else False for k in range(cut, len(grown))), new),
                (*(counts[k] - emitted if k in held else 0 for k in range(cut, len(grown))), 0),
            )
            following = self.ids.get(key)
            if following is None:
                following = self.ids[key] = len(self.states)
                self.states.append(key)
        if self.column[symbol] < 0:
            self.column[symbol] = self.used
            self.used += 1
        rows, columns = self.table.shape
        if len(self.states) > rows or self.used > columns:
            more = (rows + 16_384 * (len(self.states) > rows), columns + 32 * (self.used > columns))
            wider = np.full(more, -1, np.int32)
            wider[:rows, :columns] = self.table
            self.table = wider
        entry = following << _SHIFT | emitted + _ZERO
        self.table[state, self.column[symbol]] = entry
        return entry

    def step(self, state: int, symbol: int) -> tuple[int, int]:
        """The next state and the emitted count."""
        entry = int(self.table[state, self.column[symbol]]) if self.column[symbol] >= 0 else -1
        if entry < 0:
            entry = self._compile(state, symbol)
        return entry >> _SHIFT, (entry & (1 << _SHIFT) - 1) - _ZERO

    def counts(self, words: list[bytes], lane: int = 512) -> np.ndarray:
        """Tokens of each pre-token: all short ones run in step, the few long ones one by one."""
        if len(self.states) > self.most_states:
            self._forget()
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        total = np.zeros(len(words), np.int64)
        for i in np.flatnonzero(lengths > lane):
            state, symbols = START, list(words[i])
            symbols[-1] += END
            for symbol in symbols:
                state, emitted = self.step(state, symbol)
                total[i] += emitted
        order = np.argsort(-lengths, kind="stable")
        order = order[np.searchsorted(-lengths[order], -lane) :]
        data = np.frombuffer(b"".join([words[i] for i in order]), np.uint8).astype(np.int32)
        lengths = lengths[order]
        ends = np.cumsum(lengths)
        begins = ends - lengths
        data[ends[lengths > 0] - 1] += END
        state, run = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        for k in range(int(lengths[0]) if len(order) else 0):
            live = int(np.searchsorted(-lengths, -k))
            now, symbol = state[:live], data[begins[:live] + k]
            entry = self._look(now, symbol)
            unknown = np.flatnonzero(entry < 0)
            if len(unknown):
                for pair in np.unique(now[unknown] * (2 * END) + symbol[unknown]):
                    self._compile(int(pair) // (2 * END), int(pair) % (2 * END))
                entry = self._look(now, symbol)
            state[:live] = entry >> _SHIFT
            run[:live] += (entry & (1 << _SHIFT) - 1) - _ZERO
        total[order] = run
        return total

    def _look(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        column = self.column[symbol]
        return np.where(column < 0, -1, self.table[state, column])
