"""Token counts of long runs of letters, chunk by chunk, as maps of tokenizer states.

Within a run the state at a border is the token over it: how many bytes it reaches back and ahead.  What a chunk does to a
state follows from the transducer's rule for tokens that stand side by side, so a chunk becomes a map from states at its left
border to states at its right border with the number of tokens that begin in between.  Maps compose by adding counts.
"""

from __future__ import annotations

import numpy as np

from serieslake.llm.transducer import END, Transducer

NO_LEFT = -(1 << 40)
Links = dict[int, dict[int, int]]


class RunMaps:
    def __init__(self, transducer: Transducer) -> None:
        self.transducer = transducer
        self.longest = max(map(len, transducer.tokens))
        self._stood: dict[tuple[str, str], bool] = {}

    def symbols(self, run: str, last: bool = False) -> str:
        """A run of plain letters as the symbols that the transducer reads; ``last`` marks its end."""
        made = run.lower().encode().decode("latin-1")
        return made[:-1] + chr(ord(made[-1]) + END) if last and made else made

    def _stands(self, left: str, right: str) -> bool:
        known = self._stood.get((left, right))
        if known is None:
            if len(self._stood) > 300_000:
                self._stood.clear()
            known = self._stood[left, right] = self.transducer._stands(left, right)
        return known

    def chain(self, text: str, start: list, count: list, done: int, begin: int, end: int, closed: int) -> None:
        """For each place behind ``done`` where the last token of the text so far begins, and the tokens since ``begin``; none begins from ``closed`` on."""
        tokens = self.transducer.tokens
        for to in range(done + 1, end + 1):
            for at in range(max(to - self.longest, begin), min(to, closed)):
                before = start[at]
                if before is None:
                    continue
                token = text[at:to]
                if token in tokens and (self.transducer._made(token) if before == NO_LEFT else self._stands(text[before:at], token)):
                    start[to], count[to] = at, count[at] + 1
                    break

    def links(self, text: str, before: int, size: int, first: bool = False, last: bool = False) -> Links:
        """The map of ``size`` symbols of a run; ``before`` symbols and what is left of ``text`` stand around them."""
        left, right = before, before + size
        end = right if last else min(len(text), right + self.longest - 1)
        wide, tokens = self.longest + 1, self.transducer.tokens
        entries = [(0, 0)] if first else [
            (back, reach)
            for back in range(1, min(before, self.longest) + 1)
            for reach in range(0, min(self.longest - back, len(text) - left) + 1)
            if (token := text[left - back : left + reach]) in tokens and self.transducer._made(token)
        ]
        made: Links = {}
        known: list[tuple[list, list]] = []
        for back, reach in entries:
            if reach > size:
                made[back * wide + reach] = {(back + size) * wide + reach - size: 0}
                continue
            begin = left + reach
            start: list[int | None] = [None] * (end + 1)
            count = [0] * (end + 1)
            start[begin] = left - back if back else NO_LEFT
            at = begin
            while at < end:
                to = min(at + 4 * self.longest, end)
                self.chain(text, start, count, at, begin, to, right)
                at = self._copied(start, count, known, begin, to, end)
            if len(known) < 8:
                known.append((start, count))
            out = {}
            for to in range(right, end + 1):
                if start[to] is not None and start[to] < right:
                    out[(right - start[to]) * wide + to - right] = count[to]
            made[back * wide + reach] = out
        return made

    def _copied(self, start: list, count: list, known: list[tuple[list, list]], begin: int, to: int, end: int) -> int:
        """Where two chains agree on as many places as the longest token has symbols they agree from there on; the place that is done."""
        window = slice(to - self.longest + 1, to + 1)
        if window.start > begin:
            for other, counted in known:
                if start[window] == other[window]:
                    same = next((k for k in range(window.start, to + 1) if start[k] is not None), None)
                    more = 0 if same is None else count[same] - counted[same]
                    start[to + 1 :] = other[to + 1 :]
                    count[to + 1 :] = [n + more for n in counted[to + 1 :]]
                    return end
        return to


def packed(links: Links) -> bytes:
    return np.array([(i, o, n) for i, out in links.items() for o, n in out.items()], "<i4").reshape(-1, 3).tobytes()


def unpacked(raw: bytes) -> Links:
    made: Links = {}
    for i, o, n in np.frombuffer(raw, "<i4").reshape(-1, 3).tolist():
        made.setdefault(i, {})[o] = n
    return made


def joined(a: Links, b: Links) -> Links:
    """``a`` and then ``b``."""
    return {i: {o: n + m for mid, n in out.items() for o, m in b.get(mid, {}).items()} for i, out in a.items()}
