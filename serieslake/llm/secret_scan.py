"""Secrets in texts, found by one deterministic automaton for all rules.

All rules, mirrored, make one minimal automaton.  It reads the UTF-8 bytes of a whole text once, from the end,
and tells at every byte which rules have a match that begins there.  From the leftmost begin a rule's own forward
automaton runs to the longest end, and on from there: leftmost, longest matches that do not overlap within a
rule.  Matches that are too short, in all or in their tail, are dropped after that.  The automata are compiled
on the driver and broadcast (some hundred states).  A rule may not match the empty text.

Null and empty texts hold nothing.  Positions are code points, the end exclusive.  Rows are scanned each, with null
and repeated ids; other columns are not read.  A text is one string in one task, with 16 bytes for each change
between places where matches begin and where none do.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from serieslake.llm.automaton import Automaton, compiled, mirrored, parse
from serieslake.llm.common import on_batches, texts_of


class Rule(NamedTuple):
    """Matches of ``head`` followed by ``tail`` with ``least`` code points in all and ``tail_least`` in the tail."""

    kind: str
    head: str
    tail: str = ""
    least: int = 0
    tail_least: int = 0
    any_case: bool = False  # of the head's letters


# The base rules.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", r"[A-Za-z0-9+/_.=-]+", tail_least=12, any_case=True),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]{16,}"),
)
# Public formats of further credentials.
FURTHER = (
    Rule("private_key", r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
    Rule("code_host", r"gh[oprsu]_[A-Za-z0-9]+", least=40),
    Rule("chat", r"xox[abeoprs]-[A-Za-z0-9-]+", least=24),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]+", least=39),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("bearer", r"bearer\x20+", r"[A-Za-z0-9+/_.=~-]+", tail_least=20, any_case=True),
    Rule("login", r"://[A-Za-z0-9._%+-]+:", r"[^\x00-\x20/:@\x7f-\xff]+@", tail_least=4),
)


class Scanner:
    """The compiled rules."""

    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.rules = rules
        heads = [parse(rule.head, rule.any_case) for rule in rules]
        whole = [("seq", [head, parse(rule.tail)]) for head, rule in zip(heads, rules, strict=True)]
        self.wholes = [_Forward(compiled([tree], anywhere=False)) for tree in whole]
        for rule, forward in zip(rules, self.wholes, strict=True):
            if forward.accepts[forward.start]:
                raise ValueError(f"{rule.kind} matches the empty text")
        self.begins = compiled([mirrored(tree) for tree in whole], anywhere=True)
        self.heads = [_Forward(compiled([head], anywhere=False)) if rule.tail else None for head, rule in zip(heads, rules, strict=True)]
        self._linked: tuple[bytes, list] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_linked": None}

    def _rows(self) -> tuple[bytes, list]:
        """Byte classes as a translation table and the start's row; rows hold the rows that follow and, last, what is accepted."""
        if self._linked is None:
            self._linked = self.begins.class_of.tobytes(), linked(self.begins)
        return self._linked

    def begin_runs(self, data: bytes) -> list[tuple[int, int, int]]:
        """Runs (first byte, behind the last, rules) of places where matches begin, from the last to the first."""
        classes, row = self._rows()
        runs, accepted, behind = [], 0, 0
        at = len(data)
        for kind in data[::-1].translate(classes):
            row = row[kind]
            at -= 1
            if row[-1] != accepted:
                if accepted:
                    runs.append((at + 1, behind, accepted))
                accepted, behind = row[-1], at + 1
        if accepted:
            runs.append((0, behind, accepted))
        return runs

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(begin, rule, end) of all matches in code points, by begin and then in order of the rules."""
        data = text.encode("utf-8", "surrogatepass")
        runs = self.begin_runs(data)
        if not runs:
            return []
        found = []
        for k, rule in enumerate(self.rules):
            done = 0
            for first, behind, accepted in reversed(runs):
                if not accepted >> k & 1:
                    continue
                at = max(first, done)
                while at < behind:
                    done = self.wholes[k].longest(data, at)
                    found.append((at, k, done, self.heads[k].longest(data, at) if rule.tail else at))
                    at = done
        place = dict(_code_points(data, {at for begin, _, end, head in found for at in (begin, end, head)}))
        spans = []
        for begin, k, end, head in sorted(found):
            if place[end] - place[begin] >= self.rules[k].least and place[end] - place[head] >= self.rules[k].tail_least:
                spans.append((place[begin], k, place[end]))
        return spans


def _code_points(data: bytes, places: set[int]) -> Iterator[tuple[int, int]]:
    """Places in the bytes and how many code points begin before them."""
    begins = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    last = points = 0
    for place in sorted(places):
        points += int(np.count_nonzero(begins[last:place]))
        yield place, points
        last = place


class _Forward:
    """Longest words from a given byte on."""

    def __init__(self, automaton: Automaton) -> None:
        self.class_of = automaton.class_of.tolist()
        self.step, self.accepts = automaton.step.tolist(), automaton.accepts.tolist()
        self.start, self.dead = automaton.start, automaton.dead

    def longest(self, data: bytes, at: int) -> int:
        state, end = self.start, at
        for k in range(at, len(data)):
            state = self.step[state][self.class_of[data[k]]]
            if state == self.dead:
                break
            if self.accepts[state]:
                end = k + 1
        return end


def linked(automaton: Automaton) -> list:
    """The start state as a list of the lists that follow for each byte class and, last, what the state accepts."""
    rows = [[] for _ in automaton.step]
    for row, after, accepted in zip(rows, automaton.step.tolist(), automaton.accepts.tolist(), strict=True):
        row += [rows[k] for k in after] + [accepted]
    return rows[automaton.start]


def listed(scanner: Scanner, spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{scanner.rules[k].kind}:{begin}:{end}" for begin, k, end in spans)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + FURTHER, base: int = len(BASE), key: str = "doc_id") -> DataFrame:
    """``key``, n_<kind> for each of the first ``base`` rules, base_sha256 of their listed spans, and the list of all spans."""
    scanner = docs.sparkSession.sparkContext.broadcast(Scanner(tuple(rules)))
    kind = docs.schema[key].dataType.simpleString()
    names = [f"n_{rule.kind}" for rule in rules[:base]]

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        made: list[tuple] = []
        for text in texts_of(batch):
            spans = scanner.value.spans(text)
            ours = [span for span in spans if span[1] < base]
            counts = [sum(k == rule for _, k, _ in ours) for rule in range(base)]
            made.append((*counts, hashlib.sha256(listed(scanner.value, ours).encode()).hexdigest(), listed(scanner.value, spans)))
        columns = [pa.array(column) for column in zip(*made, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[key, *names, "base_sha256", "spans"])

    schema = ", ".join([f"`{key}` {kind}", *(f"{name} long" for name in names), "base_sha256 string, spans string"])
    return on_batches(docs.select(key, "text"), make, schema)

