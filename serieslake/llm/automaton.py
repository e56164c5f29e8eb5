"""Rules as regular expressions over bytes, compiled to deterministic automata.

Expressions hold letters, escapes, classes, groups, ``|``, ``?``, ``*``, ``+`` and ``{m}``, ``{m,}``, ``{m,n}``.
They are read as sets of bytes; several are put side by side, made deterministic by subset
construction and minimised by splitting states that differ in what they accept or lead to.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

_ESCAPES = {"d": frozenset(b"0123456789"), "s": frozenset(b" \t\n\r\x0b\x0c"), "n": frozenset(b"\n"), "t": frozenset(b"\t"), "r": frozenset(b"\r")}
_EVERY = frozenset(range(256))


class Automaton(NamedTuple):
    """``step[state, class_of[byte]]`` follows ``state``; ``accepts[state]`` has a bit for each rule that ends here."""

    class_of: np.ndarray
    step: np.ndarray
    accepts: np.ndarray
    start: int
    dead: int  # nothing is accepted from here on; -1 if there is no such state


class _Reader:
    """Reads one expression into a tree of ("set", bytes), ("seq", parts), ("or", parts), ("many", part, least, most)."""

    def __init__(self, pattern: str, any_case: bool) -> None:
        self.pattern, self.at, self.any_case = pattern, 0, any_case

    def read(self) -> tuple:
        tree = self._choice()
        if self.at < len(self.pattern):
            raise ValueError(f"unexpected {self._next()!r} at {self.at} in {self.pattern!r}")
        return tree

    def _next(self) -> str:
        return self.pattern[self.at : self.at + 1]

    def _take(self) -> str:
        if self.at >= len(self.pattern):
            raise ValueError(f"{self.pattern!r} ends early")
        self.at += 1
        return self.pattern[self.at - 1]

    def _choice(self) -> tuple:
        parts = [self._sequence()]
        while self._next() == "|":
            self._take()
            parts.append(self._sequence())
        return ("or", parts) if len(parts) > 1 else parts[0]

    def _sequence(self) -> tuple:
        parts = []
        while self._next() not in ("", "|", ")"):
            parts.append(self._repeated(self._atom()))
        return ("seq", parts)

    def _repeated(self, part: tuple) -> tuple:
        bounds = {"?": (0, 1), "*": (0, None), "+": (1, None)}
        while (mark := self._next()) and mark in "?*+{":
            self._take()
            if mark == "{":
                end = self.pattern.index("}", self.at)
                least, _, most = self.pattern[self.at : end].partition(",")
                low, high = int(least), int(most) if most else None if "," in self.pattern[self.at : end] else int(least)
                self.at = end + 1
            else:
                low, high = bounds[mark]
            part = ("many", part, low, high)
        return part

    def _atom(self) -> tuple:
        char = self._take()
        if char == "(":
            if self.pattern.startswith("?:", self.at):
                self.at += 2
            tree = self._choice()
            if self._take() != ")":
                raise ValueError(f"missing ) in {self.pattern!r}")
            return tree
        if char == "[":
            return ("set", self._class())
        if char == ".":
            return ("set", _EVERY - {10})
        if char in "*+?{)^$":
            raise ValueError(f"unexpected {char!r} in {self.pattern!r}")
        return ("seq", [("set", one) for one in (self._escaped() if char == "\\" else self._letter(char))])

    def _letter(self, char: str) -> list[frozenset]:
        forms = {char, char.upper(), char.lower()} if self.any_case and char.isascii() else {char}
        return [frozenset(ord(form) for form in forms)] if char.isascii() else [frozenset([byte]) for byte in char.encode()]

    def _escaped(self) -> list[frozenset]:
        char = self._take()
        if char == "x":
            self.at += 2
            return [frozenset([int(self.pattern[self.at - 2 : self.at], 16)])]
        if char.isalnum() and char not in _ESCAPES:
            raise ValueError(f"unknown escape {char!r} in {self.pattern!r}")
        return [_ESCAPES.get(char) or frozenset([ord(char)])]

    def _class(self) -> frozenset:
        but = self._next() == "^"
        self.at += but
        members: set[int] = set()
        first = True
        while first or self._next() != "]":
            first = False
            char = self._take()
            (found,) = self._escaped() if char == "\\" else self._letter(char)
            if len(found) == 1 and self._next() == "-" and self.pattern[self.at + 1 : self.at + 2] not in ("]", ""):
                self._take()
                char = self._take()
                (last,) = self._escaped() if char == "\\" else self._letter(char)
                found = frozenset(range(min(found), max(last) + 1))
            members |= found
        self._take()
        if self.any_case:
            members |= {byte ^ 32 for byte in members if chr(byte).isascii() and chr(byte).isalpha()}
        return _EVERY - members if but else frozenset(members)


def parse(pattern: str, any_case: bool = False) -> tuple:
    """The tree of an expression; an error for what these rules do not know."""
    return _Reader(pattern, any_case).read()


def mirrored(tree: tuple) -> tuple:
    """The tree of the reversed words."""
    kind = tree[0]
    if kind == "seq":
        return ("seq", [mirrored(part) for part in reversed(tree[1])])
    if kind == "or":
        return ("or", [mirrored(part) for part in tree[1]])
    return ("many", mirrored(tree[1]), *tree[2:]) if kind == "many" else tree


class _Graph:
    """States with steps on sets of bytes and without a byte."""

    def __init__(self) -> None:
        self.steps: list[list[tuple[frozenset, int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1

    def add(self, tree: tuple, begin: int) -> int:
        """Lay the tree's words out from ``begin``; the state where they end."""
        kind = tree[0]
        if kind == "set":
            end = self.state()
            self.steps[begin].append((tree[1], end))
        elif kind == "seq":
            end = begin
            for part in tree[1]:
                end = self.add(part, end)
        elif kind == "or":
            end = self.state()
            for part in tree[1]:
                inner = self.state()
                self.free[begin].append(inner)
                self.free[self.add(part, inner)].append(end)
        else:
            _, part, low, high = tree
            for _ in range(low):
                begin = self.add(part, begin)
            end = self.state()
            self.free[begin].append(end)
            if high is None:
                loop = self.state()
                self.free[begin].append(loop)
                back = self.add(part, loop)
                self.free[back] += [loop, end]
            for _ in range((high or low) - low):
                begin = self.add(part, begin)
                self.free[begin].append(end)
        return end

    def closed(self, states: set[int]) -> frozenset[int]:
        found, open_ = set(states), list(states)
        while open_:
            for state in self.free[open_.pop()]:
                if state not in found:
                    found.add(state)
                    open_.append(state)
        return frozenset(found)


def _byte_classes(graph: _Graph) -> tuple[np.ndarray, int]:
    """Bytes that no step tells apart share a class."""
    sets = list({members for steps in graph.steps for members, _ in steps})
    seen: dict[tuple, int] = {}
    class_of = np.array([seen.setdefault(tuple(byte in members for members in sets), len(seen)) for byte in range(256)], np.uint8)
    return class_of, len(seen)


def _minimal(step: np.ndarray, accepts: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Equal states as one: split by what they accept, then by where they lead, until nothing splits."""
    label = np.unique(accepts, return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([label, label[step]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == label.max():
            break
        label = finer
    first = np.unique(label, return_index=True)[1]
    return label[step[first]], accepts[first], int(label[start])


def compiled(trees: list[tuple], anywhere: bool) -> Automaton:
    """One automaton for all trees; rule k is bit k.  ``anywhere``: words may begin at every byte."""
    graph = _Graph()
    root = graph.state()
    if anywhere:
        graph.steps[root].append((_EVERY, root))
    ends: dict[int, int] = {}
    for k, tree in enumerate(trees):
        begin = graph.state()
        graph.free[root].append(begin)
        end = graph.add(tree, begin)
        ends[end] = ends.get(end, 0) | 1 << k
    class_of, n_classes = _byte_classes(graph)
    shown = [int(np.flatnonzero(class_of == k)[0]) for k in range(n_classes)]  # a byte of each class
    numbers = {graph.closed({root}): 0}
    step, accepts, open_ = [], [], list(numbers)
    for states in open_:  # grows
        accepts.append(sum({1 << k for state in states if state in ends for k in range(len(trees)) if ends[state] >> k & 1}))
        row = []
        for byte in shown:
            after = graph.closed({to for state in states for members, to in graph.steps[state] if byte in members})
            if after not in numbers:
                numbers[after] = len(numbers)
                open_.append(after)
            row.append(numbers[after])
        step.append(row)
    made, accepted, start = _minimal(np.array(step), np.array(accepts, np.int64), 0)
    dead = [k for k in range(len(made)) if not accepted[k] and (made[k] == k).all()]
    return Automaton(class_of, made.astype(np.int32), accepted, start, dead[0] if dead else -1)
