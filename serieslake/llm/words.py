"""White-space chunks of a text and the pre-tokens in them, as a word-level BPE file defines them.

The file's normalizer (NFC, one space per white space, lower case) and its splitting pattern never
look across white space, so chunks can be treated one by one and repeated chunks once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import filterfalse

import regex
from tokenizers import Tokenizer

# Python's split also cuts at these four; Unicode's white space does not hold them.
_SEPARATORS = re.compile("[\x1c-\x1f]")
WHITE = re.compile("[ \t-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
# Fixed value: the splitting pattern of the word-level tokenizer file.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PIECES = regex.compile(PIECES)


# A lone mark behind a letter or digit and before white space is a piece of its own.  In a text that is not
# normal yet only ASCII letters and digits are sure to end in one: U+0130 becomes an i and a combining dot, which joins the mark.
_COMMA, _STOP = re.compile(r",(?=\s)(?<=[^\W_],)"), re.compile(r"\.(?=\s)(?<=[^\W_]\.)")
_PLAIN_COMMA, _PLAIN_STOP = re.compile(r",(?=\s)(?<=[A-Za-z0-9],)"), re.compile(r"\.(?=\s)(?<=[A-Za-z0-9]\.)")


def _simple(text: str) -> bool:
    """No combining marks: composed as it is, and lower case goes letter by letter."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return max(text) < "\u0300"
    return True


def chunks_of(text: str) -> list[str]:
    """The text's parts between white space, in lower case where that cannot change their tokens.

    Commas and full stops that end a word stand apart, so that fewer parts differ.
    """
    if "<|" not in text and _simple(text):
        text = _STOP.sub(" .", _COMMA.sub(" ,", text.lower()))
    else:
        text = _PLAIN_STOP.sub(" .", _PLAIN_COMMA.sub(" ,", text))
    if _SEPARATORS.search(text):
        return [part for part in WHITE.split(text) if part]
    return text.split()


class Memo(dict):
    """Values of chunks, computed for all new chunks together; emptied when it holds too many."""

    def __init__(self, compute: Callable[[list[str]], list], most: int = 650_000) -> None:
        super().__init__()
        self.compute, self.most = compute, most

    def values_of(self, chunks: list[str]) -> Iterator:
        new = list(set(filterfalse(self.__contains__, chunks)))
        if new and len(self) > self.most:
            self.clear()
            new = list(set(chunks))
        if new:
            self.update(zip(new, self.compute(new), strict=True))
        return map(self.__getitem__, chunks)


class Pretokens:
    """Splits chunks into pre-tokens, each as the UTF-8 bytes of its normalized text.

    Special strings stand as ``None``: they are one token each, whatever surrounds them.
    """

    def __init__(self, tokenizer: Tokenizer) -> None:
        self.tokenizer = tokenizer
        special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.marks = {content[:2] for content in special}
        self.bytes_of = {char: byte for byte, char in enumerate(byte_characters())}

    def split(self, chunk: str) -> list[bytes | None]:
        if any(mark in chunk for mark in self.marks):
            parts = self.special.split(chunk)
            return [x for i, part in enumerate(parts) for x in ([None] if i % 2 else self._plain(part))]
        return self._plain(chunk)

    def _plain(self, chunk: str) -> list[bytes]:
        if not chunk:
            return []
        if _simple(chunk):
            return [piece.encode() for piece in _PIECES.findall(chunk.lower())]
        normal = self.tokenizer.normalizer.normalize_str(chunk)
        pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)
        return [bytes(self.bytes_of[char] for char in piece) for piece, _ in pieces]


def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level files: itself if printable, else from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(byte) if byte in shown else chr(next(spare)) for byte in range(256)]
