"""Pre-tokens (the matches of the public byte-level pattern) and bounded caches for workers."""

from __future__ import annotations

import re
from collections.abc import Callable

from .common import per_worker

#: The public pattern's suffixes, and its classes below U+0250.
SUFFIXES = "'(?:s|t|re|ve|m|ll|d)"
NEAR_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
NEAR_NUMBERS = "0-9²³¹¼-¾"
NEAR_SPACES = r"\t-\r \x85\xa0"

_FAR = re.compile("[^\x00-ɏ]")


def _pattern(letters: str, numbers: str, spaces: str) -> re.Pattern[str]:
    return re.compile(rf" ?[{letters}]+|{SUFFIXES}| ?[{numbers}]+| ?[^{spaces}{letters}{numbers}]+"
                      rf"|[{spaces}]+(?![^{spaces}])|[{spaces}]+")


_NEAR = _pattern(NEAR_LETTERS, NEAR_NUMBERS, NEAR_SPACES)


def _ranges(chars: str) -> str:
    """A character class body for ``chars``, which are in order."""
    codes = [ord(c) for c in chars]
    starts = [c for i, c in enumerate(codes) if not i or codes[i - 1] != c - 1]
    ends = [c for i, c in enumerate(codes) if i + 1 == len(codes) or codes[i + 1] != c + 1]
    return "".join(re.escape(chr(a)) + "-" + re.escape(chr(b)) for a, b in zip(starts, ends))


def _everywhere() -> re.Pattern[str]:
    """The pattern over all of Unicode, with the classes of the tokenizer library's own version
    of Unicode (Python's may be newer), asked from the library."""
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    singles = {bytes([b]): b for b in range(256)}

    def members(cls: str) -> str:
        only = tiktoken.Encoding("class", pat_str=cls, mergeable_ranks=singles, special_tokens={})
        return _ranges(only.decode(only.encode_ordinary(every)))

    return _pattern(members(r"\p{L}"), members(r"\p{N}"), members(r"\s"))


def pretokens(text: str) -> list[str]:
    """All matches of the pattern, in order; together they are the whole text."""
    return (per_worker(("pattern",), _everywhere) if _FAR.search(text) else _NEAR).findall(text)


class Cache(dict):
    """``make(key)`` remembered for about the ``limit`` most recent keys, in two generations."""

    def __init__(self, make: Callable, limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit // 2, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        # Long keys are rare and dear: they are made anew each time.
        if len(key) <= 64:
            self[key] = value
        return value
