"""Cuts a text into chunks whose tokens don't depend on what stands around them, and remembers their tokens.

The pattern of byte-level BPE never puts a boundary's two sides into one match where a single blank stands between two
characters that aren't white space, so a text splits there. Chunks at which white space meets a blank are marked, and a
text that has one goes through the pattern as a whole.
"""

from __future__ import annotations

from collections.abc import Callable
from sys import getsizeof

import regex

#: Bytes of a generation; two generations are held. Keys of more characters than LONG aren't remembered, and a generation ends
#: in the middle of a text if it is full, so memory is bounded whatever the texts.
GENERATION = 20_000_000
LONG = 256
#: Bytes of an entry beside its key and its value, about.
ENTRY = 120
#: Marks that end a chunk often.
MARKS = frozenset(".,;:!?")


class Memory:
    """A dict of two generations of so many bytes: what isn't asked for during a whole generation is forgotten. make(key) fills it."""

    def __init__(self, make: Callable[[str], object], size: int = GENERATION):
        self.make, self.size, self.old, self.held = make, size, {}, 0
        memory = self

        class Young(dict):
            def __missing__(self, key):
                value = memory.old[key] if key in memory.old else memory.make(key)
                if len(key) <= LONG:
                    if memory.held > memory.size:
                        memory.old, memory.held = dict(self), 0
                        self.clear()  # the same dict goes on, since a text may be on its way through it
                    self[key] = value
                    memory.held += ENTRY + getsizeof(key) + getsizeof(value)
                return value

        self.young = Young()


class Chunks:
    """ids(text) as bytes: the ids of all matches of the pattern, by piece(match), joined."""

    def __init__(self, pattern: str, piece: Callable[[str], bytes], chunks: int = GENERATION, pieces: int = GENERATION):
        self.find = regex.compile(pattern).findall
        self.pieces = Memory(piece, pieces)
        self.chunks = Memory(self._chunk, chunks)

    def _chunk(self, chunk: str) -> bytes | None:
        if chunk.isalpha():  # letters after a blank are one match
            return self.pieces.young[" " + chunk]
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            return None
        if chunk[-1] in MARKS and chunk[:-1].isalpha():  # and so is a mark after them
            return self.pieces.young[" " + chunk[:-1]] + self.pieces.young[chunk[-1]]
        return self._join(" " + chunk)

    def _join(self, text: str) -> bytes:
        known = self.pieces.young
        return b"".join([known[p] for p in self.find(text)])

    def ids(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        if first and first[-1].isspace():
            return self._join(text)
        try:
            return self._join(first) + b"".join(map(self.chunks.young.__getitem__, rest))
        except TypeError:  # a marked chunk
            return self._join(text)
