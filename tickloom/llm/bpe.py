"""Byte-level BPE encoding by a lazily determinised transducer, and streaming decoding by an incremental UTF-8 machine.

The merges of a rank table are compiled, state by state as texts ask for them, into a transducer over bytes. A state is
the bytes whose tokens aren't certain yet; for each end of those bytes it has the token that BPE would end with there. A
byte makes all tokens certain that every continuation shares (up to the last common end of all places at which a longer
token may have begun), and these are emitted. A register holds the last certain token; it guards arcs on which a new token
would stand right after it. Lookahead is bounded by the longest token. The end of a match emits the rest. Null and empty
texts have no ids; other columns aren't read; rows with null or repeated ids are rows of their own; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .pretokens import Chunks

#: States held at most, those met first, so all frequent ones; beyond them a state is made again when it is needed.
STATES = 100_000
#: Pairs of tokens held at most of which it is known whether they can be neighbours.
PAIRS = 200_000
#: Bytes of chunks and of matches remembered, by a generation.
CHUNKS, MATCHES = 60_000_000, 16_000_000
#: Ids decoded at a time.
DECODE_BLOCK = 4096


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def merge(ranks: dict[bytes, int], data: bytes) -> list[bytes]:
    """BPE as it is defined: merge the lowest-ranked adjacent pair until there is none."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1])
            if rank is not None and (best is None or rank < best):
                best, at = rank, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class State:
    """pending: bytes whose tokens aren't certain. ends[i]: the token that ends at i if a path that is still open goes
    through i, else empty; chains[i] has a bit for each end on the way to i. The certain token before isn't part of it."""

    __slots__ = ("arcs", "chains", "ends", "pending", "rest")

    def __init__(self, pending: bytes, ends: tuple[bytes, ...], chains: tuple[int, ...]):
        self.pending, self.ends, self.chains, self.arcs, self.rest = pending, ends, chains, {}, None


@dataclass(frozen=True)
class Bounds:
    """What a worker holds at most: states, pairs of tokens, bytes of chunks and of matches of a generation. No bound changes a
    result."""

    states: int = STATES
    pairs: int = PAIRS
    chunks: int = CHUNKS
    matches: int = MATCHES


class Transducer:
    """Arcs are (emitted ids, next state, last token emitted, guard, other arc): the arc is taken if the guard, a token, can
    follow the last certain token, else the other one. Only the token that all of the pending bytes form needs a guard."""

    def __init__(self, ranks: dict[bytes, int], bounds: Bounds = Bounds()):
        self.ranks, self.bounds = ranks, bounds
        self.code = {t: array("I", [r]).tobytes() for t, r in ranks.items()}
        self.beginnings = {t[:i] for t in ranks for i in range(1, len(t))}
        self.start = State(b"", (b"",), (1,))
        self.states = {(b"", (b"",)): self.start}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}

    def follows(self, last: bytes, token: bytes) -> bool:
        """Does BPE keep these two tokens apart when they stand together? (A token sequence is BPE's if all its neighbours do.)"""
        found = self.pairs.get((last, token))
        if found is None:
            found = merge(self.ranks, last + token) == ([last, token] if last else [token])
            if len(self.pairs) < self.bounds.pairs:
                self.pairs[last, token] = found
        return found

    def _emit(self, ends: tuple[bytes, ...], at: int) -> bytes:
        """The ids of the tokens that lead to at."""
        out = []
        while at:
            out.append(self.code[ends[at]])
            at -= len(ends[at])
        return b"".join(reversed(out))

    def _arc(self, state: State, byte: int) -> tuple:
        pending = state.pending + bytes((byte,))
        n, other = len(pending), None
        for k in range(1, n):
            token = pending[k:]
            if state.ends[k] and token in self.code and self.follows(state.ends[k], token):
                other = self._to(state, pending, token)
                break
        if pending in self.code:
            arc = (*self._to(state, pending, pending), pending, other)
        else:
            arc = (*other, None, None)
        if len(self.states) < self.bounds.states:  # else made for the moment
            state.arcs[byte] = arc
        return arc

    def _to(self, state: State, pending: bytes, token: bytes) -> tuple[bytes, State, bytes]:
        n = len(pending)
        ends = (*state.ends, token)
        chains = (*state.chains, state.chains[n - len(token)] | 1 << n)
        common = on_path = chains[n]
        for k in range(n):
            if (k == 0 or ends[k]) and pending[k:] in self.beginnings:
                common &= chains[k]
                on_path |= chains[k]
        cut = common.bit_length() - 1
        kept = (b"", *[ends[k] if on_path >> k & 1 else b"" for k in range(cut + 1, n + 1)])
        key = (pending[cut:], kept)
        to = self.states.get(key)
        if to is None:
            to = State(*key, tuple(c >> cut | 1 for c in chains[cut:]))
            if len(self.states) < self.bounds.states:
                self.states[key] = to
        return self._emit(ends, cut), to, ends[cut]

    def encode(self, data: bytes) -> bytes:
        """Ids of one match of the pattern, as little-endian 32-bit integers. A match that is a token is that token."""
        if data in self.code:
            return self.code[data]
        state, last, out = self.start, b"", []
        for byte in data:
            arc = state.arcs.get(byte) or self._arc(state, byte)
            if arc[3] is not None and not self.follows(last, arc[3]):
                arc = arc[4]
            if arc[0]:
                out.append(arc[0])
                last = arc[2]
            state = arc[1]
        if state.rest is None:
            state.rest = self._emit(state.ends, len(state.pending))
        out.append(state.rest)
        return b"".join(out)


class Encoder:
    """encode(text): the ids of all matches of the pattern, each by itself, as bytes."""

    def __init__(self, path: str, pattern: str, bounds: Bounds = Bounds()):
        self.transducer = Transducer(load_ranks(path), bounds)
        encode = self.transducer.encode
        self.encode = Chunks(pattern, lambda piece: encode(piece.encode()), bounds.chunks, bounds.matches).ids


class Decoder:
    """Ids to bytes, and to text as ids arrive: up to three bytes of an unfinished character wait for the next ids."""

    def __init__(self, path: str):
        tokens = {r: t for t, r in load_ranks(path).items()}
        self.tokens = [tokens.get(i, b"") for i in range(max(tokens, default=-1) + 1)]

    def data(self, ids: Iterable[int]) -> Iterator[bytes]:
        """The bytes, a block of ids at a time."""
        arriving = iter(ids)
        while block := list(islice(arriving, DECODE_BLOCK)):
            yield b"".join(map(self.tokens.__getitem__, block))

    def stream(self, ids: Iterable[int]) -> Iterator[str]:
        """The text piece by piece; bytes that aren't UTF-8 become U+FFFD, as bytes.decode does it for the whole."""
        machine = Utf8()
        for part in self.data(ids):
            yield machine.feed(part)
        yield machine.end()


class Utf8:
    """An incremental UTF-8 machine. Its state is the beginning of a character that the bytes so far leave unfinished."""

    #: First byte: bytes of the character; the second byte's range (RFC 3629).
    @staticmethod
    def needs(first: int) -> tuple[int, int, int]:
        if 0xC2 <= first <= 0xDF:
            return 2, 0x80, 0xBF
        if 0xE0 <= first <= 0xEF:
            return 3, 0xA0 if first == 0xE0 else 0x80, 0x9F if first == 0xED else 0xBF
        if 0xF0 <= first <= 0xF4:
            return 4, 0x90 if first == 0xF0 else 0x80, 0x8F if first == 0xF4 else 0xBF
        return 1, 0, 0

    def __init__(self):
        self.state = b""

    def _unfinished(self, data: bytes) -> int:
        """How many bytes at the end begin a character that more bytes could finish."""
        for back in range(1, min(3, len(data)) + 1):
            first = data[-back]
            if first & 0xC0 == 0x80:
                continue
            n, low, high = self.needs(first)
            if n <= back or (back >= 2 and not low <= data[-back + 1] <= high):
                return 0
            return back
        return 0

    def feed(self, data: bytes) -> str:
        data = self.state + data
        cut = len(data) - self._unfinished(data)
        self.state = data[cut:]
        return codecs.decode(data[:cut], "utf-8", "replace")

    def end(self) -> str:
        rest, self.state = self.state, b""
        return codecs.decode(rest, "utf-8", "replace")


def coder(path: str, pattern: str, bounds: Bounds = Bounds()) -> tuple[Encoder, Decoder]:
    """A worker keeps its automaton from task to task."""
    return C.hold(("bpe", path, pattern, bounds), lambda: (Encoder(path, pattern, bounds), Decoder(path)))


def _texts(batch: pa.RecordBatch, column: str = "text") -> Iterator[str]:
    """The texts of a batch one by one; null is empty."""
    for value in batch.column(batch.schema.get_field_index(column)):
        yield value.as_py() or ""


def encode_documents(docs: DataFrame, path: str, pattern: str, extra: tuple[str, ...] = (), bounds: Bounds = Bounds()) -> DataFrame:
    """doc_id, extra columns, n_tokens, ids (little-endian 32-bit integers, in bytes) and exact: do the ids decode to the text?

    An extra column of one of these names is left out."""
    extra = tuple(c for c in extra if c not in ("doc_id", "n_tokens", "ids", "exact"))
    kept = [F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c) for c in extra]]
    rows = docs.select(*kept, F.coalesce("text", F.lit("")).alias("text"))
    schema = rows.drop("text").schema.add("n_tokens", "long").add("ids", "binary").add("exact", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = coder(path, pattern, bounds)
        encode = encoder.encode
        for batch in C.slices(batches):
            counts, data, exact = [], [], []
            for text in _texts(batch):
                own = encode(text)
                ids = array("I", own)
                counts.append(len(ids))
                data.append(own)
                exact.append("".join(decoder.stream(ids)) == text)
            new = [pa.array(counts, pa.int64()), pa.array(data, pa.binary()), pa.array(exact, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *new], [*batch.schema.names[:-1], "n_tokens", "ids", "exact"])

    return rows.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: texts encoded, their ids decoded again as a stream, piece by piece through the
    UTF-8 machine; the digest is of the pieces' bytes. Whole texts, one at a time in memory."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = coder(path, pattern)
        encode = encoder.encode
        for batch in batches:
            counts, first, second = [], [], []
            for text in _texts(batch):
                data = encode(text)
                ids = array("I", data)
                decoded = hashlib.sha256()
                for part in decoder.stream(ids):
                    decoded.update(part.encode())
                counts.append(len(ids))
                first.append(hashlib.sha256(data).hexdigest())
                second.append(decoded.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
