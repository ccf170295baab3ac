"""Token ids in binary files: fixed-size blocks of ids as byte or bit planes, each compressed, with a chunk index.

A file is b"TLID", then the planes of all blocks one after the other, then the index, compressed: the documents' ids,
their numbers of ids, and the blocks' offsets and plane sizes; then the index's size and the header's fields. Plane j of
a block has byte j (or bit j) of all its ids. Files hold documents in ascending order of ids, null ids first, one file to a
cell of ids, and the files' names ascend too; rows without ids, and those of an id that many rows share, are cut into files by a
hash of their texts. Null and empty texts have only the end id. Rows that repeat an id are rows
of their own, in the order of a hash of their texts; other columns aren't read; an empty table gives no files and no rows.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C
from .pretokens import Chunks

MAGIC = b"TLID"
BLOCK_IDS = 1 << 16
LEVEL = 1
END = 0
#: Documents to a file.
FILE_DOCS = 4096
#: Ranges of ids at most, a file each. The manifest's one window has a row per file.
FILES = 1 << 20
#: Bytes of chunks and of matches remembered, by a generation: the library is asked for what isn't.
REMEMBERED = (160_000_000, 80_000_000)
#: Texts that are Python objects at a time.
TOGETHER = 512


def to_planes(ids: np.ndarray, width: int, bits: bool) -> list[bytes]:
    columns = ids.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    if not bits:
        return [c.tobytes() for c in columns]
    return [np.packbits(c >> b & 1).tobytes() for c in columns for b in range(8)]


def from_planes(planes: list[bytes], n: int, width: int, bits: bool) -> np.ndarray:
    out = np.zeros((n, width), np.uint8)
    for j, plane in enumerate(planes):
        if bits:
            out[:, j // 8] |= np.unpackbits(np.frombuffer(plane, np.uint8), count=n) << j % 8
        else:
            out[:, j] = np.frombuffer(plane, np.uint8)
    return out.reshape(-1).view(f"<u{width}").astype(np.uint32)


class Writer:
    """Ids go in document by document; blocks go out as they fill, so memory doesn't grow with the file."""

    def __init__(self, out, width: int, bits: bool = False, block_ids: int = BLOCK_IDS):
        self.out, self.width, self.bits, self.block_ids = out, width, bits, block_ids
        self.pack = zstandard.ZstdCompressor(level=LEVEL).compress
        self.parts: list[np.ndarray] = []
        self.held = self.total = 0
        self.at = len(MAGIC)
        self.doc_ids: list[int | None] = []
        self.counts: list[int] = []
        self.blocks: list[list[int]] = []
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.counts.append(len(ids))
        self.parts.append(ids)
        self.held += len(ids)
        while self.held >= self.block_ids:
            joined = np.concatenate(self.parts)
            self._block(joined[: self.block_ids])
            self.parts = [joined[self.block_ids :]]
            self.held = len(self.parts[0])

    def _block(self, ids: np.ndarray) -> None:
        packed = [self.pack(p) for p in to_planes(ids, self.width, self.bits)]
        self.blocks.append([self.at, len(ids), *map(len, packed)])
        for p in packed:
            self.out.write(p)
            self.at += len(p)
        self.total += len(ids)

    def close(self) -> None:
        if self.held:
            self._block(np.concatenate(self.parts))
        nulls = [i for i, d in enumerate(self.doc_ids) if d is None]
        head = {"docs": len(self.counts), "blocks": len(self.blocks), "width": self.width, "bits": self.bits, "nulls": len(nulls)}
        body = np.array([d or 0 for d in self.doc_ids], "<i8").tobytes() + np.array(self.counts, "<u8").tobytes()
        body += np.array(nulls, "<u8").tobytes() + np.array(self.blocks, "<u8").tobytes()
        index = self.pack(body)
        fields = json.dumps(head).encode()
        self.out.write(index + fields + struct.pack("<QI", len(index), len(fields)) + MAGIC)


class Reader:
    """documents() yields (doc_id, ids) one by one; block(i) reads a chunk by itself."""

    def __init__(self, file):
        self.file, self.unpack = file, zstandard.ZstdDecompressor().decompress
        file.seek(0, 2)
        size = file.tell()
        tail = struct.calcsize("<QI") + len(MAGIC)
        file.seek(size - tail)
        index_size, fields_size = struct.unpack("<QI", file.read(tail)[: -len(MAGIC)])
        file.seek(size - tail - fields_size - index_size)
        body, head = self.unpack(file.read(index_size)), json.loads(file.read(fields_size))
        n, self.width, self.bits = head["docs"], head["width"], head["bits"]
        values = np.frombuffer(body, "<u8")
        self.doc_ids: list[int | None] = values[:n].view("<i8").tolist()
        self.counts = values[n : 2 * n].tolist()
        for i in values[2 * n : 2 * n + head["nulls"]].tolist():
            self.doc_ids[i] = None
        self.blocks = values[2 * n + head["nulls"] :].reshape(head["blocks"], -1).astype(np.int64)

    def block(self, i: int) -> np.ndarray:
        at, n, *sizes = self.blocks[i].tolist()
        self.file.seek(at)
        raw = self.file.read(sum(sizes))
        planes, start = [], 0
        for s in sizes:
            planes.append(self.unpack(raw[start : start + s]))
            start += s
        return from_planes(planes, n, self.width, self.bits)

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        held, at, following = np.zeros(0, np.uint32), 0, 0
        for doc_id, n in zip(self.doc_ids, self.counts, strict=True):
            parts = []
            while n > len(held) - at:
                parts.append(held[at:])
                n -= len(held) - at
                held, at = self.block(following), 0
                following += 1
            yield doc_id, np.concatenate([*parts, held[at : at + n]]) if parts else held[at : at + n]
            at += n


def byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write a byte as the Latin-1 character if that is printable, the rest as 256 and up in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}


def library_encoder(path: str, pattern: str, added: bool = False) -> Callable[[str], np.ndarray]:
    """A text to ids by the tokenizers library. Matches of the pattern are tokenized one by one in any case, so the library's
    model gets each that isn't remembered by itself. added: texts that hold one of the tokenizer's added tokens go to the library
    as a whole, which gives these their own ids; else they are text like any other."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    kind = np.dtype("<u2") if tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
    letters, code = byte_letters(), "H" if kind.itemsize == 2 else "I"
    tokenize = tokenizer.model.tokenize

    def piece(match: str) -> bytes:
        return array(code, [t.id for t in tokenize(match.encode().decode("latin-1").translate(letters))]).tobytes()

    ids = Chunks(pattern, piece, *REMEMBERED).ids
    own = [t.content for t in tokenizer.get_added_tokens_decoder().values()] if added else []

    def encode(text: str) -> np.ndarray:
        if any(t in text for t in own):
            return np.array(tokenizer.encode(text, add_special_tokens=False).ids, kind)
        return np.frombuffer(ids(text), kind)

    return encode


def write_ids(docs: DataFrame, path: str, pattern: str, out: str, bits: bool = False, file_docs: int = FILE_DOCS, added: bool = False) -> DataFrame:
    """Encode and write; returns the manifest: file_no, path, n_docs, n_ids, start (ids of all files before).

    Texts are shuffled once, to the cell of their id. A task writes a file per cell, under a name of its own, and only files
    that the manifest names count, so a task that is lost or runs twice leaves no trace in the result.
    """
    cell = C.id_cells(docs, file_docs, most=FILES, ties=F.col("mark"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), C.text_of().alias("text")).withColumn("mark", F.xxhash64("text"))
    rows = rows.select(cell.alias("cell"), "doc_id", "text", "mark").repartition("cell").sortWithinPartitions("cell", "doc_id", "mark").drop("mark")
    end = np.array([END])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = C.hold(("idfiles", path, pattern, added), lambda: library_encoder(path, pattern, added))
        fs, folder = C.open_fs(out)
        fs.create_dir(folder, recursive=True)
        now, name, stream, writer = None, "", None, None

        def closed():
            writer.close()
            stream.close()
            n = len(writer.counts)
            return pa.RecordBatch.from_pylist([{"file_no": now, "path": f"{out}/{name}", "n_docs": n, "n_ids": writer.total}])

        for batch in batches:
            for i in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(i, TOGETHER).to_pydict()
                for c, doc_id, text in zip(part["cell"], part["doc_id"], part["text"], strict=True):
                    ids = encode(text)
                    if writer is None or c != now:
                        if writer is not None:
                            yield closed()
                        now, name = c, f"ids-{c + C.TIE_PARTS:015d}-{uuid.uuid4().hex}.tlid"
                        stream = fs.open_output_stream(f"{folder}/{name}")
                        writer = Writer(stream, ids.dtype.itemsize, bits)
                    writer.add(doc_id, np.concatenate([ids, end.astype(ids.dtype)]))
        if writer is not None:
            yield closed()

    manifest = C.spool(rows.mapInArrow(run, "file_no long, path string, n_docs long, n_ids long"), "manifest")
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_ids(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 from the files of a manifest, a file at a time, block by block."""
    spark = manifest.sparkSession
    at_once = max(1, 2 * spark.sparkContext.defaultParallelism)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, file = C.open_fs(row["path"])
                with fs.open_input_file(file) as f:
                    start, out = row["start"], {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": []}
                    for doc_id, ids in Reader(f).documents():
                        out["doc_id"].append(doc_id)
                        out["start"].append(start)
                        out["n_tokens"].append(len(ids))
                        out["ids_crc32"].append(zlib.crc32(ids.astype("<u4").tobytes()))
                        start += len(ids)
                    yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(k, pa.int64()) for k in out]))

    spread = manifest.select("path", "start").repartition(at_once)
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
