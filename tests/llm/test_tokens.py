"""BPE against tiktoken, id files against the tokenizers library, on odd and random texts."""

import base64
import hashlib
import io
import random
import zlib
from array import array

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from tickloom.llm import bpe, idfiles
from tickloom.llm import common as C

MULTI, SINGLE = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json")
ODD = ["", " ", "\n\n  x", "a   b", "it's we'll 'sab' ''s", "☃ naïve 漢字 🙂🙂", "<|endoftext|> a", "tab\t here \r\n", "x" * 3000, "word " * 4000, "\x1c\x85  ", "  lead", "trail  ", "a \n b", "1234567 89"]


def texts(n=300):
    rng = random.Random(5)
    letters = list("abcdefghistn  '\n\t.,!?éçñüß☃漢  \x1c\x85\r19")
    out = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return ODD + out + ["".join(rng.choice("aeinorstlh") for _ in range(rng.randint(1, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def lib():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(MULTI, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_transducer(lib):
    own = bpe.Encoder(MULTI, P.PATTERN).encode
    for t in texts():
        assert list(array("I", own(t))) == lib.encode_ordinary(t)
    small = bpe.Encoder(MULTI, P.PATTERN, bpe.Bounds(50, 50, 20, 20)).encode  # nearly all states made for the moment
    for t in texts(50):
        assert list(array("I", small(t))) == lib.encode_ordinary(t)


def test_own_table():
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258, b"cd": 259, b"abcd": 260}
    machine = bpe.Transducer(ranks)
    rng = random.Random(2)
    for _ in range(2000):
        s = bytes(rng.choice(b"abcd") for _ in range(rng.randint(0, 14)))
        want = [ranks[t] for t in ([s] if s in ranks else bpe.merge(ranks, s))]
        assert list(array("I", machine.encode(s))) == (want if s else [])


def test_streaming_decode(lib):
    decoder = bpe.Decoder(MULTI)
    for t in texts(100):
        ids = lib.encode_ordinary(t)
        assert "".join(decoder.stream(ids)) == t
        machine = bpe.Utf8()
        data = t.encode()
        assert "".join(machine.feed(data[i : i + 1]) for i in range(len(data))) + machine.end() == t
    rng = random.Random(3)
    for _ in range(3000):
        data = bytes(rng.choice([0x41, 0x80, 0xBF, 0xC3, 0xE2, 0x98, 0x83, 0xED, 0xA0, 0xF0, 0x9F, 0xFF, 0xC0]) for _ in range(rng.randint(0, 9)))
        machine = bpe.Utf8()
        assert "".join(machine.feed(data[i : i + 1]) for i in range(len(data))) + machine.end() == data.decode("utf-8", "replace")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, ids string, note string").repartition(3)


def test_round_trip(spark, lib):
    rows = [*enumerate(texts(50)), (None, None), (7, "again"), (None, "x")]
    got = sorted(map(tuple, bpe.round_trip(frame(spark, rows), MULTI, P.PATTERN).collect()), key=str)
    want = []
    for i, t in rows:
        ids = array("I", lib.encode_ordinary(t or ""))
        want.append((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe.round_trip(frame(spark, []), MULTI, P.PATTERN).count() == 0
    ids = bpe.encode_documents(frame(spark, [(1, "a b")]), MULTI, P.PATTERN, ("note", "ids")).first()
    assert list(array("I", bytes(ids.ids))) == lib.encode_ordinary("a b") and ids.note == "y" and ids.n_tokens == 2


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("width", [2, 4])
def test_file_format(bits, width):
    rng = np.random.default_rng(1)
    docs = [(None, np.arange(3)), *[(i, rng.integers(0, 1 << (16 if width == 2 else 31), n)) for i, n in enumerate([0, 1, 5000, 17, 0, 100, 99])]]
    out = io.BytesIO()
    w = idfiles.Writer(out, width, bits, block_ids=64)
    for i, ids in docs:
        w.add(i, ids.astype(f"<u{width}"))
    w.close()
    reader = idfiles.Reader(out)
    got = list(reader.documents())
    assert [d for d, _ in got] == [d for d, _ in docs] and all((a == b).all() for (_, a), (_, b) in zip(got, docs))
    joined = np.concatenate([i for _, i in docs])
    assert (reader.block(3) == joined[192:256]).all()


@pytest.mark.parametrize("bits", [False, True])
def test_id_files(spark, bits):
    t = Tokenizer.from_file(SINGLE)
    t.encode_special_tokens = True
    rows = [*[(i * 7, x) for i, x in enumerate(texts(60))], (None, "none"), (14, "again"), (3, None)]
    manifest = idfiles.write_ids(frame(spark, rows), SINGLE, P.PATTERN, C.fresh_path(spark, "ids"), bits, file_docs=10)
    got = {(r.doc_id, r.ids_crc32): r for r in idfiles.read_ids(manifest).collect()}
    start, near = 0, 0
    for i, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 0]
        r = got[i, zlib.crc32(np.array(ids, "<u4").tobytes())]
        assert r.n_tokens == len(ids)
        near += r.start == start
        start += len(ids)
    assert len(got) == len(rows) and near >= len(rows) - 2 and manifest.count() > 3
    assert idfiles.read_ids(idfiles.write_ids(frame(spark, []), SINGLE, P.PATTERN, C.fresh_path(spark, "ids"))).count() == 0


def test_files_of_shared_ids(spark):
    """A third of the rows without ids and a third under one id: files stay small, and documents ascend from file to file."""
    rows = [*[(None, f"none {i}") for i in range(1000)], *[(50, f"same {i}") for i in range(1000)], *[(i, f"own {i}") for i in range(1000)], (50, None), (None, None)]
    manifest = idfiles.write_ids(frame(spark, rows), SINGLE, P.PATTERN, C.fresh_path(spark, "ids"), file_docs=100)
    files = manifest.orderBy("file_no").collect()
    assert max(f.n_docs for f in files) <= 250 and len(files) >= 25 and sum(f.n_docs for f in files) == len(rows)
    assert [f.path.rsplit("/", 1)[1] for f in files] == sorted(f.path.rsplit("/", 1)[1] for f in files)
    got = sorted(idfiles.read_ids(manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:k]) for k in range(len(got))]
    t = Tokenizer.from_file(SINGLE)
    want = sorted((i is not None, i or 0, zlib.crc32(np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], "<u4").tobytes())) for i, x in rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.ids_crc32) for r in got) == want


def test_added_tokens(spark, tmp_path):
    """The query gives the tokenizer's added tokens the ids that the library gives them."""
    from tickloom.llm import queries

    t = Tokenizer.from_file(SINGLE)
    rows = [*enumerate(["end of it.<|endoftext|>Next one", "<|endoftext|>", " <|endoftext|> <|endoftext|>a", "<|endoftext> |>", *texts(20)])]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in queries.op9_idfiles(spark, str(tmp_path)).collect()}
    for i, x in rows:
        ids = [*t.encode(x, add_special_tokens=False).ids, 0]
        assert got[i] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_memory_is_bounded():
    """One unspaced text and one of very many words, in a single call each: bytes stay within the two generations."""
    from sys import getsizeof

    from tickloom.llm.pretokens import Chunks

    size = 200_000
    chunks = Chunks(P.PATTERN, str.encode, size, size)
    rng = random.Random(1)
    unspaced = "".join(rng.choice("漢字假名αβγ") for _ in range(300_000))
    words = " ".join(f"w{i}x" for i in range(100_000))
    for text in (unspaced, words, unspaced + " " + words):
        assert chunks.ids(text) == text.encode()
        for memory in (chunks.chunks, chunks.pieces):
            held = sum(getsizeof(k) + getsizeof(v) for d in (memory.young, memory.old) for k, v in d.items())
            assert held <= 2 * size + 10_000 and max(map(len, [*memory.young, *memory.old, ""])) <= 256
