"""WARC archives with a globally ordered capture index, made by an external merge.

Writers put a gzip member per record into archives of bounded size; the captures of an archive, sorted by URL key and
timestamp, are its run. Runs are merged by loser trees, at most FAN at a time: passes of whole runs until FAN are left, then
a last pass in which each task merges a range of keys of all runs. Its output, in the order of ranges, is the history of all
captures. Archives are read back through it, record by record in the order of their places.

Of records with equal payloads of at least LEAST bytes the one with the largest page_id is a response, the others are
revisits of it; smaller ones are responses. Null html is an empty payload; null urls have the key "-". Rows with null ids
are responses unless a row with an id has their payload; rows that repeat an id and a payload are alike. An empty table gives
no archives and no rows. Only page_id, url and html are read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta, timezone
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

LEAST = 1000
#: Captures of a run and bytes of an archive, about; runs that are merged at a time; captures of a range of the last pass.
RUN, ARCHIVE, FAN, RANGE = 20_000, 64 << 20, 64, 50_000
#: Keys that a run shows to those who choose the ranges.
SHOWN = 32
LEVEL = 1
FIRST = datetime(2024, 1, 1, tzinfo=timezone.utc)
RECORD = "urn:tickloom:page:"


def url_key(url: str | None) -> str:
    """The host's labels in reverse, then path and query, in lower case; without scheme, www, default port and fragment."""
    if not url:
        return "-"
    try:
        u = urlsplit(url.strip())
        host, port = (u.hostname or "").removeprefix("www."), u.port
    except ValueError:
        return re.sub(r"\s", "%20", url.lower())
    shown = ",".join(reversed(host.split("."))) + (f":{port}" if port not in (None, 80, 443) else "")
    rest = (u.path or "/") + (f"?{u.query}" if u.query else "")
    return re.sub(r"\s", "%20", f"{shown}){rest}".lower())


def capture_time(page_id: int | None) -> datetime:
    """Pages have no time of capture, so the id stands for it, in seconds."""
    return FIRST + timedelta(seconds=(page_id or 0) % (1 << 31))


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record, not compressed. A revisit has the headers of the response, its length among them, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<{RECORD}{'-' if page_id is None else page_id}>",
        "WARC-Target-URI": re.sub(r"\s", "%20", url or "-"),
        "WARC-Date": capture_time(page_id).strftime("%Y-%m-%dT%H:%M:%SZ"),
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode(),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if refers_to is not None:
        fields |= {"WARC-Refers-To": f"<{RECORD}{refers_to}>", "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """page_id, payload_bytes, payload_digest (hex), record_type, refers_to, payload (None for revisits), url, date."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged payload in {fields['WARC-Record-ID']}")
    number = lambda v: None if v is None or v[1:-1].removeprefix(RECORD) == "-" else int(v[1:-1].removeprefix(RECORD))
    return {
        "page_id": number(fields["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": number(fields.get("WARC-Refers-To")),
        "payload": None if revisit else payload, "url": fields["WARC-Target-URI"], "date": fields["WARC-Date"],
    }


class LoserTree:
    """Merges sorted iterators: each inner node keeps the loser of its match, so the next item costs one match per level."""

    def __init__(self, sources: Iterable[Iterator]):
        self.sources = [iter(s) for s in sources]
        self.k = max(1, len(self.sources))
        self.items = [next(s, None) for s in self.sources] or [None]
        self.losers = [-1] * self.k
        for i in range(self.k):
            self._play(i)

    def _less(self, a: int, b: int) -> bool:
        """Is a's item before b's? An iterator that is done comes last; equal items come in the order of the sources."""
        x, y = self.items[a], self.items[b]
        if x is None or y is None:
            return x is not None or (y is None and a < b)
        return x < y or (x == y and a < b)

    def _play(self, winner: int) -> None:
        node = (winner + self.k) // 2
        while node > 0:
            other = self.losers[node]
            if other < 0:
                self.losers[node] = winner
                return
            if self._less(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator:
        while self.items[at := self.losers[0]] is not None:
            yield self.items[at]
            self.items[at] = next(self.sources[at], None)
            self._play(at)


def _line(capture: dict) -> bytes:
    """URL key, timestamp and place of a capture; lines sort as keys and timestamps do (a tab is before all else in a key)."""
    rest = json.dumps({k: v for k, v in capture.items() if k not in ("key", "time")}, separators=(",", ":"))
    return f"{capture['key']}\t{capture['time']}\t{rest}\n".encode()


def _order(line: bytes) -> bytes:
    return line.rsplit(b"\t", 1)[0]


def _lines_from(file, low: bytes | None) -> Iterator[tuple[bytes, bytes]]:
    """(order, line) of a run from the first line that isn't below low, found by bisection over the file's bytes."""
    begin, end = 0, file.size()
    while low is not None and begin < end:
        middle = (begin + end) // 2
        file.seek(middle)
        skipped = len(_read_line(file)) if middle else 0
        line = _read_line(file)
        if line and _order(line) < low:
            begin = middle + skipped + len(line)
        else:
            end = middle
    file.seek(begin)
    rest = b""
    while chunk := file.read(1 << 16):
        *lines, rest = (rest + chunk).split(b"\n")
        for line in lines:
            if low is None or (order := _order(line)) >= low:  # bisection may end a line early
                yield _order(line) if low is None else order, line
    if rest:
        yield _order(rest), rest


def _read_line(file) -> bytes:
    at, out = file.tell(), b""
    while chunk := file.read(512):
        out += chunk
        if (cut := out.find(b"\n")) >= 0:
            file.seek(at + cut + 1)
            return out[: cut + 1]
    return out


def _open_runs(paths: list[str]) -> list:
    opened = []
    for path in paths:
        fs, file = C.open_fs(path)
        opened.append(fs.open_input_file(file))
    return opened


def _shown(lines: list[bytes]) -> list[str]:
    step = max(1, len(lines) // SHOWN)
    return [_order(x).decode() for x in lines[::step]]


RUN_SCHEMA = "path string, captures long, shown array<string>"


def decide(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, refers_to (null for responses). Payloads are joined to the revisits alone, by (id, digest)."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"), F.unhex(F.sha1(payload)).alias("digest"))
    small = C.spool(rows.select("page_id", "digest", F.octet_length("payload").alias("n")), "payloads")
    large = small.where(F.col("n") >= LEAST)
    groups = C.spool(large.groupBy("digest").agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("size")).where("size > 1 and response is not null"), "equal")
    total = small.count()
    again = C.attach(large.join(groups.select("digest").hint("merge"), "digest", "left_semi"), groups, "digest", "size", total)
    again = again.where(~F.col("page_id").eqNullSafe(F.col("response"))).select(F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), F.col("response").alias("refers_to")).distinct()
    again = C.spool(again, "revisits")
    again = F.broadcast(again) if again.count() <= C.FEW else again.hint("merge")
    return rows.join(again, F.col("digest").eqNullSafe(F.col("_digest")) & F.col("page_id").eqNullSafe(F.col("_id")), "left").drop("_id", "_digest")


def write_archives(pages: DataFrame, out: str) -> DataFrame:
    """Archives and their runs; returns the runs: path, captures, shown. What a lost or repeated task wrote isn't named there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = C.open_fs(out)
        fs.create_dir(folder, recursive=True)
        stream, name, at, captures = None, "", 0, []

        def closed() -> pa.RecordBatch:
            stream.close()
            lines = sorted(captures, key=_order)
            with fs.open_output_stream(f"{folder}/{name}.run") as f:
                for line in lines:
                    f.write(line)
            return pa.RecordBatch.from_pylist([{"path": f"{out}/{name}.run", "captures": len(lines), "shown": _shown(lines)}])

        for batch in batches:
            for page_id, url, payload, refers_to in zip(*[batch.column(i) for i in range(4)], strict=True):
                page_id, url, refers_to = page_id.as_py(), url.as_py(), refers_to.as_py()
                if stream is None:
                    name, at, captures = f"pages-{uuid.uuid4().hex}.warc.gz", 0, []
                    stream = fs.open_output_stream(f"{folder}/{name}", compression=None)
                pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                data = pack.compress(record(page_id, url, payload.as_py(), refers_to)) + pack.flush()
                stream.write(data)
                captures.append(_line({"key": url_key(url), "time": capture_time(page_id).strftime("%Y%m%d%H%M%S"), "id": page_id, "file": f"{out}/{name}", "at": at, "size": len(data)}))
                at += len(data)
                if at >= ARCHIVE or len(captures) >= RUN:
                    yield closed()
                    stream = None
        if stream is not None:
            yield closed()

    return C.spool(decide(pages).select("page_id", "url", "payload", "refers_to").mapInArrow(run, RUN_SCHEMA), "runs")


def merge_pass(runs: DataFrame, out: str, fan: int) -> DataFrame:
    """Groups of fan runs, each merged to one run by a task that holds a block of each."""
    numbered = runs.rdd.zipWithIndex().map(lambda r: (r[1] // fan, r[0]["path"])).toDF("merged long, path string")

    def merge(key, table):
        paths = sorted(table.column("path").to_pylist())
        fs, folder = C.open_fs(out)
        name, n, shown, step = f"merged-{uuid.uuid4().hex}.run", 0, [], 1
        opened = _open_runs(paths)
        with fs.open_output_stream(f"{folder}/{name}") as f:
            for order, line in LoserTree([_lines_from(o, None) for o in opened]):
                f.write(line + b"\n")
                if n % step == 0:
                    shown.append(order.decode())
                    if len(shown) > 4 * SHOWN:
                        shown, step = shown[::2], step * 2
                n += 1
        for o in opened:
            o.close()
        return pa.Table.from_pylist([{"path": f"{out}/{name}", "captures": n, "shown": shown}], schema=pa.schema([("path", pa.string()), ("captures", pa.int64()), ("shown", pa.list_(pa.string()))]))

    return C.spool(numbered.groupBy("merged").applyInArrow(merge, RUN_SCHEMA), "runs")


def merge_runs(runs: DataFrame, out: str, fan: int = FAN, range_captures: int = RANGE) -> DataFrame:
    """range_no, nth, url_key, timestamp, page_id, file, at, size: all captures, ordered by (range_no, nth) as by key and timestamp.

    At most fan run paths and fan * 4 * SHOWN shown keys come to the driver.
    """
    spark = runs.sparkSession
    while runs.count() > fan:
        runs = merge_pass(runs, out, fan)
    some = runs.collect()
    paths, total = [r.path for r in some], sum(r.captures for r in some)
    # a run's shown keys stand for as many captures each as it has over as many keys
    keys = sorted((k, r.captures / len(r.shown)) for r in some for k in r.shown)
    n_ranges, cuts, passed = max(1, -(-total // range_captures)), [], 0.0
    for k, weight in keys:
        passed += weight
        if passed >= total * (len(cuts) + 1) / n_ranges and len(cuts) < n_ranges - 1 and (not cuts or k > cuts[-1]):
            cuts.append(k)
    ranges = [(i, a, b) for i, (a, b) in enumerate(zip([None, *cuts], [*cuts, None]))]
    parts = spark.createDataFrame(ranges, "range_no long, low string, high string").repartition(len(ranges), "range_no")
    names = ["range_no", "nth", "url_key", "timestamp", "page_id", "file", "at", "size"]
    schema = pa.schema([(n, pa.string() if n in ("url_key", "timestamp", "file") else pa.int64()) for n in names])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                low, high = (None if part[k] is None else part[k].encode() for k in ("low", "high"))
                opened, rows = _open_runs(paths), []
                for n, (order, line) in enumerate(LoserTree([_lines_from(o, low) for o in opened])):
                    if high is not None and order >= high:
                        break
                    key, time, rest = line.decode().split("\t")
                    place = json.loads(rest)
                    rows.append((part["range_no"], n, key, time, place["id"], place["file"], place["at"], place["size"]))
                    if len(rows) == 8192:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                for o in opened:
                    o.close()

    return C.spool(parts.mapInArrow(merge, "range_no long, nth long, url_key string, timestamp string, page_id long, file string, at long, size long"), "history")


def read_records(history: DataFrame) -> DataFrame:
    """page_id, url_key, timestamp, payload_bytes, payload_digest, record_type, refers_to of the records at the places of a
    history; payloads are checked against their digests. Places are sorted, so an archive is read from front to back."""
    places = history.select("file", "at", "size", "url_key", "timestamp").repartition("file").sortWithinPartitions("file", "at")
    wanted = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        for batch in batches:
            out = []
            for place in batch.to_pylist():
                if place["file"] != name:
                    if source is not None:
                        source.close()
                    name = place["file"]
                    fs, file = C.open_fs(name)
                    source = fs.open_input_file(file)
                data = zlib.decompress(source.read_at(place["size"], place["at"]), 31)
                found = parse(data)
                out.append({"url_key": place["url_key"], "timestamp": place["timestamp"]} | {k: found[k] for k in wanted})
            types = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64()}
            names = ["url_key", "timestamp", *wanted]
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([(n, types.get(n, pa.string())) for n in names]))
        if source is not None:
            source.close()

    return places.mapInArrow(run, "url_key string, timestamp string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def round_trip(pages: DataFrame, out: str) -> DataFrame:
    """Archives written, runs merged, records read back: a row per page, without url_key and timestamp."""
    history = merge_runs(write_archives(pages, out), out)
    return read_records(history).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
