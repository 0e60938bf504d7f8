"""WARC archives: writing, reading back, and a globally ordered index of captures.

Writing: a record per page as a gzip member of its own, so that an index offset can be
sought. A task joins its records into files of about ``file_bytes``, each a row that
Spark's text writer stores as it is, so lost tasks are written again by the commit
protocol. That writer ends a row with a separator of at least one byte: every file ends in
an empty gzip member, whose last byte is NUL, and that byte is left to the separator. Of
the records with one payload of at least ``min_revisit`` bytes the one with the smallest
id is the response and the others are revisits without payload. Only digests that occur
twice or more are joined back, broadcast up to ``broadcast_rows`` of them, else salted.

Reading: archive files, gzip or plain, parsed record by record from a stream, by the
lengths that the records state; offsets and lengths count stored bytes.

Index, merged externally: every task sorts the captures of each of its archives and merges
them with a loser tree into one run, which is written. Cut points from a bounded sample of
the runs divide the keys (URL key, timestamp, id, archive, offset), so that a hot host
spreads over many ranges; each run is cut there into sorted pieces that travel as one
block, and each range's task merges the pieces of all runs with a loser tree, a page of
each at a time. Ranges hold about ``range_rows`` captures however many there are. A
capture's position in the whole order is its place in its range after all ranges before.

Null html is an empty payload; null urls have no target line and an empty key; null ids
are written as ``-`` and read back as null, and come first among equal keys; repeated rows
are captures of their own, and those of one id that is the smallest of its payload are all
responses; captures that agree in key, timestamp and id come in order of archive and
offset; a page of any length is one record, which a task holds whole. An empty table gives
an empty result; further columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import io
import re
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkbrook.scratch import materialize, scratch_path

#: Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CRLF = "\r\n"
_SALTS = 32


def mark_revisits(pages: DataFrame, id_column: str, html_column: str, min_revisit: int, date_column: str | None = None, broadcast_rows: int = 200_000) -> DataFrame:
    """page_id, url, html, captured_at, payload_bytes, payload_digest, record_type and refers_to.

    captured_at: seconds since 1970 from ``date_column`` (a timestamp); without one, the
    capture clock ticks once an id.
    """
    html = F.coalesce(F.col(html_column), F.lit(""))
    seconds = F.unix_timestamp(F.col(date_column)) if date_column else F.pmod(F.col(id_column).cast("long"), F.lit(1 << 31))
    rows = pages.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        html.alias("html"),
        F.coalesce(seconds, F.lit(0)).cast("long").alias("captured_at"),
        F.octet_length(html).cast("long").alias("payload_bytes"),
        F.sha2(html, 256).alias("payload_digest"),
    )
    # digests that occur twice or more only; the counts are pre-aggregated, so a payload
    # that a third of all pages share reaches the exchange as one row per task
    firsts = (
        rows.filter(F.col("payload_bytes") >= min_revisit)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("payload_digest", "first_id")
    )
    firsts = materialize(firsts, "repeated-payloads")
    if firsts.count() <= broadcast_rows:
        joined = rows.join(F.broadcast(firsts), "payload_digest", "left")
    else:  # a hot payload's pages go to as many tasks as there are salts
        salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(_SALTS)).cast("int"))
        joined = salted.join(firsts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))), ["payload_digest", "salt"], "left")
    revisit = (F.col("payload_bytes") >= min_revisit) & (F.col("first_id") != F.col("page_id"))
    return joined.select(
        "page_id",
        "url",
        F.when(~F.coalesce(revisit, F.lit(False)), F.col("html")).alias("html"),
        F.date_format(F.timestamp_seconds("captured_at"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
        "payload_bytes",
        "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def _record(page_id: int | None, url: str | None, html: str | None, date: str, size: int, digest: str, kind: str, refers_to: int | None) -> bytes:
    http = _CRLF.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {size}", "", ""]).encode()
    block = http + (html or "").encode("utf-8", "surrogatepass")
    lines = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:capture:{'-' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", "%20", url))
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <urn:capture:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return _CRLF.join(lines).encode("utf-8", "surrogatepass") + block + (_CRLF * 2).encode()


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(pages: DataFrame, path: str, id_column: str = "page_id", html_column: str = "html", date_column: str | None = None, min_revisit: int = 100, file_bytes: int = 16 << 20, broadcast_rows: int = 200_000) -> None:
    """Archives below ``path``, a gzip member per record; a file ends once it has ``file_bytes``."""
    marked = mark_revisits(pages, id_column, html_column, min_revisit, date_column, broadcast_rows)
    last = _member(b"")[:-1]

    def files(batches):
        held, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(_member(_record(*row)))
                size += len(held[-1])
                if size >= file_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join([*held, last])], pa.binary())], names=["file"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join([*held, last])], pa.binary())], names=["file"])

    rows = marked.mapInArrow(files, "file binary").select(F.col("file").cast("string").alias("value"))
    rows.write.option("lineSep", "\x00").option("maxRecordsPerFile", 1).text(path)


class _Plain:
    """A stream of gzip members, or of plain bytes, that knows how many stored bytes are behind it."""

    def __init__(self, data: bytes):
        self.data, self.at, self.packed = memoryview(data), 0, data[:2] == b"\x1f\x8b"
        self.held, self.unpacker = bytearray(), None

    def fill(self) -> bool:
        """One more piece of plain bytes; False at the end of a member or of the file."""
        if not self.packed:
            piece = self.data[self.at : self.at + 65_536]
            self.held += piece
            self.at += len(piece)
            return bool(piece)
        if self.unpacker is None:
            if self.at >= len(self.data):
                return False
            self.unpacker = zlib.decompressobj(31)
        piece = self.data[self.at : self.at + 65_536]
        if not piece:
            raise ValueError("the archive is cut short")
        self.held += self.unpacker.decompress(piece)
        self.at += len(piece) - len(self.unpacker.unused_data)
        if self.unpacker.eof:
            self.unpacker = None
            return False
        return True

    def upto(self, mark: bytes) -> bytes | None:
        """Bytes up to and with ``mark``; None at the end of the file."""
        looked = 0
        while (found := self.held.find(mark, looked)) < 0:
            looked = max(0, len(self.held) - len(mark))
            if not self.fill() and (not self.packed or self.held or self.at >= len(self.data)):
                if self.held.find(mark, looked) >= 0:
                    continue
                if self.held.strip():
                    raise ValueError("a record's header is cut short")
                return None
        return self.take(found + len(mark))

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self.fill() and len(self.held) < n:
                raise ValueError("a record is cut short")
        out = bytes(memoryview(self.held)[:n])
        del self.held[:n]
        return out

    def place(self) -> int:
        """The stored offset of the next byte; in a packed stream, that of the next member, at a record's end."""
        if not self.packed:
            return self.at - len(self.held)
        while self.unpacker is not None:
            if not self.fill():
                break
        if self.held:
            raise ValueError("two records in one gzip member")
        return self.at


def parse_archive(data: bytes) -> Iterator[dict]:
    """The records of one archive with their places in the stored bytes. Empty members between records are skipped."""
    stream = _Plain(data)
    while True:
        offset = stream.place()
        head = stream.upto(b"\r\n\r\n")
        if head is None:
            return
        lines = head.decode("utf-8", "surrogatepass").split(_CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {offset}")
        fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:] if line)}
        block = stream.take(int(fields["content-length"]))
        if stream.take(4) != b"\r\n\r\n":
            raise ValueError(f"the record at byte {offset} doesn't end where its length says")
        http, _, payload = block.partition(b"\r\n\r\n")
        yield {"fields": fields, "http": http, "payload": payload, "offset": offset, "length": stream.place() - offset}


def url_key(url: str | None) -> str:
    """Sort-friendly form: host labels from the top down, then path and query; no scheme or www."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip().lower())
        host = (parts.hostname or "").removeprefix("www.")
        port = parts.port
    except ValueError:
        return url.lower()
    labels = ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in (80, 443) else "")
    return f"{labels}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


class LoserTree:
    """Merges k sorted iterators: inner nodes keep the losers, the winner is on top.

    Taking a row replays the matches on the way from its leaf to the top and no others.
    Equal rows come in order of their iterators.
    """

    def __init__(self, runs: list[Iterator], key):
        self.runs, self.key, self.k = [iter(r) for r in runs], key, len(runs)
        self.heads: list = [None] * self.k
        self.keys: list = [None] * self.k
        self.losers = [-1] * max(self.k, 1)
        for i in range(self.k):
            self._advance(i)
        self.winner = -1
        for i in range(self.k):
            self._replay(i, building=True)

    def _advance(self, i: int) -> None:
        self.heads[i] = next(self.runs[i], None)
        self.keys[i] = None if self.heads[i] is None else (self.key(self.heads[i]), i)

    def _beats(self, a: int, b: int) -> bool:
        return self.keys[a] is not None and (self.keys[b] is None or self.keys[a] < self.keys[b])

    def _replay(self, i: int, building: bool = False) -> None:
        node, best = (i + self.k) // 2, i
        while node > 0:
            held = self.losers[node]
            if held < 0 and building:
                self.losers[node] = best
                return
            if self._beats(held, best):
                self.losers[node], best = best, held
            node //= 2
        self.winner = best

    def __iter__(self):
        while self.k and self.heads[self.winner] is not None:
            i = self.winner
            yield self.heads[i]
            self._advance(i)
            self._replay(i)


_CAPTURE = "url_key string, timestamp string, page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, archive string, offset long, length long"
_NAMES = [c.split()[0] for c in _CAPTURE.split(", ")]
_PAGE = 500


def _arrow() -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64()}
    return pa.schema([(n, kinds[t]) for n, t in (c.split() for c in _CAPTURE.split(", "))])


def _sort_key(row: tuple):
    """From a capture's columns in the order of ``_CAPTURE``."""
    return row[0], row[1], row[2] is not None, row[2] or 0, row[8], row[9]


def _batches(rows: Iterator[tuple], size: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _number(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:capture:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def _captures(archive: str, data: bytes) -> list[tuple]:
    """One archive's captures as a sorted run; payloads that are there are checked against their digest."""
    run = []
    for r in parse_archive(data):
        f = r["fields"]
        digest = f["warc-payload-digest"].removeprefix("sha256:")
        size = int(re.search(rb"content-length:\s*(\d+)", r["http"], re.I)[1])
        if f["warc-type"] == "response" and (len(r["payload"]) != size or hashlib.sha256(r["payload"]).hexdigest() != digest):
            raise ValueError(f"{archive}: the payload at byte {r['offset']} doesn't match its digest")
        url = f.get("warc-target-uri")
        run.append((url_key(url), f["warc-date"], _number(f["warc-record-id"]), url, f["warc-type"], _number(f.get("warc-refers-to")), digest, size, archive, r["offset"], r["length"]))
    run.sort(key=_sort_key)
    return run


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all archives below ``path``, and ``run``: the rows of a run come together and sorted."""

    def parse(batches):
        number, runs = TaskContext.get().partitionId(), []
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content"), strict=True):
                runs.append(_captures(name.as_py(), content.as_py()))
        for batch in _batches(iter(LoserTree(runs, _sort_key)), 5000, _arrow()):
            yield pa.RecordBatch.from_arrays([pa.array([number] * batch.num_rows, pa.int32()), *batch.columns], names=["run", *_NAMES])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(parse, f"run int, {_CAPTURE}")


def merge_index(runs: DataFrame, range_rows: int = 50_000, sample: int = 100_000) -> DataFrame:
    """Captures of sorted ``runs`` (materialised) in global order, with ``position`` from 0.

    sample: keys from which the ranges are cut, at most twice as many.
    """
    total = runs.count()
    ranges = max(1, -(-total // range_rows))
    keys = ["url_key", "timestamp", "page_id", "archive", "offset"]
    draw = F.pmod(F.xxhash64("archive", "offset"), F.lit(1 << 30)) / float(1 << 30)
    picked = runs.filter(draw < min(1.0, sample / max(total, 1))).select(keys).limit(2 * sample).collect() if ranges > 1 else []
    drawn = sorted((r[0], r[1], r[2] is not None, r[2] or 0, r[3], r[4]) for r in picked)
    cuts = [drawn[len(drawn) * i // ranges] for i in range(1, ranges)] if drawn else []

    def pieces(batches):
        """Rows of one run come together; what lies in a range goes as one sorted block."""
        from bisect import bisect_right

        run, spot, held = None, 0, []

        def block():
            sink = io.BytesIO()
            with pa.ipc.new_stream(sink, _arrow()) as out:
                for batch in _batches(iter(held), _PAGE, _arrow()):
                    out.write_batch(batch)
            return pa.RecordBatch.from_arrays([pa.array([spot], pa.int32()), pa.array([run], pa.int32()), pa.array([len(held)], pa.int64()), pa.array([sink.getvalue()], pa.binary())], names=["range", "run", "n", "block"])

        for batch in batches:
            for number, *row in _rows(batch):
                key = _sort_key(row)
                if number != run or spot < len(cuts) and key >= cuts[spot]:
                    if held:
                        yield block()
                        held = []
                    run, spot = number, bisect_right(cuts, key)
                held.append(tuple(row))
        if held:
            yield block()

    cut = materialize(runs.mapInArrow(pieces, "range int, run int, n long, block binary"), "run-pieces")
    sizes = dict(cut.groupBy("range").agg(F.sum("n")).collect())  # a row per range
    before, done = {}, 0
    for number in range(ranges):
        before[number] = done
        done += sizes.get(number, 0)
    schema = _arrow().append(pa.field("position", pa.int64()))

    def merge(batches):
        """All pieces of a range are in one task; only a page of each is unpacked."""
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            for number, block in zip(batch.column("range").to_pylist(), batch.column("block").to_pylist(), strict=True):
                held.setdefault(number, []).append(block)
        for number in sorted(held):
            runs = [(row for page in pa.ipc.open_stream(block) for row in _rows(page)) for block in held.pop(number)]
            yield from _batches(((*row, before[number] + i) for i, row in enumerate(LoserTree(runs, _sort_key))), 5000, schema)

    dealt = cut.repartitionById(ranges, "range") if hasattr(cut, "repartitionById") else cut.repartitionByRange(ranges, "range")
    return dealt.select("range", "block").mapInArrow(merge, f"{_CAPTURE}, position long")


def archive_and_index(pages: DataFrame, path: str | None = None, range_rows: int = 50_000, **options) -> DataFrame:
    """Writes ``pages`` as archives, reads them back, and returns the merged index."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path, **options)
    return merge_index(materialize(read_captures(spark, path), "warc-runs"), range_rows)
