"""WARC archives and their globally ordered capture index (operator 3).

Writing: one WARC/1.1 file a task, each record its own gzip member.  Of records
with equal payloads of at least MIN_SHARED bytes, the one with the smallest
page_id is a response and the others are revisits that refer to it.

Reading: one streaming pass a file yields its captures, whose digests are
checked against the payloads.

Index: the captures of each task, sorted by URL key, time and page, are a run.
Runs are written, dealt to ranges of the key (a hot URL is split by time), and
the pieces of all runs that reach a range are merged with a loser tree: one
comparison a level to replace the winner by its run's next capture.
"""

from __future__ import annotations

import datetime
import hashlib
import posixpath
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Scratch

MIN_SHARED = 100
NO_ID = (1 << 63) - 1
CHUNK = 1 << 20
_URL = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)([^#]*)", re.S)
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def url_key(url: str | None) -> str:
    """Host names from the top down, then path and query: ``com,example,blog)/en/1?x=2``.

    Without scheme, a leading ``www.`` and the fragment; hosts in lower case.
    What has no scheme and host is its own key; null gives the empty key.
    """
    m = _URL.match(url or "")
    if not m:
        return url or ""
    host = m[1].lower().removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")" + (m[2] or "/")


def file_system(uri: str):
    """(Arrow file system, path) of a shared folder, local or remote."""
    from pyarrow import fs

    if re.match(r"[a-zA-Z][a-zA-Z0-9+.-]+:", uri) and not uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", uri)


def record(page_id: int | None, url: str | None, seconds: int, payload: bytes, digest: str,
           refers_to: int | None) -> bytes:
    """One WARC record; a revisit has the HTTP headers of its capture but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    when = datetime.datetime.fromtimestamp(seconds, datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    name = "" if page_id is None else page_id
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:x-page:{name}>", f"WARC-Date: {when}"]
    if url is not None:
        head.append("WARC-Target-URI: " + _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = file_system(folder)
        task = TaskContext.get()
        final = posixpath.join(base, f"part-{task.partitionId():06d}.warc.gz")
        own = f"{final}.{task.taskAttemptId()}"
        files.create_dir(base, recursive=True)
        n = 0
        with files.open_output_stream(own, compression=None) as out:
            for batch in batches:
                for row in batch.to_pylist():
                    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                    data = record(row["page_id"], row["url"], row["seconds"], row["html"].encode(), row["digest"],
                                  row["refers_to"])
                    out.write(packer.compress(data) + packer.flush())
                    n += 1
        if n:  # a task that is run again replaces its file as a whole
            files.move(own, final)
            yield pa.RecordBatch.from_pydict({"file": [final], "records": pa.array([n], pa.int64())})
        else:
            files.delete_file(own)
    return run


def first_pages(pages: DataFrame, min_bytes: int = MIN_SHARED) -> DataFrame:
    """(_id, digest, refers_to) of the pages whose payload a page with a smaller id has."""
    long = pages.filter(F.col("size") >= min_bytes).select("_id", "digest")
    firsts = long.groupBy("digest").agg(F.min("_id").alias("refers_to"), F.max("_id").alias("last")) \
        .filter("refers_to < last").select("digest", "refers_to")
    return long.join(firsts, "digest").filter("_id > refers_to").distinct()


def write_warc(pages: DataFrame, folder: str, seconds: Column | None = None, min_bytes: int = MIN_SHARED) -> DataFrame:
    """Writes a record for each row of ``pages`` (page_id, url, html) below ``folder``; (file, records) of each file.

    Null html is empty.  ``seconds``: capture time since 1970 (null or none: 0).
    Rows that repeat a page_id with the same payload are all responses if it is
    the smallest; a null page_id is larger than all others.  Nothing is written
    until the result is read, and each action on it writes again.
    """
    when = F.coalesce(seconds.cast("long"), F.lit(0)) if seconds is not None else F.lit(0).cast("long")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.coalesce("html", F.lit("")).alias("html"), when.alias("seconds"))
    rows = rows.withColumns({"_id": F.coalesce("page_id", F.lit(NO_ID)), "digest": F.sha2("html", 256),
                             "size": F.octet_length("html")})
    known = first_pages(rows, min_bytes).hint("merge")
    return rows.join(known, ["_id", "digest"], "left") \
        .select("page_id", "url", "html", "seconds", "digest", "refers_to") \
        .mapInArrow(_write(folder), "file string, records long")


def members(stream) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of each gzip member of a file."""
    rest, start, at = b"", 0, 0
    unpack, parts = None, []
    while True:
        if not rest:
            rest = stream.read(CHUNK)
            if not rest:
                break
            at += len(rest)
        if unpack is None:
            unpack, parts, start = zlib.decompressobj(31), [], at - len(rest)
        parts.append(unpack.decompress(rest))
        rest = unpack.unused_data
        if unpack.eof:
            yield start, at - len(rest) - start, b"".join(parts)
            unpack = None
    if unpack is not None:
        raise ValueError("the archive ends within a record")


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Named fields (in lower case) and payload of a record; the payload of a revisit is empty."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[:int(fields["content-length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def _page(name: str | None) -> int | None:
    number = (name or "").strip("<>").rpartition(":")[2]
    return int(number) if number else None


CAPTURE = ("page_id long, url string, url_key string, seconds long, record_type string, refers_to long, "
           "payload_digest string, payload_bytes long, file string, offset long, length long")


def _read(with_payload: bool):
    names = [x.split(" ")[0] for x in CAPTURE.split(", ")] + (["payload"] if with_payload else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("file").to_pylist():
                files, path = file_system(file)
                rows: list[tuple] = []
                held = 0
                with files.open_input_stream(path, compression=None) as stream:
                    for offset, length, data in members(stream):
                        fields, payload = parse(data)
                        kind, digest = fields["warc-type"], fields["warc-payload-digest"].rpartition(":")[2]
                        if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"{file}: the payload at {offset} does not match its digest")
                        when = datetime.datetime.strptime(fields["warc-date"], "%Y-%m-%dT%H:%M:%S%z")
                        url = fields.get("warc-target-uri")
                        rows.append((_page(fields["warc-record-id"]), url, url_key(url), int(when.timestamp()), kind,
                                     _page(fields.get("warc-refers-to")), digest,
                                     len(payload) if kind == "response" else None, file, offset, length)
                                    + ((payload,) if with_payload else ()))
                        held += len(payload) * with_payload
                        if len(rows) >= 5000 or held > 8 * CHUNK:
                            yield _batch(rows, names)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows, names)
    return run


_TYPES = {"page_id": pa.int64(), "seconds": pa.int64(), "refers_to": pa.int64(), "payload_bytes": pa.int64(),
          "offset": pa.int64(), "length": pa.int64(), "payload": pa.binary(), "run": pa.int32(), "shard": pa.int32(),
          "place": pa.int64()}


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(col, _TYPES.get(c, pa.string())) for c, col in zip(names, zip(*rows))], names)


def read_warc(files: DataFrame, with_payload: bool = False) -> DataFrame:
    """The captures in the archives named by ``file``, one task a file; ``payload`` binary if asked for.

    A response whose payload does not match its digest is an error.
    """
    parts = max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return files.select("file").repartition(parts, "file") \
        .mapInArrow(_read(with_payload), CAPTURE + (", payload binary" if with_payload else ""))


class LoserTree:
    """Merges sorted lists: the winner of a tournament leaves, and only its path is played again."""

    def __init__(self, lists: list[list], key):
        self._lists = [x for x in lists if x]
        self._key = key
        self._n = n = len(self._lists)
        self._at = [0] * n
        self._head = [key(x[0]) for x in self._lists]
        self._loser = [0] * max(1, n)  # at each inner node 1..n-1; the winner at 0
        winner = [0] * n + list(range(n))
        for node in range(n - 1, 0, -1):
            a, b = winner[2 * node], winner[2 * node + 1]
            if self._beats(b, a):
                a, b = b, a
            winner[node], self._loser[node] = a, b
        self._loser[0] = winner[1] if n > 1 else 0

    def _beats(self, a: int, b: int) -> bool:
        if self._head[a] is None or self._head[b] is None:
            return self._head[b] is None and self._head[a] is not None
        return (self._head[a], a) < (self._head[b], b)

    def __iter__(self) -> Iterator:
        if not self._n:
            return
        while self._head[w := self._loser[0]] is not None:
            run = self._lists[w]
            yield run[self._at[w]]
            self._at[w] += 1
            self._head[w] = self._key(run[self._at[w]]) if self._at[w] < len(run) else None
            node = (w + self._n) // 2
            while node:
                if self._beats(self._loser[node], w):
                    w, self._loser[node] = self._loser[node], w
                node //= 2
            self._loser[0] = w


def _order(row: tuple) -> tuple:
    """URL key, time, page (null last)."""
    return row[2], row[3], NO_ID if row[0] is None else row[0]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs: dict[int, list[tuple]] = {}
    names: list[str] = []
    for batch in batches:
        names = batch.schema.names
        for row in zip(*(batch.column(c).to_pylist() for c in names)):
            runs.setdefault(row[-1], []).append(row)
    for run in runs.values():  # pieces of a run may arrive as several blocks
        if any(_order(a) > _order(b) for a, b in zip(run, run[1:])):
            run.sort(key=_order)
    shard, rows = TaskContext.get().partitionId(), []
    for place, row in enumerate(LoserTree([runs[r] for r in sorted(runs)], _order)):
        rows.append((*row[:-1], shard, place))
        if len(rows) == 10_000:
            yield _batch(rows, [*names[:-1], "shard", "place"])
            rows = []
    if rows:
        yield _batch(rows, [*names[:-1], "shard", "place"])


def capture_index(captures: DataFrame, scratch: Scratch, parts: int | None = None) -> DataFrame:
    """All captures with ``shard`` and ``place``: in order of both, they are in order of URL key, time and page."""
    parts = parts or int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["url_key", "seconds", F.coalesce("page_id", F.lit(NO_ID))]
    runs = scratch.keep(captures.sortWithinPartitions(*keys).withColumn("run", F.spark_partition_id()))
    return scratch.keep(runs.repartitionByRange(parts, *keys)
                        .mapInArrow(_merge, CAPTURE + ", shard int, place long"))


def round_trip(pages: DataFrame, seconds: Column | None = None) -> DataFrame:
    """Pages written to archives and read back: a row for each record, in columns of CAPTURE and ``history``.

    ``history``: place from 0 in the order of URL key, time and page over all
    captures.  payload_bytes of a revisit is that of the response it refers to.
    """
    with Scratch(pages.sparkSession, "warc") as scratch:
        files = scratch.keep(write_warc(pages, f"{scratch.path}/archive", seconds))
        index = capture_index(read_warc(files), scratch)
        sizes = index.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).orderBy("shard").collect()
        before, rows = 0, []
        for r in sizes:  # one row a shard
            rows.append((r["shard"], before))
            before += r["n"]
        starts = pages.sparkSession.createDataFrame(rows, "shard int, before long")
        index = index.join(F.broadcast(starts), "shard") \
            .withColumn("history", F.col("before") + F.col("place")).drop("shard", "place", "before")
        seen = index.filter("record_type = 'response'").select(
            F.coalesce("page_id", F.lit(NO_ID)).alias("refers_to"), "payload_digest",
            F.col("payload_bytes").alias("_bytes")).distinct()
        again = index.filter("record_type = 'revisit'").join(seen, ["refers_to", "payload_digest"], "left") \
            .withColumn("payload_bytes", F.col("_bytes")).drop("_bytes")
        return index.filter("record_type = 'response'").unionByName(again).checkpoint()


def op3_warc(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return round_trip(pages, F.lit(1704067200) + F.col("page_id")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "history")


ORACLE = r"""
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS digest,
    strlen(coalesce(html, '')) AS size,
    regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1)), '^www\.', '') AS host,
    regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^#]*)', 1) AS rest
  FROM pages),
k AS (
  SELECT *, CASE WHEN regexp_matches(coalesce(url, ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://')
      THEN array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || CASE WHEN rest = '' THEN '/' ELSE rest END
      ELSE coalesce(url, '') END AS url_key,
    CASE WHEN size >= 100 THEN min(page_id) OVER (PARTITION BY digest) END AS first
  FROM p)
SELECT page_id, size AS payload_bytes, digest AS payload_digest,
  CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first < page_id THEN first END AS refers_to, url_key,
  row_number() OVER (ORDER BY url_key, page_id) - 1 AS history
FROM k
"""
