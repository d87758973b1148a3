"""Sharding by minimax contiguous partition (operator 11).

Equal texts form an atomic group.  Groups lie in the order of their texts' md5,
so documents sorted by (md5, doc_id) and running sums of their sizes give every
place where a cut may be.  The smallest capacity that n shards need is found by
binary search, each capacity checked greedily, and the cuts are made for it.

The search runs on the driver over a bounded number of known places: a lookup in
a gap between two of them has a lower and an upper bound, and so has the capacity.
While these differ, the gaps that matter are split by one pass over the running
sums (at most ``POINTS`` buckets come back).  The result is exact at any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch

SHARDS = 40
FIXED_BYTES = 16      # counted for every document besides its text
POINTS = 1 << 16      # buckets that one pass returns to the driver
SPANS = 64            # parts of the order that a pass reads


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with their range, position and running size in it, and whether the next row has another text.

    ``edge`` is null for the last row of a range: only the next range can tell.
    """
    held, rows, total = None, 0, 0
    part = TaskContext.get().partitionId()

    def out(table: pa.RecordBatch, keys: np.ndarray, after) -> pa.RecordBatch:
        nonlocal rows, total
        n = table.num_rows
        upto = total + np.cumsum(table.column("size").to_numpy())
        differs = np.append(keys[1:] != keys[:-1], False if after is None else after != keys[-1])
        last = np.zeros(n, bool)
        last[-1] = after is None
        arrays = [*table.columns, pa.array(np.full(n, part, np.int32)), pa.array(rows + np.arange(n)),
                  pa.array(upto), pa.array(differs, mask=last)]
        rows, total = rows + n, int(upto[-1])
        return pa.RecordBatch.from_arrays(arrays, [*table.schema.names, "part", "pos", "upto", "edge"])

    for batch in batches:
        if batch.num_rows:
            keys = np.array(batch.column("digest").to_pylist(), object)
            if held is not None:
                yield out(*held, keys[0])
            held = batch, keys
    if held is not None:
        yield out(*held, None)


class Places:
    """Known places of cuts, and which gaps between them hold no others."""

    def __init__(self, total: int, split, points: int = POINTS):
        self.total, self._split, self._points = total, split, points
        self.at = np.unique(np.array([0, total], np.int64))
        self.closed = np.zeros(len(self.at), bool)  # closed[i]: nothing between at[i] and at[i + 1]
        self.open_gaps: set[int] = set()

    def low(self, x: int) -> int:
        """A place at or below x; the greatest, unless the gap is open (then it is noted)."""
        i = int(np.searchsorted(self.at, x, "right")) - 1
        if self.at[i] != x and i + 1 < len(self.at) and not self.closed[i]:
            self.open_gaps.add(i)
        return int(self.at[i])

    def high(self, x: int) -> int:
        """The smallest known place at or above x; noted as ``low`` does."""
        i = int(np.searchsorted(self.at, x, "left"))
        if self.at[i] != x and not self.closed[i - 1]:
            self.open_gaps.add(i - 1)
        return int(self.at[i])

    def bound(self, x: int) -> int:
        """No place above it is at or below x."""
        i = int(np.searchsorted(self.at, min(x, self.total), "right")) - 1
        return int(self.at[i]) if i + 1 == len(self.at) or self.closed[i] else min(x, self.total)

    def note(self, x: int, y: int) -> None:
        """Open gaps that hold a part of x to y matter."""
        i, j = np.searchsorted(self.at, (x, min(y, self.total - 1)), "right") - 1
        self.open_gaps.update(int(g) for g in np.flatnonzero(~self.closed[i:j + 1]) + i if g + 1 < len(self.at))

    def split(self) -> bool:
        """Look into the noted gaps; False when there were none."""
        gaps, self.open_gaps = sorted(self.open_gaps), set()
        if not gaps:
            return False
        each = max(2, self._points // len(gaps))
        gaps = [(int(self.at[g]), int(self.at[g + 1])) for g in gaps]
        for first in range(0, len(gaps), self._points // 2):  # never more than so many buckets in one pass
            some = gaps[first:first + self._points // 2]
            self._add(some, self._split([np.unique([a + (b - a) * j // each for j in range(each + 1)])
                                         for a, b in some]))
        return True

    def _add(self, gaps: list[tuple[int, int]], found: np.ndarray) -> None:
        """``found``: number, smallest and greatest of the places in a bucket, for the buckets of these gaps."""
        closed = {int(a): bool(c) for a, c in zip(self.at, self.closed)}
        closed.update((a, True) for a, _ in gaps)           # up to the smallest of the first bucket
        for n, lo, hi in found.tolist():
            closed.setdefault(hi, True)
            if lo != hi:
                closed[lo] = n == 2
        self.at = np.array(sorted(closed), np.int64)
        self.closed = np.array([closed[a] for a in self.at.tolist()], bool)


def _chain(step, capacity: int, n: int) -> list[int]:
    out = [0]
    for _ in range(n):
        out.append(step(out[-1] + capacity))
    return out


def _smallest(step, total: int, n: int) -> int:
    """The smallest capacity for which n greedy steps reach the end."""
    lo, hi = -(-total // n) - 1, total
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if _chain(step, mid, n)[-1] >= total:
            hi = mid
        else:
            lo = mid
    return hi


def minimax_cuts(places: Places, n: int) -> tuple[int, list[int]]:
    """The smallest capacity, and n - 1 cuts that keep to it.

    A capacity leaves room for the cuts: each is as near to its even share as the
    capacity of the shards before and after it allows.
    """
    total = places.total
    if not total:
        return 0, [0] * (n - 1)
    while True:
        above, below = _smallest(places.low, total, n), _smallest(places.bound, total, n)
        places.open_gaps.clear()
        if above == below:
            break
        first, last = _chain(places.low, below, n), _chain(places.bound, above, n)
        places.open_gaps.clear()
        for k, (a, b) in enumerate(zip(first[:-1], last[:-1]), 1):
            places.note(a + below, b + above)
            places.note(k * total // n, k * total // n)  # asked for once the capacity is known
        if not places.split():
            break
    while True:
        earliest = [total]
        for _ in range(n):
            earliest.insert(0, places.high(max(0, earliest[0] - above)))
        cuts = [0]
        for k in range(1, n):
            lo, hi = places.low(k * total // n), places.high(k * total // n)
            even = lo if k * total // n - lo <= hi - k * total // n else hi
            cuts.append(min(max(even, earliest[k]), places.low(cuts[-1] + above)))
        if not places.split():
            return above, cuts[1:]


def _buckets(ends: DataFrame, edges: list[np.ndarray]) -> np.ndarray:
    """Number, smallest and greatest ``upto`` in each bucket that has any; ``edges`` has the buckets of one gap an array."""
    marks = np.concatenate(edges)
    inside = np.ones(len(marks), bool)
    inside[np.cumsum([len(e) for e in edges]) - 1] = False
    spans = [(int(e[0]), int(e[-1])) for e in edges]
    while len(spans) > SPANS:
        spans = [(a, b) for (a, _), (_, b) in zip(spans[::2], spans[1::2] + [spans[-1]] * (len(spans) % 2))]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = np.sort(batch.column(0).to_numpy())
            b = np.searchsorted(marks, v, "left") - 1   # a bucket holds its upper end, not its lower
            ok = (b >= 0) & (b < len(marks) - 1)
            ok[ok] = inside[b[ok]]
            v, b = v[ok], b[ok]
            at = np.flatnonzero(np.append(True, b[1:] != b[:-1])) if len(b) else np.zeros(0, np.int64)
            n = np.diff(np.append(at, len(b)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(b[at].astype(np.int64)), pa.array(n.astype(np.int64)), pa.array(v[at]),
                 pa.array(v[at + n - 1])], ["bucket", "n", "lo", "hi"])

    near = F.lit(False)
    for a, b in spans:
        near = near | ((F.col("upto") > a) & (F.col("upto") <= b))
    found = ends.select("upto").filter(near).mapInArrow(count, "bucket long, n long, lo long, hi long") \
        .groupBy("bucket").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return np.array([(r["n"], r["lo"], r["hi"]) for r in found.collect()], np.int64).reshape(-1, 3)


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (place in its shard, from 0) of every row of ``docs``.

    ``docs`` needs doc_id and text; other columns are not read.  A null text is an
    empty one.  All rows with one text go to one shard, null and repeated doc_ids
    too; repeated rows have slots of their own.  There may be fewer groups than
    shards: then some stay empty.
    """
    text = F.coalesce("text", F.lit(""))
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         (F.octet_length(text) + FIXED_BYTES).cast("long").alias("size"),
                         F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text)).alias("digest"))
    order = ["digest", "doc_id"]
    with Scratch(docs.sparkSession, "sharding") as scratch:
        narrow = scratch.keep(narrow)
        ranged = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
        rows = scratch.keep(ranged.mapInArrow(
            _running, "doc_id long, size long, text_crc32 long, digest binary, part int, pos long, upto long, edge boolean"))
        # One row a range.
        parts = sorted(rows.groupBy("part").agg(
            F.count(F.lit(1)).alias("n"), F.max("upto").alias("bytes"), F.min("digest").alias("first"),
            F.max("digest").alias("last")).collect(), key=lambda r: r["part"])
        starts = np.cumsum([0, *(r["n"] for r in parts)]).tolist()
        offsets = np.cumsum([0, *(r["bytes"] for r in parts)]).tolist()
        ends = [a["last"] != b["first"] for a, b in zip(parts, parts[1:])] + [True]
        table = docs.sparkSession.createDataFrame(
            [(r["part"], s, o, e) for r, s, o, e in zip(parts, starts, offsets, ends)],
            "part int, start long, offset long, ends boolean")
        placed = rows.join(F.broadcast(table), "part").select(
            "doc_id", "size", "text_crc32", (F.col("start") + F.col("pos")).alias("pos"),
            (F.col("offset") + F.col("upto")).alias("upto"), F.coalesce("edge", "ends").alias("edge"))
        # Where a cut may be, and how many rows lie before it: one row a group, in order, so passes skip row groups.
        ends_of = scratch.keep(placed.filter("edge").select("upto", (F.col("pos") + 1).alias("rows")))
        _, cuts = minimax_cuts(Places(offsets[-1], lambda edges: _buckets(ends_of, edges)), shards)
        before = {0: 0, **{r["upto"]: r["rows"] for r in ends_of.filter(F.col("upto").isin(cuts)).collect()}}
        literals = F.array(*[F.lit(c).cast("long") for c in cuts])
        number = F.size(F.filter(literals, lambda c: c < F.col("upto"))) if cuts else F.lit(0)
        firsts = F.array(*[F.lit(before[c]).cast("long") for c in [0, *cuts]])
        return placed.withColumn("shard", number.cast("int")).select(
            "doc_id", "size", "text_crc32", "shard", (F.col("pos") - F.get(firsts, "shard")).alias("slot")).checkpoint()


def op11_sharding(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return shard(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                              F.lit(None).cast("int").alias("grown_shard"))


# The crc32 goes byte by byte through a table made from 0xEDB88320 = 3988292384; 0xFFFFFFFF = 4294967295.
ORACLE = """
WITH RECURSIVE table_ AS (
  SELECT list(list_reduce(list_prepend(b, [k::BIGINT for k in range(8)]),
    lambda a, k: xor(a >> 1, (a & 1) * 3988292384)) ORDER BY b) AS tab
  FROM (SELECT unnest(range(256))::BIGINT AS b)),
d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 16 AS size, md5(coalesce(text, '')) AS digest,
    xor(list_reduce(list_prepend(4294967295::BIGINT,
        [('0x' || x)::BIGINT for x in regexp_extract_all(hex(encode(coalesce(text, ''))), '..')]),
      lambda crc, x: xor(crc >> 8, tab[(xor(crc, x) & 255) + 1])), 4294967295) AS text_crc32
  FROM documents, table_),
p AS (
  SELECT *, row_number() OVER w AS pos, (sum(size) OVER w)::BIGINT AS upto
  FROM d WINDOW w AS (ORDER BY digest, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING)),
b AS (
  SELECT list_prepend(0::BIGINT, list(upto ORDER BY upto)) AS places, max(upto) AS total
  FROM (SELECT max(upto) AS upto FROM p GROUP BY digest)),
s AS (
  SELECT (total + 39) // 40 - 1 AS lo, total AS hi, places, total FROM b
  UNION ALL
  SELECT CASE WHEN reach >= total THEN lo ELSE (lo + hi) // 2 END,
    CASE WHEN reach >= total THEN (lo + hi) // 2 ELSE hi END, places, total
  FROM (
    SELECT *, list_reduce(list_prepend(0::BIGINT, [k::BIGINT for k in range(40)]),
      lambda pos, k: list_max(list_filter(places, lambda x: x <= pos + (lo + hi) // 2))) AS reach
    FROM s WHERE hi - lo > 1)),
c AS (SELECT hi AS capacity, places, total FROM s WHERE hi - lo = 1),
early AS (
  SELECT 40 AS k, total AS cut FROM c
  UNION ALL
  SELECT k - 1, list_min(list_filter(places, lambda x: x >= early.cut - capacity)) FROM early, c WHERE k > 1),
even AS (
  SELECT k, list_max(list_filter(places, lambda x: x <= k * total // 40)) AS lo,
    list_min(list_filter(places, lambda x: x >= k * total // 40)) AS hi, k * total // 40 AS share
  FROM c, (SELECT unnest(range(1, 40)) AS k)),
wish AS (
  SELECT k, greatest(CASE WHEN share - lo <= hi - share THEN lo ELSE hi END, early.cut) AS cut
  FROM even JOIN early USING (k)),
cuts AS (
  SELECT 0::BIGINT AS k, 0::BIGINT AS cut
  UNION ALL
  SELECT cuts.k + 1, least(wish.cut, list_max(list_filter(places, lambda x: x <= cuts.cut + capacity)))
  FROM cuts JOIN wish ON wish.k = cuts.k + 1, c),
n AS (
  SELECT p.*, (SELECT count(*) FROM cuts WHERE k > 0 AND cut < p.upto)::INT AS shard FROM p)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY pos) - 1 AS slot, NULL::INT AS grown_shard
FROM n
"""
