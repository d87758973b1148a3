"""Order MinHash document fingerprints (operator 1).

Every k-mer (k code points) of a text is numbered by its occurrences.  For each
of m hash functions the l numbered k-mers of least hash are selected, put back
in text order, and the tuple of their k-mers is hashed.  Two fingerprints agree
in a place with a probability that falls with the edit distance of their texts:
unlike a set signature, moving a passage changes the order and so the tuples.

Neighbours by doc_id are found without a global sort in one task: documents go
to ranges of (doc_id, hash of the text) of about the same bytes, and the first
document of each range is also sent to the range before it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import Scratch
from .textarrays import SLICE_BYTES, Ranges, in_doc, mix, runs, spread

U = np.uint64
KMER, TUPLE, SKETCHES = 12, 2, 64
_LIKELY = 12
_BLOCK = 1 << 15


def _numbered(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """How many equal k-mers stand before each one in its text."""
    out = np.zeros(len(h), np.int64)
    key = in_doc(doc, h)
    order = np.argsort(key)
    edge = runs(key[order])
    size = np.diff(edge)
    again = np.flatnonzero(size > 1)
    at = order[spread(edge[again], size[again])]
    group = np.repeat(np.arange(len(again)), size[again])
    at = at[np.lexsort((at, group))]
    out[at] = spread(np.zeros(len(again), np.int64), size[again])
    return out


def _kmers(texts: list[str], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many k-mers each text has, and of every k-mer its hash without and with its number."""
    lengths = np.array([len(t) for t in texts], np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
    n = np.maximum(lengths - k + 1, (lengths > 0).astype(np.int64))
    start = spread(np.cumsum(lengths) - lengths, n)
    width = np.repeat(np.minimum(lengths, k), n)
    doc = np.repeat(np.arange(len(texts)), n)
    h = Ranges(points.astype(U) + U(1)).of(start, start + width)
    return n, h, mix(h + _numbered(doc, h).astype(U) * U(0xD6E8FEB86659FD93))


def _factors(sketches: int) -> list[np.uint64]:
    return [U((j * 0x9E3779B97F4A7C15 + 0xC2B2AE3D27D4EB4F) % (1 << 64) | 1) for j in range(sketches)]


def _limits(n: np.ndarray) -> np.ndarray:
    """Hashes below which _LIKELY k-mers of a text are on average: enough, nearly always."""
    limit = np.minimum(_LIKELY / np.maximum(n, 1), 1.0)
    return np.where(limit >= 1, U(2 ** 64 - 1), (limit * 2.0 ** 64 * (1 - 2.0 ** -50)).astype(U))


def _below(base: np.ndarray, limit: np.ndarray, doc: np.ndarray, sketches: int) -> tuple[np.ndarray, ...]:
    """Place, text and function in one number, and hash of the k-mers not above their limit."""
    at, group, value = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, U)]
    for lo in range(0, len(base), _BLOCK):  # blocks that stay in the processor's cache
        x, most, of = base[lo:lo + _BLOCK], limit[lo:lo + _BLOCK], doc[lo:lo + _BLOCK]
        hashed = np.empty_like(x)
        for j, factor in enumerate(_factors(sketches)):
            np.multiply(x, factor, out=hashed)
            below = np.flatnonzero(hashed <= most)
            at.append(below + lo)
            group.append(of[below] * sketches + j)
            value.append(hashed[below])
    return np.concatenate(at), np.concatenate(group), np.concatenate(value)


def _selected(n: np.ndarray, h: np.ndarray, base: np.ndarray, at: np.ndarray, group: np.ndarray, value: np.ndarray,
              tuple_size: int, sketches: int) -> np.ndarray:
    """Fingerprints from the k-mers below the limits."""
    out = np.zeros((len(n), sketches), np.uint32)
    if not len(base):
        return out
    need = np.repeat(np.minimum(n, tuple_size), sketches)
    lacking = np.flatnonzero(np.bincount(group, minlength=len(need)) < need)
    if len(lacking):  # too few below the limit: all k-mers of that text for that function
        keep = ~np.isin(group, lacking)
        d = lacking // sketches
        first = np.cumsum(n) - n
        more = spread(first[d], n[d])
        of = np.repeat(lacking, n[d])
        at, group = np.concatenate((at[keep], more)), np.concatenate((group[keep], of))
        value = np.concatenate((value[keep], base[more] * np.array(_factors(sketches), U)[of % sketches]))
    order = np.lexsort((value, group))
    edge = runs(group[order])
    rank = spread(np.zeros(len(edge) - 1, np.int64), np.diff(edge))
    chosen = order[rank < tuple_size]
    chosen = chosen[np.lexsort((at[chosen], group[chosen]))]  # text order
    edge = runs(group[chosen])
    place = spread(np.zeros(len(edge) - 1, np.int64), np.diff(edge)).astype(U)
    tuples = np.add.reduceat(mix(h[at[chosen]] + place * U(0x9FB21C651E98DF25)), edge[:-1])
    out.ravel()[group[chosen][edge[:-1]]] = (mix(tuples) >> U(32)).astype(np.uint32)
    return out


def fingerprints(texts: list[str], k: int = KMER, tuple_size: int = TUPLE, sketches: int = SKETCHES) -> np.ndarray:
    """One row of ``sketches`` unsigned 32-bit tuple hashes for each text.

    A text shorter than k is its own only k-mer; the empty text has none, and
    all zeros.
    """
    n, h, base = _kmers(texts, k)
    found = _below(base, np.repeat(_limits(n), n), np.repeat(np.arange(len(n)), n), sketches)
    return _selected(n, h, base, *found, tuple_size, sketches)


def with_edited(texts: list[str], which: np.ndarray, edited: list[str], kept: np.ndarray, k: int = KMER,
                tuple_size: int = TUPLE, sketches: int = SKETCHES) -> tuple[np.ndarray, np.ndarray]:
    """``fingerprints`` of the texts and of the edited texts.

    The first ``kept[i]`` code points of ``edited[i]`` are those of
    ``texts[which[i]]``.  K-mers inside them have the same numbers in both, and
    are put through the hash functions once.
    """
    n, h, base = _kmers(texts, k)
    limit = _limits(n)
    at, group, value = _below(base, np.repeat(limit, n), np.repeat(np.arange(len(n)), n), sketches)
    prints = _selected(n, h, base, at, group, value, tuple_size, sketches)

    m, h, base = _kmers(edited, k)
    both = np.maximum(kept - k + 1, 0)
    rest = m - both
    first, begin = np.cumsum(n) - n, np.cumsum(m) - m
    of = np.full(len(n), -1)
    of[which] = np.arange(len(which))
    doc = group // sketches
    place, to = at - first[doc], of[doc]
    shared = (to >= 0) & (place < both[to])
    tail = spread(begin + both, rest)
    more = _below(base[tail], np.repeat(limit[which], rest), np.repeat(np.arange(len(m)), rest), sketches)
    at = np.concatenate(((begin[to] + place)[shared], tail[more[0]]))
    group = np.concatenate(((to * sketches + group % sketches)[shared], more[1]))
    value = np.concatenate((value[shared], more[2]))
    return prints, _selected(m, h, base, at, group, value, tuple_size, sketches)


def as_text(prints: np.ndarray) -> list[str]:
    """Lower-case hex, eight digits a place."""
    width = prints.shape[1] * 8
    raw = prints.astype(">u4").tobytes().hex()
    return [raw[i:i + width] for i in range(0, len(raw), width)]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of places in which fingerprints agree."""
    return (a == b).mean(1)


def _pairs(k: int, tuple_size: int, sketches: int):
    """Rows in order, the last of each range followed by the first of the next one (``stub``)."""
    def work(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        # The last row here is only the next document of the one before it.
        texts = rows.column("text").to_pylist()
        stub = rows.column("stub").to_pylist()
        real = np.flatnonzero(~np.array(stub[:-1], bool))
        if not len(real):
            return
        kept_points = [len(texts[i]) - len(texts[i]) // 4 for i in real]
        edited = [texts[i][:c] + texts[i + 1][:len(texts[i]) - c] for i, c in zip(real, kept_points)]
        prints, changed = with_edited(texts, real, edited, np.array(kept_points), k, tuple_size, sketches)
        kept = rows.take(pa.array(real)).combine_chunks()
        yield pa.RecordBatch.from_arrays(
            [kept.column("row").combine_chunks(),
             pa.array([len(texts[i]) for i in real], pa.int64()),
               pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
               pa.array(as_text(prints[real]), pa.string()), pa.array(as_text(changed), pa.string()),
               pa.array(likeness(prints[real], changed)), pa.array(likeness(prints[real], prints[real + 1]))],
            ["row", *ADDED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch]).set_column(
                batch.schema.get_field_index("text"), "text", batch.column("text").fill_null(""))
            rows = rows if left is None else pa.concat_tables([left, rows])
            sizes = np.cumsum(np.concatenate([np.diff(_offsets(c)) for c in rows.column("text").chunks]))
            at = 0
            while at + 1 < rows.num_rows:
                done = sizes[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(sizes, done + SLICE_BYTES // 2, "right")))
                to = min(to, rows.num_rows - 1)
                yield from work(rows.slice(at, to - at + 1))
                at = to
            left = rows.slice(rows.num_rows - 1)
    return run


def _offsets(column: pa.Array) -> np.ndarray:
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    return np.frombuffer(column.buffers()[1], width)[column.offset:column.offset + len(column) + 1].astype(np.int64)


ADDED = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def with_neighbours(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Rows ordered by doc_id inside each task, each followed by the next document.

    ``docs`` has doc_id and text; ``stub`` is added, true for rows that only
    stand behind a range's last row.  A null doc_id comes first; rows with one
    doc_id are in order of a hash of their text.  After the last document comes
    the first.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("row"), "text",
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(-1 << 63)).alias("id"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"))
    with Scratch(spark, "neighbours") as scratch:
        narrow = scratch.keep(rows.select("id", "hash", (F.coalesce(F.octet_length("text"), F.lit(0)) + 64)
                                          .cast("long").alias("bytes")))
        ids, hashes = _cuts(narrow, parts)

        @F.pandas_udf("int")
        def part_of(id_: pd.Series, hash_: pd.Series) -> pd.Series:
            i, h = id_.to_numpy(), hash_.to_numpy()
            part, upto = (np.searchsorted(ids, i, side) for side in ("left", "right"))
            for one in np.unique(i[upto > part]):     # ids that are cut themselves, as the null id may be
                a, b = (np.searchsorted(ids, one, side) for side in ("left", "right"))
                part[i == one] = a + np.searchsorted(hashes[a:b], h[i == one], "right")
            return pd.Series(part.astype(np.int32))

        heads = narrow.groupBy(part_of("id", "hash").alias("part")).agg(F.min(F.struct("id", "hash")).alias("f")) \
            .orderBy("part").collect()   # one row a range
    stubs = [(h["f"]["id"], h["f"]["hash"], heads[i - 1]["part"]) for i, h in enumerate(heads)]
    heads = spark.createDataFrame(stubs, "id long, hash long, part int")
    tagged = rows.withColumn("part", part_of("id", "hash"))
    own_task = F.element_at(F.array(*[F.lit(k) for k in _keys_of_tasks(spark, parts)]), F.col("part") + 1)
    behind = rows.join(F.broadcast(heads), ["id", "hash"]).dropDuplicates(["id", "hash"])
    both = tagged.withColumn("stub", F.lit(False)).unionByName(behind.withColumn("stub", F.lit(True)))
    return both.repartition(parts, own_task).sortWithinPartitions("part", "stub", "id", "hash") \
        .select("row", "text", "stub")


def _keys_of_tasks(spark, parts: int) -> list[int]:
    """For each range a number that Spark's hash partitioning gives a task of its own."""
    tried = 32 * parts + 256
    found = spark.range(tried).select(F.col("id").cast("int").alias("k"),
                                      F.pmod(F.hash(F.col("id").cast("int")), F.lit(parts)).alias("task")) \
        .groupBy("task").agg(F.min("k").alias("k")).collect()   # one row a task
    keys = [r["k"] for r in found]
    return keys + list(range(tried, tried + parts - len(keys)))   # a task without a number is a rare loss


SAMPLED = 20   # rows that the cuts of one range are chosen from


def _cuts(narrow: DataFrame, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and hashes of the first rows of all ranges but the first; ranges have about the same bytes.

    Chosen on the driver from rows drawn by a hash in proportion to their
    bytes, ``2 * SAMPLED * parts`` or a few more.
    """
    total = narrow.agg(F.sum("bytes").alias("b")).first()["b"] or 0
    step = max(1, total // (SAMPLED * parts))
    draw = F.pmod(F.xxhash64("id", "hash", F.lit(7)), F.lit(step))
    drawn = sorted((r["id"], r["hash"], max(r["bytes"], step)) for r in
                   narrow.filter(draw < F.col("bytes")).collect())
    if not drawn:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    upto = np.cumsum([d[2] for d in drawn])
    at = np.unique(np.searchsorted(upto, upto[-1] * np.arange(1, parts) // parts, "right"))
    cuts = sorted({drawn[i][:2] for i in at.tolist() if i < len(drawn)})
    return np.array([c[0] for c in cuts], np.int64), np.array([c[1] for c in cuts], np.int64)


def fingerprint_documents(docs: DataFrame, k: int = KMER, tuple_size: int = TUPLE, sketches: int = SKETCHES,
                          parts: int | None = None) -> DataFrame:
    """Each row of ``docs`` without its text, with the fingerprints of the text and of its edited text.

    The edited text has its last quarter (rounded down) replaced by as many
    first code points of the next document, or all it has.  Null texts are
    empty.  Repeated rows are documents of their own, one after the other.
    Columns of the added names are replaced.
    """
    src = with_neighbours(docs.drop(*ADDED), parts)
    schema = T.StructType([src.schema["row"]]).add("n_chars", "long")
    for c, kind in zip(ADDED[1:], ("string", "string", "string", "double", "double")):
        schema = schema.add(c, kind)
    return src.mapInArrow(_pairs(k, tuple_size, sketches), schema).select("row.*", *ADDED)


def op1_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprint_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
