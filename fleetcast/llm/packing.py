"""Sum-of-squares packing of token pieces into sequences (operator 5).

A piece goes to the residual gap (of an open sequence, or of a new one) that
leaves the sum of squared counts of open sequences per gap smallest; equal
choices take the tightest gap.  Pieces are dealt to shards of bounded size, one
task each, largest pieces first.  Sequences that a shard leaves open are opened
again: their pieces, a small part of all, are dealt to fewer shards and packed
anew, round by round until one shard is left, so the loss does not grow with
the number of shards.  A round that saves no sequence is followed by one with
twice as large shards, up to ``GROWN`` times; then it is the last.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import encode_slices, encoder
from .shared import Scratch
from .textarrays import spread

LENGTH = 2048
SHARD_PIECES = 40_000
ROUNDS_AT_END = 2
GROWN = 4

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """The pieces of each document: its ids and an ``end_id``, cut every ``length`` ids.

    Null and empty texts give the end id alone.  Each row stands for itself.
    """
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = PIECES + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            for part, ids, count in encode_slices(batch, enc):
                ends = np.cumsum(count)
                ids = np.insert(ids, ends, end_id).astype("<u4")
                count = count + 1
                n = -(-count // length)
                doc = np.repeat(np.arange(len(count)), n)
                piece = spread(np.zeros(len(count), np.int64), n)
                first = np.repeat(np.cumsum(count) - count, n) + piece * length
                size = np.minimum(length, count[doc] - piece * length)
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * a:4 * (a + m)]) for a, m in zip(first.tolist(), size.tolist())]
                out = [part.column("doc_id").take(pa.array(doc)), pa.array(piece.astype(np.int32)),
                       pa.array(piece * length), pa.array(size), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(
                        pa.array(np.append(first, len(ids)), pa.int32()), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)

    return src.mapInArrow(run, schema)


def sum_of_squares(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of each piece (placed in the given order), and the gap of each sequence."""
    count = np.zeros(length + 1, np.int64)          # open sequences by gap; full ones do not count
    by_gap: list[list[int]] = [[] for _ in range(length + 1)]
    gap: list[int] = []
    where, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    for i, s in enumerate(sizes.tolist()):
        fits = np.flatnonzero(count[s:length]) + s
        best, change = length, (2 * int(count[length - s]) + 1 if s < length else 0)
        if len(fits):
            change_of = 2 * (count[fits - s] - count[fits]) + 2
            if fits[0] == s:
                change_of[0] = 1 - 2 * count[s]
            j = int(np.argmin(change_of))
            if change_of[j] <= change:
                best = int(fits[j])
        if best == length:
            b = len(gap)
            gap.append(length)
        else:
            b = by_gap[best].pop()
            count[best] -= 1
        where[i], offset[i] = b, length - gap[b]
        gap[b] -= s
        if gap[b]:
            count[gap[b]] += 1
            by_gap[gap[b]].append(b)
    return where, offset, np.array(gap, np.int64)


def _pack_shard(level: int, length: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "own"], ascending=[False, True], ignore_index=True)
        where, offset, gap = sum_of_squares(pdf["length"].to_numpy(), length)
        base = (level << 56) + (int(pdf["shard"].iloc[0]) << 32) if len(pdf) else 0
        return pdf.assign(sequence_id=base + where, offset=offset, gap=gap[where]).drop(columns="shard")
    return run


def pack(items: DataFrame, length: int = LENGTH, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``items`` (rows with ``length`` of 1 to the given length) with sequence_id and offset.

    Columns of the names it works with (sequence_id, offset, gap, shard, own) are replaced or dropped.
    """
    items = items.drop("sequence_id", "offset", "gap", "shard").withColumn("own", F.monotonically_increasing_id())
    cols = items.columns
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
    with Scratch(items.sparkSession, "packing") as scratch:
        left = scratch.keep(items)  # from here on ``own`` is fixed
        done = left.filter(F.col("length") >= length).withColumns(
            {"sequence_id": F.col("own") + (1 << 62), "offset": F.lit(0).cast("long")})
        left = left.filter(F.col("length") < length)
        level = last = 0
        used, grown = None, 1   # open sequences that the round before left
        while True:
            n = left.count()
            if not n:
                break
            shards = -(-n // (shard_pieces * grown))
            last += shards == 1
            dealt = left.withColumn("shard", F.pmod(F.xxhash64("own", F.lit(level)), F.lit(shards)))
            packed = scratch.keep(dealt.groupBy("shard").applyInPandas(
                _pack_shard(level, length), f"{shape}, sequence_id long, offset long, gap long"))
            made = packed.agg(F.count_distinct("sequence_id").alias("all"), F.count_distinct(
                F.when(F.col("gap") == 0, F.col("sequence_id"))).alias("full")).first()
            idle = used is not None and made["all"] >= used
            used = made["all"] - made["full"]
            grown *= 2 if idle else 1
            if last > ROUNDS_AT_END or grown > GROWN:
                done = done.unionByName(packed.drop("gap"))
                break
            done = done.unionByName(packed.filter("gap = 0").drop("gap"))
            left = packed.filter("gap > 0").select(*cols)
            level += 1
        return done.drop("own").checkpoint()


def pack_documents(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of every row of ``docs``."""
    return pack(pieces(docs, path, length, end_id), length)


def _vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), _vocabulary())


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces and places of all documents that are left."""
    return pack_documents(docs, _vocabulary())
