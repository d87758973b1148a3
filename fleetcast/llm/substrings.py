"""Substring dedup by relative Lempel-Ziv factors (operator 6).

A word is removed when a window of ``length`` words over it also starts in a
document with a smaller id.

Every document is parsed against the index of all reference blocks.  A block is
the text around an *anchor*: a q-word phrase whose hash is smallest among the
phrases of some window, so that equal windows have the same anchors wherever
they stand.  Anchors of one document only are dropped before anything else.  For
each distinct context of an anchor (the words up to a window's reach on both
sides) the index has the first document and place that holds it.

1. Greedy factors: a context that also stands in an earlier document is copied
   from there, and the copy is extended as long as the contexts that follow
   continue it in the same document at the same distance.  A factor is where it
   starts, its length, the reference document and the place there.
2. Factor boundaries: where a context is the first of its kind but its anchor
   also has other contexts, a copy may end inside it.  Each window over the anchor
   is looked up by itself, against the windows of the first documents with the
   other contexts; these are factors of ``length`` words.

Both steps compare 128 bits: an anchor's hash and its context's, from different
word hashes, or two hashes of a window.  No step forms pairs of documents: a phrase
in thousands of documents costs one row for each, and minimum ids are
aggregated before the rows meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .shared import Scratch, is_hot, join_hot
from .textarrays import Ranges, Texts, signed, slices, sliding, spread

Q = 16  # words of an anchor


def _bounds(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """First word of the text, and the word after its last, for each word."""
    return np.repeat(t.first_word[:-1], t.n_words), np.repeat(t.first_word[1:], t.n_words)


def anchors(t: Texts, words: np.ndarray, length: int, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Word positions and hashes of the anchors of every window inside one text."""
    reach = length - q + 1
    n = len(words)
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(n - q + 1)
    h = Ranges(words).of(at, at + q)
    _, last = _bounds(t)
    low = sliding(np.minimum, h, reach)              # for each window start
    inside = np.arange(len(low)) + length <= last[:len(low)]
    low = np.where(inside, low, np.uint64(0))
    # A phrase is an anchor if some window over it has no smaller one: all ties count.
    padded = np.concatenate((np.zeros(reach - 1, np.uint64), low, np.zeros(reach - 1, np.uint64)))
    best = sliding(np.maximum, padded, reach)[:len(h)]
    pick = np.flatnonzero((best == h) & (best > 0))
    return pick, h[pick]


ANCHOR_SCHEMA = "doc_id long, row long, pos int, before short, after short, anchor long, context long"
FACTOR = ["doc_id", "row", "from", "upto", "ref_doc", "ref_from"]


def _anchor_rows(length: int, q: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                t = Texts(part.column("text"))
                w1, w2 = t.word_hash(0), t.word_hash(1)
                pick, h = anchors(t, w1, length, q)
                first, last = _bounds(t)
                lo, hi = np.maximum(first[pick], pick - (length - q)), np.minimum(last[pick], pick + length)
                shape = ((pick - lo) * 1000 + (hi - pick)).astype(np.uint64)
                context = Ranges(w2, 1).of(lo, hi) ^ shape
                doc = t.word_doc()[pick]
                base = first[pick]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(pa.array(doc)), part.column("row").take(pa.array(doc)),
                    pa.array((pick - base).astype(np.int32)),
                    pa.array((pick - lo).astype(np.int16)), pa.array((hi - pick).astype(np.int16)),
                    pa.array(signed(h)), pa.array(signed(context))],
                    ["doc_id", "row", "pos", "before", "after", "anchor", "context"])
    return run


def _window_rows(length: int, q: int):
    """Hashes of the windows over the anchors listed in ``marks``, each once a text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                t = Texts(part.column("text"))
                marks = part.column("marks")
                sizes = np.diff(np.asarray(marks.offsets)) if marks.offset == 0 else \
                    np.asarray(marks.value_lengths())
                pos = np.asarray(marks.flatten()).astype(np.int64)
                doc = np.repeat(np.arange(t.n), sizes)
                lo = np.maximum(0, pos - (length - q))
                hi = np.minimum(pos, t.n_words[doc] - length)
                starts = spread(lo, hi - lo + 1)
                owner = np.repeat(doc, hi - lo + 1)
                glob = np.unique(starts + t.first_word[owner])
                owner = np.searchsorted(t.first_word, glob, "right") - 1
                k1 = Ranges(t.word_hash(0)).of(glob, glob + length)
                k2 = Ranges(t.word_hash(1), 1).of(glob, glob + length)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(pa.array(owner)), part.column("row").take(pa.array(owner)),
                    pa.array((glob - t.first_word[owner]).astype(np.int32)),
                    pa.array(signed(k1)), pa.array(signed(k2))],
                    ["doc_id", "row", "pos", "win1", "win2"])
    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removes the words under the spans; adds n_words, n_removed, kept_words."""
    for batch in batches:
        for part in slices(batch):
            t = Texts(part.column("text"))
            spans = part.column("spans").fill_null([]) if part.column("spans").null_count else part.column("spans")
            sizes = np.asarray(spans.value_lengths())
            flat = spans.flatten()
            doc = np.repeat(np.arange(t.n), sizes)
            lo = np.asarray(flat.field("from")).astype(np.int64) + t.first_word[doc]
            hi = np.asarray(flat.field("upto")).astype(np.int64) + t.first_word[doc]
            cover = np.zeros(len(t.word_start) + 1, np.int64)
            np.add.at(cover, lo, 1)
            np.add.at(cover, hi, -1)
            gone = np.cumsum(cover[:-1]) > 0
            removed = np.bincount(t.word_doc()[gone], minlength=t.n)
            # Kept words, one space after each, as one byte array.
            kept = np.flatnonzero(~gone)
            size = t.word_end[kept] - t.word_start[kept] + 1
            out = t.bytes[np.minimum(spread(t.word_start[kept], size), len(t.bytes) - 1)]
            if len(size):
                out[np.cumsum(size) - 1] = 0x20
            ends = np.concatenate(([0], np.cumsum(size)))[np.searchsorted(kept, t.first_word)]
            raw = out.tobytes()
            joined = [raw[a:b - 1].decode() if b > a else "" for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array(t.n_words.astype(np.int64)), pa.array(removed.astype(np.int64)),
                 pa.array(joined, pa.string())],
                ["row", "n_words", "n_removed", "kept_words"])


def _extended(copies: DataFrame) -> DataFrame:
    """Copied contexts of one document that continue each other in one reference document, as one factor."""
    along = Window.partitionBy("doc_id", "row", "ref_doc", "distance").orderBy("from", "upto")
    reached = F.max("upto").over(along.rowsBetween(Window.unboundedPreceding, -1))
    numbered = copies.withColumn("new", (reached.isNull() | (reached < F.col("from"))).cast("int")) \
        .withColumn("factor", F.sum("new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("doc_id", "row", "ref_doc", "distance", "factor").agg(
        F.min("from").alias("from"), F.max("upto").alias("upto")) \
        .select("doc_id", "row", "from", "upto", "ref_doc", (F.col("from") - F.col("distance")).alias("ref_from"))


def factors(docs: DataFrame, scratch: Scratch, length: int = 50, q: int = Q) -> DataFrame:
    """Factors of ``length`` words or more that earlier documents hold: words from ``from`` to before ``upto`` of a row
    equal those from ``ref_from`` on of the document ``ref_doc``.

    ``docs`` has doc_id long, row long and text string.  ``row`` tells apart
    rows with the same doc_id; such rows do not count as earlier documents, and
    factors of rows equal in both are the same.  Every window that an earlier
    document holds lies in a factor, or in factors that overlap by all its words.
    """
    found = scratch.keep(docs.mapInArrow(_anchor_rows(length, q), ANCHOR_SCHEMA))
    n = found.count()
    common = scratch.keep(found.groupBy("anchor").agg(
        F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("n"))
        .filter("lo < hi").select("anchor", is_hot("n", n).alias("hot")))
    met = scratch.keep(join_hot(found, common, ["anchor"]))
    scratch.free(found, common)
    n = met.count()
    contexts = scratch.keep(met.groupBy("anchor", "context").agg(
        F.min(F.struct("doc_id", "pos")).alias("first"), F.count(F.lit(1)).alias("n")))
    several = scratch.keep(contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).select(
        "anchor", (F.col("c") > 1).alias("open"), is_hot("c", contexts.count()).alias("hot")))
    known = scratch.keep(join_hot(contexts, several, ["anchor"]).select(
        "anchor", "context", "first", "open", is_hot("n", n).alias("hot")))
    placed = scratch.keep(join_hot(met, known, ["anchor", "context"]).select(
        "doc_id", "row", "pos", (F.col("pos") - F.col("before")).alias("from"), (F.col("pos") + F.col("after")).alias("upto"),
        F.col("first.doc_id").alias("ref_doc"), (F.col("pos") - F.col("first.pos")).alias("distance"), "open"))
    scratch.free(met, contexts, several, known)
    copied = _extended(placed.filter((F.col("ref_doc") < F.col("doc_id")) & (F.col("upto") - F.col("from") >= length)))
    marks = placed.filter((F.col("ref_doc") == F.col("doc_id")) & F.col("open")) \
        .groupBy("doc_id", "row").agg(F.collect_list("pos").alias("marks"))
    windows = scratch.keep(docs.join(marks, ["doc_id", "row"]).select("doc_id", "row", "text", "marks")
                           .mapInArrow(_window_rows(length, q),
                                       "doc_id long, row long, pos int, win1 long, win2 long"))
    n = windows.count()
    earliest = scratch.keep(windows.groupBy("win1", "win2").agg(
        F.min(F.struct("doc_id", "pos")).alias("first"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("last") > F.col("first.doc_id")).select("win1", "win2", "first", is_hot("n", n).alias("hot")))
    edges = join_hot(windows, earliest, ["win1", "win2"]).filter(F.col("first.doc_id") < F.col("doc_id")).select(
        "doc_id", "row", F.col("pos").alias("from"), (F.col("pos") + length).alias("upto"),
        F.col("first.doc_id").alias("ref_doc"), F.col("first.pos").alias("ref_from"))
    return copied.unionByName(edges).select(*FACTOR)


def duplicate_spans(docs: DataFrame, length: int = 50, q: int = Q) -> DataFrame:
    """Spans of words to remove: (doc_id, row, spans array<struct<from,upto>>), half open, from ``factors``."""
    with Scratch(docs.sparkSession, "factors") as scratch:
        return factors(docs, scratch, length, q).groupBy("doc_id", "row") \
            .agg(F.collect_set(F.struct("from", "upto")).alias("spans")).checkpoint()


def remove_duplicates(docs: DataFrame, length: int = 50, q: int = Q) -> DataFrame:
    """The rows of ``docs`` with n_words, n_removed and kept_words (joined by one space).

    Any further columns stay, apart from clashing ones of those three names,
    which are replaced.  Null or empty texts have no words.  Rows with a null
    doc_id are later than all others and never count as earlier ones.  Repeated
    rows (same doc_id) are judged alike and keep each other's words.
    """
    extra = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept_words")]
    # A null id compares as the largest; ``hash`` stays the same when it is computed again.
    keyed = docs.select(F.struct(*extra).alias("row"), "text",
                        F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("id"),
                        F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"))
    spans = duplicate_spans(keyed.select(F.col("id").alias("doc_id"), F.col("hash").alias("row"), "text"), length, q)
    joined = keyed.join(spans.withColumnsRenamed({"doc_id": "id", "row": "hash"}), ["id", "hash"], "left") \
        .select("row", "text", "spans")
    schema = T.StructType([joined.schema["row"]]).add("n_words", "long").add("n_removed", "long") \
        .add("kept_words", "string")
    return joined.mapInArrow(_cut, schema).select("row.*", "n_words", "n_removed", "kept_words")


def op6_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_duplicates(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_words", 256).alias("kept_sha256"))


ORACLE = r"""
WITH w AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos, len(words) AS n
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents)),
g AS (
  SELECT doc_id, pos, word, n,
    md5(string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)) AS win
  FROM w),
m AS (SELECT win, min(doc_id) AS first FROM g WHERE pos + 49 <= n GROUP BY win),
hit AS (SELECT g.doc_id, g.pos FROM g JOIN m USING (win) WHERE g.pos + 49 <= g.n AND m.first < g.doc_id),
marked AS (
  SELECT w.doc_id, w.pos, w.word,
    max(hit.pos) OVER (PARTITION BY w.doc_id ORDER BY w.pos ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM w LEFT JOIN hit ON w.doc_id = hit.doc_id AND w.pos = hit.pos),
k AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
    sha256(coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
  coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM documents d LEFT JOIN k USING (doc_id)
"""


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words under repeated windows, kept words joined by one space.

    Texts with nothing to remove stay as they are; rows left without a word go.
    """
    rows = docs.select("doc_id", "text", F.struct("*").alias("all"))
    out = remove_duplicates(rows).filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    text = F.when(F.col("n_removed") > 0, F.col("kept_words")).otherwise(F.col("text"))
    new = {"text": text, "n_chars": F.char_length(text).cast("long")}
    return out.select(*[new[c].alias(c) if c in new else F.col(f"all.`{c}`").alias(c) for c in docs.columns])
