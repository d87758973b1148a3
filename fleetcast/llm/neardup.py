"""Near-duplicate classes with DartMinHash signatures (operator 2).

A text is the weighted set of its 5-word shingles (weight: how often it has
each).  Darts fall on the plane weight x rank of every shingle, at places given
by hashes alone; a text keeps those below its weights, and for each of K
coordinates the dart of least rank.  Two texts agree in a coordinate with a
probability equal to their weighted Jaccard similarity.  All ranks below a
limit are thrown at once, about K ln K darts a text whatever its length, and
the limit is doubled for texts with a coordinate that no dart has hit.

Bands of signature coordinates give candidates.  First every text of a band
meets the band's first text.  Then the pairs of a band that are still in
different classes are looked at, each in the first band it shares, apart from
pairs that cannot be similar: shingles that no other open text has bound what
two texts can have in common.  Candidates with like signatures are compared
exactly by text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import classes
from .shared import Scratch
from .textarrays import Ranges, Texts, in_doc, mix, runs, signed, slices, spread

U = np.uint64
K, ROWS = 128, 5
SHINGLE = 5
#: Of K coordinates, so many must agree for an exact comparison.  At similarity
#: 0.8 fewer agree with a probability of 2e-5 (binomial with n = 128), and no
#: band is shared with one of 5e-5; both fall quickly above.
LEAST_AGREED = 84
#: The same for the longer signatures of texts that are compared with many others.
K_LONG, LEAST_AGREED_LONG = 512, 371
_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(18)])


def _uniform(h: np.ndarray) -> np.ndarray:
    return (h >> U(11)).astype(np.float64) * 2.0 ** -53


def weighted_shingles(t: Texts, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle hash, count) of the distinct shingles of each text.

    A text with fewer words than a shingle has one, of all its words; a text
    without words has a constant one.
    """
    words = t.word_hash()
    at, h = t.shingles(words, size)
    doc = t.word_doc()[at]
    short = np.flatnonzero(t.n_words < size)
    if len(short):
        lo = t.first_word[short]
        h = np.concatenate((h, Ranges(words).of(lo, lo + t.n_words[short])))
        doc = np.concatenate((doc, short))
    order = np.argsort(in_doc(doc, h))
    doc, h = doc[order], h[order]
    edge = runs(in_doc(doc, h))
    return doc[edge[:-1]], h[edge[:-1]], np.diff(edge).astype(np.float64)


def dart_signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, k: int = K) -> np.ndarray:
    """n x k identities of the first dart in each coordinate; real weights above 0 are fine.

    ``doc`` (0 to n-1) owns each element; every doc has at least one.
    """
    sig = np.zeros((n, k), U)
    total = np.bincount(doc, weight, n)
    limit = (k * math.log(k) + 2 * k) / np.maximum(total, 1e-300)
    todo = total > 0
    while todo.any():
        pick = todo[doc]
        d, e, w = doc[pick], element[pick], weight[pick]
        best = np.full(n * k, np.inf)
        found = []
        low, width, level = 0.0, 1.0, 0
        while len(d):  # weights [0,1), [1,2), [2,4), ... in cells of area 1
            cells = np.ceil(limit[d] * width).astype(np.int64)
            j = spread(np.zeros(len(d), np.int64), cells)
            seed = mix(np.repeat(mix(mix(e) + U(level)), cells)
                       + j.astype(U) * U(0xD6E8FEB86659FD93))
            owner = np.repeat(np.arange(len(d)), cells)
            count = np.searchsorted(_POISSON, _uniform(seed))
            dart = mix(np.repeat(seed, count) + (spread(np.zeros(len(seed), np.int64), count) + 1).astype(U)
                       * U(0xC2B2AE3D27D4EB4F))
            owner, j = np.repeat(owner, count), np.repeat(j, count)
            other = mix(dart + U(0x165667B19E3779F9))
            rank = (j + _uniform(other)) / width
            hit = (low + width * _uniform(dart) < w[owner]) & (rank <= limit[d[owner]])
            dart, owner, rank = dart[hit], owner[hit], rank[hit]
            slot = d[owner] * k + (mix(dart + U(0x27D4EB2F165667C5)) % U(k)).astype(np.int64)
            np.minimum.at(best, slot, rank)
            found.append((slot, rank, dart))
            low, width, level = low + width, (width * 2 if level else 1.0), level + 1
            more = w > low
            d, e, w = d[more], e[more], w[more]
        flat = np.zeros(n * k, U)
        for slot, rank, dart in found:
            first = rank == best[slot]
            flat[slot[first]] = dart[first]
        done = todo & np.isfinite(best).reshape(n, k).all(1)
        sig[done] = flat.reshape(n, k)[done]
        todo &= ~done
        limit = limit * 2
    return sig


def _signed_texts(k: int, rows: int):
    bands = k // rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                t = Texts(part.column("text"))
                sig = dart_signatures(*weighted_shingles(t), t.n, k)
                band = Ranges(sig[:, :bands * rows].ravel()).of(
                    np.arange(t.n * bands) * rows, np.arange(1, t.n * bands + 1) * rows)
                band = mix(band + np.tile(np.arange(bands), t.n).astype(U))
                whole = [Ranges(t.bytes.astype(U) + U(1), i).of(t.start, t.end) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(signed(whole[0])), pa.array(signed(whole[1])),
                    pa.ListArray.from_arrays(pa.array(np.arange(t.n + 1) * bands, pa.int32()),
                                             pa.array(signed(band))),
                    _bytes(sig)],
                    ["doc_id", "h1", "h2", "bands", "sig"])
    return run


def similarity(a: pa.Array, b: pa.Array, size: int = SHINGLE) -> np.ndarray:
    """Weighted Jaccard similarity of the shingles of a[i] and b[i]."""
    sides = []
    for x in (a, b):
        doc, h, w = weighted_shingles(Texts(x), size)
        key = in_doc(doc, h)
        order = np.argsort(key)
        sides.append((doc[order], key[order], w[order]))
    (da, ka, wa), (db, kb, wb) = sides
    _, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    both = np.bincount(da[ia], np.minimum(wa[ia], wb[ib]), len(a))
    return both / (np.bincount(da, wa, len(a)) + np.bincount(db, wb, len(a)) - both)


def _elements(size: int):
    """Each text's shingles, equal ones numbered."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                doc, h, w = weighted_shingles(Texts(part.column("text")), size)
                n = w.astype(np.int64)
                h, doc = np.repeat(h, n), np.repeat(doc, n)
                key = mix(h + spread(np.zeros(len(n), np.int64), n).astype(U) * U(0xD6E8FEB86659FD93))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(doc)), pa.array(signed(key))], ["doc_id", "element"])
    return run


def _long_signatures(k: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                t = Texts(part.column("text"))
                sig = dart_signatures(*weighted_shingles(t, size), t.n, k)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), _bytes(sig)], ["doc_id", "sig"])
    return run


def _bytes(sig: np.ndarray) -> pa.Array:
    """One byte a coordinate, eight in a long."""
    n, k = sig.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * (k // 8), pa.int32()),
                                    pa.array((sig & U(0xFF)).astype(np.uint8).ravel().view(np.int64)))


def agreement(a: str, b: str):
    """How many of the bytes in two arrays of longs are equal."""
    def different_bytes(x, y):
        z = x.bitwiseXOR(y)
        for shift in (4, 2, 1):  # a byte's lowest bit gathers its other bits, and no other byte's
            z = z.bitwiseOR(F.shiftrightunsigned(z, shift))
        return F.bit_count(z.bitwiseAND(F.lit(0x0101010101010101)))

    return 8 * F.size(a) - F.aggregate(F.zip_with(a, b, different_bytes), F.lit(0), lambda n, x: n + x)


def _links(threshold: float, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_a"):
                for piece in slices(part, "text_b"):
                    ok = similarity(piece.column("text_a"), piece.column("text_b"), size) >= threshold
                    yield piece.select(["a", "b"]).filter(pa.array(ok))
    return run


def _compare(pairs: DataFrame, texts: DataFrame, threshold: float, size: int, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) of document ids whose texts are similar enough."""
    met = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b") \
        .join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    return scratch.keep(met.select("a", "b", "text_a", "text_b")
                        .mapInArrow(_links(threshold, size), "a long, b long"))


def _first_pairs(met: DataFrame, firsts: DataFrame, least: int) -> DataFrame:
    """Each text of a band with the band's first text, if their signatures are alike."""
    side = firsts.select("doc_id", "sig")
    return met.filter("a <> b").select("a", "b").distinct() \
        .join(side.select(F.col("doc_id").alias("b"), F.col("sig").alias("sig_b")), "b") \
        .join(side.select(F.col("doc_id").alias("a"), F.col("sig").alias("sig_a")), "a") \
        .filter(agreement("sig_a", "sig_b") >= least).select("a", "b")


def _open_pairs(met: DataFrame, label: DataFrame, firsts: DataFrame, texts: DataFrame, threshold: float, size: int,
                scratch: Scratch) -> DataFrame | None:
    """Pairs behind the first text of a band that are in different classes and may be similar (None: no such band)."""
    named = met.filter("a <> b").join(label.withColumnRenamed("node", "b"), "b", "left") \
        .select("key", "b", F.coalesce("label", "b").alias("label"))
    largest = named.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c")).groupBy("key") \
        .agg(F.sum("c").alias("n"), F.max(F.struct("c", "label")).alias("top")).filter("n > top.c")
    rows = scratch.keep(named.join(largest.select("key", F.col("top.label").alias("top")), "key"))
    if not rows.limit(1).count():
        return None
    ids = rows.select(F.col("b").alias("doc_id")).distinct()
    open_texts = scratch.keep(texts.join(ids.hint("merge"), "doc_id", "left_semi").select("doc_id", "text"))
    elements = scratch.keep(open_texts.mapInArrow(_elements(size), "doc_id long, element long"))
    alone = elements.groupBy("element").agg(F.count(F.lit(1)).alias("c"), F.min("doc_id").alias("doc_id")) \
        .filter("c = 1").groupBy("doc_id").agg(F.count(F.lit(1)).alias("alone"))
    # A text with n shingles has at most n - alone in common with another.
    stats = elements.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).join(alone, "doc_id", "left") \
        .withColumn("most", F.col("n") - F.coalesce("alone", F.lit(0))).filter(F.col("most") >= threshold * F.col("n"))
    longer = open_texts.mapInArrow(_long_signatures(K_LONG, size), "doc_id long, sig array<long>")
    side = scratch.keep(firsts.select("doc_id", "bands").join(stats.select("doc_id", "n", "most"), "doc_id")
                        .join(longer, "doc_id").withColumnRenamed("doc_id", "b"))
    rows = rows.join(side, "b")
    one = rows.filter("label <> top").select("key", *(F.col(c).alias(f"{c}_p") for c in rows.columns if c != "key"))
    common = F.least("most", "most_p")
    place = F.array_position("bands", F.col("key")).cast("int")
    earlier = F.arrays_overlap(F.slice("bands", F.lit(1), place - 1), F.slice("bands_p", F.lit(1), place - 1))
    met_pairs = one.join(rows, "key").filter(
        (F.col("label") != F.col("label_p")) & ((F.col("label") == F.col("top")) | (F.col("b_p") < F.col("b")))
        & (common >= threshold * (F.col("n") + F.col("n_p") - common))
        & ~earlier & (agreement("sig", "sig_p") >= LEAST_AGREED_LONG))
    return met_pairs.select(F.least("b", "b_p").alias("a"), F.greatest("b", "b_p").alias("b"))


def near_duplicates(docs: DataFrame, threshold: float = 0.8, size: int = SHINGLE, k: int = K,
                    rows: int = ROWS, least: int = LEAST_AGREED) -> DataFrame:
    """(doc_id, class_id) once for each distinct doc_id that shares a class; class_id is its smallest doc_id.

    Two texts are linked if they are equal, or if the weighted Jaccard
    similarity of their shingles is at least ``threshold``; a class is what
    links connect.  Null texts are empty; texts without a word are alike.  A
    doc_id stands for one document: rows that repeat it join one class.  Rows
    with a null doc_id take no part.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).filter("doc_id is not null")
    with Scratch(docs.sparkSession, "neardup") as scratch:
        sigs = scratch.keep(docs.mapInArrow(
            _signed_texts(k, rows), "doc_id long, h1 long, h2 long, bands array<long>, sig array<long>"))
        same = sigs.groupBy("h1", "h2").agg(F.min("doc_id").alias("a"), F.count(F.lit(1)).alias("n"))
        copies = scratch.keep(sigs.join(same.filter("n > 1"), ["h1", "h2"]).filter(F.col("doc_id") != F.col("a"))
                              .select("a", F.col("doc_id").alias("b"), "h1", "h2"))
        # Of equal texts only the first goes on.
        firsts = sigs.join(copies.select(F.col("b").alias("doc_id"), "h1", "h2"), ["doc_id", "h1", "h2"], "left_anti")
        firsts = scratch.keep(firsts.select("doc_id", "sig", "bands"))
        band = firsts.select(F.col("doc_id").alias("b"), F.explode("bands").alias("key"))
        heads = band.groupBy("key").agg(F.min("b").alias("a"), F.max("b").alias("z")).filter("a < z")
        met = scratch.keep(band.join(heads.select("key", "a"), "key").select("key", "a", "b"))
        # Only texts that share a band move.
        ids = met.select(F.col("b").alias("doc_id")).distinct()
        texts = scratch.keep(docs.join(ids.hint("merge"), "doc_id", "left_semi").select("doc_id", "text"))
        links = copies.select("a", "b").unionByName(
            _compare(_first_pairs(met, firsts, least), texts, threshold, size, scratch))
        label = classes(links, scratch)
        pairs = _open_pairs(met, label, firsts, texts, threshold, size, scratch)
        if pairs is not None:
            more = _compare(pairs, texts, threshold, size, scratch)
            if more.limit(1).count():
                label = classes(links.unionByName(more), scratch)
        named = label.select(F.col("node").alias("doc_id"), F.col("label").alias("class_id"))
        heads = named.select(F.col("class_id").alias("doc_id"), "class_id").distinct()
        return named.unionByName(heads).checkpoint()


def op2_near_duplicates(spark, sf_dir: str) -> DataFrame:
    """doc_id and class_id (smallest doc_id of its near-duplicate class, itself if alone) for each row."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id").join(near_duplicates(docs), "doc_id", "left") \
        .select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate class, unchanged.

    Of rows that repeat the first document's id, one with the least text hash
    stays; rows with a null doc_id all stay.
    """
    later = near_duplicates(docs).filter("doc_id <> class_id").select("doc_id")
    repeated = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 and doc_id is not null") \
        .select("doc_id").checkpoint()
    if not repeated.limit(1).count():
        return docs.join(later.hint("merge"), "doc_id", "left_anti")
    alone = docs.join(later.unionByName(repeated).hint("merge"), "doc_id", "left_anti")
    rows = docs.join(repeated, "doc_id", "left_semi").join(later, "doc_id", "left_anti") \
        .select(F.struct(*docs.columns).alias("row"))
    rows = rows.select("row", F.col("row.doc_id").alias("id"),
                       F.xxhash64(F.coalesce("row.text", F.lit(""))).alias("hash"))
    least = rows.groupBy("id").agg(F.min("hash").alias("hash"))
    return alone.unionByName(rows.join(least, ["id", "hash"]).dropDuplicates(["id"]).select("row.*"))
