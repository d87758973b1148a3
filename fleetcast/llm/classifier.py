"""Quality classifier with supervised subword embeddings (operator 10).

Every word, every run of two to five words and every n-gram of 3 to 5 characters
(code points) inside a word, with its ends marked, is hashed to a row of a table
of learned vectors.  One more row for each word 5-gram tells how often the text
has had it before (up to 3 times), as a mean of vectors cannot show by itself that
a text repeats.  A document is the mean of its rows, and a softmax over two classes
reads it.  Table and softmax are trained together by numpy stochastic gradient
descent on a bounded sample of labelled documents (``sample`` rows and ``size``
bytes, those with the least hash of their id; whole texts).  Scoring is one pass
over all texts in parallel: only the softmax margin of each table row is needed,
one float a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textarrays import Ranges, Texts, in_doc, mix, runs, slices, spread

BUCKETS, DIM = 1 << 17, 8
EPOCHS, BATCH, RATE = 4, 16, 0.03
SAMPLE, SAMPLE_BYTES = 5000, 1 << 26
WORD_RUNS = (2, 3, 4, 5)
SEED = 20240101


def features(t: Texts, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, table row) of every n-gram."""
    lowered = t.lowered()
    h = Ranges(lowered.astype(np.uint64) + np.uint64(1))
    n = len(lowered)
    word = h.of(t.word_start, t.word_end)
    docs, keys = [t.word_doc()], [word]
    # Marked ends: an n-gram may take the separator on either side of its word, not more.
    gap = np.concatenate(([0], np.cumsum(~t.in_word)))
    points = np.append(np.flatnonzero((lowered & 0xC0) != 0x80), n)   # where each character starts
    for size in (3, 4, 5):
        m = max(0, len(points) - size)
        at, last, end = points[:m], points[size - 1:size - 1 + m], points[size:size + m]
        blanks = gap[end] - gap[at]
        edge = (~t.in_word[at]).astype(np.int64) + ~t.in_word[last]
        doc = np.searchsorted(t.start, at, "right") - 1
        ok = (blanks == edge) & (blanks < 2) & (end <= t.end[doc] + 1)   # none reaches into the next text
        keys.append(mix(h.of(at[ok], end[ok]) + np.uint64(size)))
        docs.append(doc[ok])
    for size in WORD_RUNS:
        at, run = t.shingles(word, size)
        keys.append(mix(run + np.uint64(100 + size)))
        docs.append(t.word_doc()[at])
    # The last of them are runs of five: how often the text has had each before.
    doc = docs[-1]
    order = np.argsort(in_doc(doc, run), kind="stable")
    edge = runs(in_doc(doc, run)[order])
    before = spread(np.zeros(len(edge) - 1, np.int64), np.diff(edge))
    docs.append(doc[order])
    keys.append(mix(np.minimum(before, 3).astype(np.uint64) + np.uint64(0x51ED)))
    return np.concatenate(docs), (np.concatenate(keys) % np.uint64(buckets)).astype(np.int64)


class Model:
    """Vectors, output weights and bias; ``margin`` is what a mean of rows adds up to."""

    def __init__(self, vectors: np.ndarray, output: np.ndarray, bias: np.ndarray):
        self.margin = (vectors @ (output[1] - output[0])).astype(np.float32)
        self.bias = float(bias[1] - bias[0])

    def scores(self, texts: pa.Array) -> np.ndarray:
        t = Texts(texts)
        doc, row = features(t, len(self.margin))
        total = np.bincount(doc, self.margin[row], t.n)
        count = np.bincount(doc, minlength=t.n)
        z = total / np.maximum(count, 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def train(texts: list[str], labels: np.ndarray, buckets: int = BUCKETS, dim: int = DIM, epochs: int = EPOCHS,
          batch: int = BATCH, rate: float = RATE, seed: int = SEED) -> Model:
    """Stochastic gradient descent on the softmax loss; the rate falls to 0, and for each row with its past gradients.

    Classes weigh alike however many documents they have.  With labels of one
    class only, or none, all scores are the share of ones (1 with no labels).
    """
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (buckets, dim)).astype(np.float32)
    output = rng.uniform(-1 / dim, 1 / dim, (2, dim)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    n = len(texts)
    ones = int(labels.sum())
    if ones in (0, n):
        bias[1] = 50.0 if ones == n else -50.0
        return Model(vectors * 0, output, bias)
    weight = np.where(labels == 1, n / (2 * ones), n / (2 * (n - ones))).astype(np.float32)
    # Distinct rows of each document with their share of its mean.
    docs = []
    for start in range(0, n, 20):
        part = texts[start:start + 20]
        doc, row = features(Texts(pa.array(part, pa.string())), buckets)
        key, count = np.unique(doc * buckets + row, return_counts=True)
        edge = np.searchsorted(key, np.arange(len(part) + 1) * buckets)
        for i in range(len(part)):
            c = count[edge[i]:edge[i + 1]].astype(np.float32)
            docs.append(((key[edge[i]:edge[i + 1]] % buckets).astype(np.int32), c / max(1.0, c.sum())))
    seen = np.full(buckets, 1e-12, np.float32)  # squared gradients so far, of each row
    seen_out, seen_bias = np.full((2, dim), 1e-8, np.float32), np.full(2, 1e-8, np.float32)
    steps, step = epochs * -(-n // batch), 0
    for _ in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, batch):
            pick = order[at:at + batch]
            lr = rate * (1 - step / steps)
            step += 1
            mean = np.stack([docs[i][1] @ vectors[docs[i][0]] for i in pick])
            z = mean @ output.T + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(pick)), labels[pick]] -= 1
            p *= weight[pick, None] / len(pick)
            back = p @ output
            grad = p.T @ mean
            seen_out += grad * grad
            output -= lr * grad / np.sqrt(seen_out)
            down = p.sum(0)
            seen_bias += down * down
            bias -= lr * down / np.sqrt(seen_bias)
            for i, g in zip(pick, back):
                rows, share = docs[i]
                seen[rows] += share * share * (float(g @ g) / dim)
                vectors[rows] -= (lr * share / np.sqrt(seen[rows]))[:, None] * g
    return Model(vectors, output, bias)


def shift_to(model: Model, texts: list[str], labels: np.ndarray, cut: float = 0.3) -> Model:
    """Moves the bias so that ``cut`` parts the training classes with the least weighted error."""
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    z = np.concatenate([model.scores(part.column("text")) for part in slices(batch, "text", 1 << 18)])
    z = np.log(np.clip(z, 1e-12, 1 - 1e-12))
    z = z - np.log1p(-np.clip(np.exp(z), 1e-12, 1 - 1e-12))
    order = np.argsort(z)
    good = labels[order] == 1
    lost = np.concatenate(([0], np.cumsum(good))) / max(1, good.sum())
    passed = 1 - np.concatenate(([0], np.cumsum(~good))) / max(1, (~good).sum())
    error = lost + passed
    best = np.flatnonzero(error == error.min())
    mid = int(best[len(best) // 2])
    zs = np.concatenate(([z[order[0]] - 1], z[order], [z[order[-1]] + 1]))
    model.bias += float(np.log(cut / (1 - cut)) - (zs[mid] + zs[mid + 1]) / 2)
    return model


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, cut: float = 0.3, size: int = SAMPLE_BYTES) -> Model:
    """A model from ``sample`` labelled documents of ``size`` bytes at most, chosen by a hash of their ids.

    ``labels``: doc_id and quality (0 or 1; other values and nulls are left out;
    of several labels of one id the greatest counts).  Rows of one doc_id with
    other texts are documents of their own with the same label.  Only the sampled
    texts reach the driver.
    """
    ids = labels.filter(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max("quality").alias("quality")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")
    bytes_of = rows.groupBy("doc_id").agg(F.sum(F.octet_length("text")).alias("n"), F.count(F.lit(1)).alias("rows"))
    chosen, total, count = [], 0, 0
    for r in bytes_of.orderBy(F.xxhash64("doc_id"), "doc_id").collect():   # ``sample`` ids at most
        if total + r["n"] <= size and count + r["rows"] <= sample:
            total, count = total + r["n"], count + r["rows"]
            chosen.append(r["doc_id"])
    taken = F.broadcast(docs.sparkSession.createDataFrame([(i,) for i in chosen], "doc_id long"))
    got = sorted(rows.join(taken, "doc_id", "left_semi").collect(), key=lambda r: (r["doc_id"], r["text"]))
    texts = [r["text"] for r in got]
    y = np.array([r["quality"] for r in got], np.int64)
    model = train(texts, y)
    return shift_to(model, texts, y, cut) if 0 < y.sum() < len(y) else model


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and score (0 to 1) of every row's whole text.

    Null and empty texts have the bias alone; repeated rows and ids are scored
    each.  A kept column named score is replaced; columns not kept are not read.
    """
    keep = [c for c in dict.fromkeys(keep) if c != "score"]
    src = docs.select(*keep, *([] if "text" in keep else ["text"]))
    schema = ", ".join([f"`{c}` {src.schema[c].dataType.simpleString()}" for c in keep] + ["score double"])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                got = shared.value.scores(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + [pa.array(got)], [*keep, "score"])

    return src.mapInArrow(run, schema)


def held_out(column: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def op10_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality").filter(~held_out())
    return score(docs, fit(docs, labels)).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
