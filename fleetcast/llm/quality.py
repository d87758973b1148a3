"""Quality rules with risk-controlled cutoffs (operator 4).

Text measures come from one pass over the words.  A rule rejects a document
when a measure passes a cutoff.  Cutoffs are chosen from a fixed grid by labelled
documents, stratum by stratum.  One half of the labels (by a hash of the id)
orders the rules: from no cutoff on, each step tightens the measure that rejects
most bad documents for the good ones it costs.  The other half, the holdout,
tests the rules in this order: a rule holds if the exact (Clopper-Pearson) upper
bound on its false rejection rate among good documents is below ``alpha``, and
the first that does not ends the sequence.  As the order does not depend on the
holdout, a fixed sequence needs no correction for its length (Holm's and
Bonferroni's do); the strata share ``delta`` (Bonferroni).  So with probability
1 - delta the chosen rules of all strata hold at once.  A stratum with too few
good labels to prove any rule gets none: its documents are judged by the base
rule alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textarrays import Ranges, Texts, in_doc, runs, slices

SYMBOLS = b"#*$%&|<>"
MEASURES = ("symbol_ratio", "dup_line_ratio", "repeat_ratio", "word_length")
GRID = {
    "symbol_ratio": (0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.75, 1.0, 1.5, 2.0),
    "dup_line_ratio": (0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8),
    "repeat_ratio": (0.02, 0.05, 0.08, 0.1, 0.12, 0.15, 0.18),
    "word_length": (7.0, 8.0, 9.0, 10.0, 12.0, 15.0, 20.0),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def _measure(texts: pa.Array) -> list[np.ndarray]:
    t = Texts(texts)
    b = t.bytes
    chars = t.per_text(t.in_word & ((b & 0xC0) != 0x80))
    symbols = t.per_text(np.isin(b, np.frombuffer(SYMBOLS, np.uint8)))
    # Lines end at \n and at the separator behind each text.
    stop = b == 0x0A
    stop[t.end] = True
    ends = np.flatnonzero(stop)
    starts = np.concatenate(([0], ends[:-1] + 1))
    words_before = np.concatenate(([0], np.cumsum(t.in_word)))
    keep = words_before[ends] > words_before[starts]
    starts, ends = starts[keep], ends[keep]
    doc = np.searchsorted(t.start, starts, "right") - 1
    key = in_doc(doc, Ranges(b.astype(np.uint64) + np.uint64(1)).of(starts, ends))
    order = np.argsort(key, kind="stable")
    first = runs(key[order])[:-1]
    lines = np.bincount(doc, minlength=t.n)
    dup_lines = lines - np.bincount(doc[order[first]], minlength=t.n)
    # Words below 5-word windows that occur again in the same text.
    at, h = t.shingles(t.word_hash(), 5)
    wdoc = t.word_doc()
    key = in_doc(wdoc[at], h)
    order = np.argsort(key)
    edge = runs(key[order])
    again = np.repeat(np.diff(edge) > 1, np.diff(edge))
    cover = np.zeros(len(wdoc) + 1, np.int64)
    hit = at[order[again]]
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + 5, -1)
    repeat = np.bincount(wdoc[np.cumsum(cover[:-1]) > 0], minlength=t.n)
    return [t.n_words, chars, symbols, dup_lines, repeat, lines]


def text_measures(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns and the counts of each row's whole text (null: empty); narrow output."""
    src = docs.select(*carry, F.col(text).alias("_text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != "_text"]
                       + [f"{c} long" for c in COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                got = _measure(part.column("_text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in carry] + [pa.array(x.astype(np.int64)) for x in got],
                    [*carry, *COUNTS])

    return src.mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def measures() -> dict[str, Column]:
    """Ratios that cutoffs apply to; 0 where there is nothing to divide by."""
    def ratio(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    return {"symbol_ratio": ratio("n_symbols", "n_words"), "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
            "repeat_ratio": ratio("n_repeat_words", "n_words"), "word_length": ratio("word_chars", "n_words")}


def binomial_at_most(x: int, n: int, p: float) -> float:
    """P(X <= x) for X binomial(n, p)."""
    if x >= n:
        return 1.0
    logs = (math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
            + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(x + 1))
    return min(1.0, math.fsum(map(math.exp, logs)))


def proves(x: int, n: int, alpha: float, level: float) -> bool:
    """Whether the exact upper bound on a rate with x of n rejections is below alpha.

    The Clopper-Pearson bound at ``level`` is below alpha exactly when x or fewer
    rejections would have a probability of at most ``level`` at the rate alpha.
    """
    if n <= 0 or x >= alpha * n:
        return False
    return binomial_at_most(x, n, alpha) <= level


def rule_order(good: dict, bad: dict, sizes: list[int]) -> list[tuple[int, ...]]:
    """Rules from lax to strict: per measure the place of its cutoff in the grid (its length: none).

    ``good`` and ``bad`` count documents by level: how many grid points of each
    measure they pass.  Equal choices take the earlier measure, then the laxer cutoff.
    """
    levels = [np.array(sorted(d), np.int64).reshape(-1, len(sizes)) for d in (good, bad)]
    counts = [np.array([d[k] for k in sorted(d)], np.int64) for d in (good, bad)]
    left = [np.ones(len(c), bool) for c in counts]
    rule, path = list(sizes), []
    while True:
        best, step = None, None
        for m in range(len(sizes)):
            for to in range(rule[m] - 1, -1, -1):
                lost, won = (int(c[k & (v[:, m] > to)].sum()) for c, k, v in zip(counts, left, levels))
                worth = won / (lost + 0.5)
                if won and (best is None or worth > best):
                    best, step = worth, (m, to)
        if step is None:
            return path
        rule[step[0]] = step[1]
        left = [k & (v[:, step[0]] <= step[1]) for k, v in zip(left, levels)]
        path.append(tuple(rule))


def proven(path: list[tuple[int, ...]], good: dict, alpha: float, level: float) -> tuple[int, ...] | None:
    """The last rule before the first of ``path`` that ``good`` holdout documents do not prove."""
    last, n = None, sum(good.values())
    for rule in path:
        if not proves(sum(c for v, c in good.items() if any(x > k for x, k in zip(v, rule))), n, alpha, level):
            break
        last = rule
    return last


def choose_cutoffs(measured: DataFrame, labels: DataFrame, stratum: str, alpha: float, delta: float,
                   grid: dict[str, tuple[float, ...]] | None = None) -> list[tuple]:
    """Rows (stratum, measure, cutoff) that hold.

    ``labels``: doc_id and quality (1 good, 0 bad; of several labels of one id
    the greatest counts).  What reaches the driver is counts of labelled
    documents by stratum, half and levels, at most the product of the grid's
    sizes for each.
    """
    grid = {m: tuple(sorted(points)) for m, points in (grid or GRID).items()}
    truth = labels.filter(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max("quality").alias("_quality"))
    cols = measures()
    levels = [sum((F.when(cols[m] > c, 1).otherwise(0) for c in points), F.lit(0)).alias(m) for m, points in grid.items()]
    # Copies of a document count once.
    held = measured.filter(~base_failed()).join(truth, "doc_id").select(
        "doc_id", F.col(stratum).alias("_stratum"), "_quality", *levels).distinct()
    half = (F.crc32(F.concat(F.lit("half "), F.col("doc_id").cast("string")).cast("binary")) % 2).alias("_half")
    counted = held.groupBy("_stratum", half, "_quality", *grid).agg(F.count(F.lit(1)).alias("_n")).collect()
    strata: dict = {}
    for r in counted:
        of = strata.setdefault(r["_stratum"], {(h, q): {} for h in (0, 1) for q in (0, 1)})
        of[r["_half"], r["_quality"]][tuple(r[m] for m in grid)] = r["_n"]
    out = []
    for name in sorted(strata, key=lambda s: (s is not None, str(s))):
        of = strata[name]
        path = rule_order(of[0, 1], of[0, 0], [len(p) for p in grid.values()])
        rule = proven(path, of[1, 1], alpha, delta / len(strata))
        if rule:
            out += [(name, m, points[k]) for (m, points), k in zip(grid.items(), rule) if k < len(points)]
    return out


def verdict(stratum: str, cutoffs: list[tuple]) -> Column:
    """True for rows that pass the base rule and every cutoff of their stratum."""
    bad, cols = base_failed(), measures()
    for value, m, c in cutoffs:
        bad = bad | (F.col(stratum).eqNullSafe(F.lit(value)) & (cols[m] > F.lit(float(c))))
    return ~bad


def quality_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = 0.04,
                  delta: float = 0.05, grid: dict[str, tuple[float, ...]] | None = None) -> DataFrame:
    """doc_id, the counts, base_failed and kept for every row of ``docs``.

    ``labels`` has doc_id and quality (1 good, 0 bad).  Null or empty texts have no
    words and fail the base rule.  Repeated rows are judged alike, each with its
    own result; a null stratum is a stratum of its own; null doc_ids are judged
    but have no labels.  With no labels, only the base rule decides.
    """
    measured = text_measures(docs, "text", ("doc_id", stratum)).checkpoint()
    cutoffs = choose_cutoffs(measured, labels, stratum, alpha, delta, grid)
    return measured.withColumns({"base_failed": base_failed(), "kept": verdict(stratum, cutoffs)})


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules(docs, labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, unchanged.

    Works on every row: the verdict is joined back by doc_id and a hash of the
    text, so repeated ids with different texts are judged apart.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = docs.select(F.struct("*").alias("row")).withColumn("hash", F.xxhash64(F.coalesce("row.text", F.lit(""))))
    measured = text_measures(rows.select("row.doc_id", "row.lang", "row.text", "hash"), "text",
                             ("doc_id", "lang", "hash")).checkpoint()
    cutoffs = choose_cutoffs(measured, labels, "lang", 0.04, 0.05)
    bad = measured.filter(~verdict("lang", cutoffs)).select("doc_id", "lang", "hash").distinct()
    return rows.join(bad, F.col("row.doc_id").eqNullSafe(bad["doc_id"]) & (rows["hash"] == bad["hash"])
                     & F.col("row.lang").eqNullSafe(bad["lang"]), "left_anti").select("row.*")
