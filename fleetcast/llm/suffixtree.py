"""Language-model scoring with a probabilistic suffix tree (operator 8).

The tree's symbols are the UTF-8 bytes of a text's words, a space behind each
word and an end behind the last, so the probability of a text is that of its
token sequence.

* Counting: every byte with the DEPTH before it, added up per task and then by
  Spark; shorter contexts are sums of longer ones.  Pairs of bytes are counted
  ahead, with the words.
* Growing: a context is retained if its next-byte distribution diverges from its
  parent's: n * KL(context || parent) above ``least_gain`` nats.  Nothing else
  drops a context, so the tree grows with the text.  Parents of retained
  contexts are retained.  One shuffle brings grams with the same two bytes before
  their last to one task, in order of their contexts read backwards: the contexts
  of such a group, but for those of one byte, are in no other.
* Smoothing: counts of a state are mixed with its parent's distribution.
* Scoring: the longest retained suffix at each position gives the distribution.
  It is looked up once for each distinct gram (a byte and the DEPTH before it)
  of all texts.  The most frequent grams (``sent`` of them at most) are known to
  every task; all others are joined by their key.

The tree spells tokens, known or not; how often known tokens occur counts too.
With c the count of a token among N training tokens and w the spelling weight,
P(token) = w * P_tree(its bytes | bytes before) + (1 - w) * c / N.

Token counts, which the base score needs as well, cover the whole vocabulary.
Words above a share of ``common_share`` (at most 1/common_share of them) are
known to every task; all others are joined by their hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import IntMap
from .shared import Scratch
from .textarrays import Texts, runs, signed, slices

DEPTH = 6  # a gram is a key of DEPTH + 1 bytes, at most 7
SYMBOLS = 256
END = 0x0A
LEAST_GAIN = 8.0
PARENT_WEIGHT = 2.0
SPELLING = 0.75
COMMON_SHARE = 2.0 ** -21
SENT = 1 << 21     # grams known to every task
HELD = 3 << 20  # distinct keys a task adds up before it hands them on
HANDED = 1 << 18  # rows that it hands on at once
WORKED = 1 << 18  # bytes of text whose grams are made at once


class Sums:
    """Adds up counts by key in bounded memory."""

    def __init__(self):
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._parts: list[tuple[np.ndarray, np.ndarray]] = []
        self._pending = 0

    def add(self, keys: np.ndarray) -> None:
        got = np.unique(keys, return_counts=True)
        self._parts.append(got)
        self._pending += len(got[0])
        if self._pending > max(HELD // 6, len(self.keys) // 4):
            self.settle()

    def settle(self) -> None:
        """Adds what is pending to the keys held, which are in order and are not sorted again."""
        if not self._pending:
            return
        keys, counts = map(np.concatenate, zip(*self._parts))
        self._parts, self._pending = [], 0
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        edge = runs(keys)
        keys, counts = keys[edge[:-1]], np.add.reduceat(counts, edge[:-1])
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        self.counts[at[known]] += counts[known]
        at, keys, counts = at[~known], keys[~known], counts[~known]
        self.keys = np.insert(self.keys, at, keys)
        self.counts = np.insert(self.counts, at, counts)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        self.settle()
        out = self.keys, self.counts
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        return out


def streams(t: Texts, lowered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts with DEPTH end marks before and one behind each, and where each text's part starts."""
    behind = np.zeros(len(lowered), bool)
    behind[t.word_end] = True
    keep = t.in_word | behind
    raw = np.where(behind, np.uint8(0x20), lowered)[keep]
    size = t.per_text(t.in_word) + t.n_words
    ends = np.cumsum(size)
    raw = np.insert(raw, np.repeat(np.concatenate(([0], ends)), [DEPTH] + [DEPTH + 1] * (t.n - 1) + [1]), END)
    start = np.concatenate(([0], ends)) + np.arange(t.n + 1) * (DEPTH + 1)
    return raw, start


def _scored(n: int, start: np.ndarray) -> np.ndarray:
    """Which bytes behind the first DEPTH are not marks before a text."""
    out = np.ones(n, bool)
    for i in range(DEPTH):
        out[start[:-1] + i] = False
    return out[DEPTH:]


def _grams(raw: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Each scored byte (low 8 bits) with the DEPTH bytes before it."""
    x = raw.astype(np.int64)
    key = np.zeros(len(x) - DEPTH, np.int64)
    for i in range(DEPTH + 1):
        key = (key << 8) | x[i:len(x) - DEPTH + i]
    return key[_scored(len(x), start)]


def turned(key: np.ndarray) -> np.ndarray:
    """Grams with the bytes before the last one in reverse order, most recent first; and back."""
    return ((key >> 8).byteswap().view(np.uint64) >> np.uint64(8)).view(np.int64) & ~np.int64(255) | (key & 255)


WORDS, PAIRS = range(2)  # counted in training texts, before the grams


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words, and bytes with the one before."""
    words, pairs = Sums(), np.zeros(SYMBOLS * SYMBOLS, np.int64)

    def out(kind: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(keys), HANDED):
            part = slice(at, at + HANDED)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys[part]), kind, np.int32)), pa.array(keys[part]),
                                              pa.array(counts[part])], ["kind", "key", "n"])

    for batch in batches:
        for part in slices(batch):
            part = part.filter(part.column("train"))
            if not part.num_rows:
                continue
            t = Texts(part.column("text"))
            lowered = t.lowered()
            words.add(signed(t.word_hash(values=lowered)))
            raw, start = streams(t, lowered)
            pair = raw[DEPTH - 1:-1].astype(np.int64) << 8 | raw[DEPTH:]
            pairs += np.bincount(pair[_scored(len(raw), start)], minlength=len(pairs))
            if len(words.keys) > HELD:
                yield from out(WORDS, *words.take())
    yield from out(WORDS, *words.take())
    there = np.flatnonzero(pairs)
    yield from out(PAIRS, there, pairs[there])


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Grams, turned, with their number in training texts (n) and in all texts (m)."""
    met = Sums()  # a key: a gram, and whether the text teaches as last bit

    def out() -> Iterator[pa.RecordBatch]:
        codes, counts = met.take()
        at = 0
        while at < len(codes):
            to = min(at + HANDED, len(codes))
            to += to < len(codes) and codes[to - 1] >> 1 == codes[to] >> 1  # a gram's two keys stay together
            keys = codes[at:to] >> 1
            edge = runs(keys)[:-1]
            n, m = np.add.reduceat(counts[at:to] * (codes[at:to] & 1), edge), np.add.reduceat(counts[at:to], edge)
            keys = keys[edge]
            yield pa.RecordBatch.from_arrays([pa.array((keys >> 40).astype(np.int32)), *map(pa.array, (keys, n, m))],
                                             ["two", "key", "n", "m"])
            at = to

    for batch in batches:
        for part in slices(batch, most=WORKED):
            t = Texts(part.column("text"))
            raw, start = streams(t, t.lowered())
            learn = part.column("train").to_numpy(zero_copy_only=False)
            met.add(turned(_grams(raw, start)) << 1 | np.repeat(learn, np.diff(start) - DEPTH))
            if len(met.keys) > HELD:
                yield from out()
    yield from out()


class Tree:
    """Retained contexts as arrays, for a tree that fits in memory."""

    def __init__(self, symbol: np.ndarray, contexts: list[np.ndarray], logs: np.ndarray, rare: np.ndarray):
        self.symbol, self.contexts, self.logs, self.rare = symbol, contexts, logs, rare

    def tokens(self, raw: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of spelling each token of ``streams``, and which tokens are ends."""
        s = self.symbol[raw]
        n = len(s) - DEPTH
        key, state, base = np.zeros(n, np.int64), np.zeros(n, np.int64), 1
        for i in range(DEPTH):  # symbol before, the one before that, ...
            key = key * SYMBOLS + s[DEPTH - 1 - i:DEPTH - 1 - i + n]
            known = self.contexts[i + 1]
            if len(known):
                at = np.minimum(np.searchsorted(known, key), len(known) - 1)
                state = np.where(known[at] == key, base + at, state)
            base += len(known)
        last = raw[DEPTH:]
        each = self.logs[state, s[DEPTH:]].astype(np.float64) + self.rare[last]
        pad = ~_scored(len(raw), start)
        each[pad] = 0
        at = np.flatnonzero(((last == 0x20) | (last == END)) & ~pad)
        return np.diff(np.cumsum(each)[at], prepend=0.0), last[at] == END


def grow(byte_counts: dict[int, int], rows: list[np.ndarray], least_gain: float = LEAST_GAIN) -> Tree:
    """The tree of ``gram_scores`` in memory, from next-symbol counts.

    ``rows[d]``: (context of d symbols, next symbol, count) with contexts as
    numbers in base SYMBOLS, most recent symbol first.
    """
    symbol, rare = symbol_table(byte_counts), np.zeros(256)
    levels = []
    for d in range(DEPTH + 1):
        keys, at = np.unique(rows[d][:, 0], return_inverse=True)
        n = np.zeros((len(keys), SYMBOLS))
        np.add.at(n, (at, rows[d][:, 1]), rows[d][:, 2])
        levels.append((keys, n))
    root = levels[0][1].sum(0) if len(levels[0][0]) else np.zeros(SYMBOLS)
    probs = [((root + 0.5) / (root.sum() + 0.5 * SYMBOLS))[None]]
    keep = [np.ones(1, bool)]
    keys = [np.zeros(1, np.int64)]
    parents = [np.zeros(1, np.int64)]
    for d in range(1, DEPTH + 1):
        key, n = levels[d]
        up = np.searchsorted(keys[-1], key // SYMBOLS)
        up = np.minimum(up, len(keys[-1]) - 1)
        known = keys[-1][up] == key // SYMBOLS
        key, n, up = key[known], n[known], up[known]
        above = probs[-1][up]
        total = n.sum(1, keepdims=True)
        own = n / np.maximum(total, 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(n > 0, n * np.log(own / above), 0.0).sum(1)
        probs.append((n + PARENT_WEIGHT * above) / (total + PARENT_WEIGHT))
        keep.append(gain > least_gain)
        keys.append(key)
        parents.append(up)
    for d in range(DEPTH, 1, -1):  # a retained context's suffixes are states too
        keep[d - 1][parents[d][keep[d]]] = True
    logs = np.log10(np.concatenate([p[k] for p, k in zip(probs, keep)])).astype(np.float32)
    return Tree(symbol, [k[m] for k, m in zip(keys, keep)], logs, rare)


def symbol_table(byte_counts: dict[int, int]) -> np.ndarray:
    """The symbol of each byte: the byte itself, however seldom it is."""
    return np.arange(256)


def _divergence(n: np.ndarray, above: np.ndarray, total: np.ndarray) -> np.ndarray:
    """What each next byte adds to n * KL(context || parent)."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n > 0, n * np.log(n / total / above), 0.0)


def group_scores(key: np.ndarray, n: np.ndarray, pairs: np.ndarray, least_gain: float) -> np.ndarray:
    """log10 probability of the last byte of turned grams in order, NaN where two bytes are no state.

    All grams that have two bytes before the last in common must be here.
    ``pairs``: probability of a byte after the one before, as one array.
    """
    levels = {DEPTH: (key, n.astype(np.float64))}
    up = {}
    for d in range(DEPTH - 1, 1, -1):  # grams without their first byte
        longer, count = levels[d + 1]
        keys, up[d + 1] = np.unique((longer >> 16 << 8) | (longer & 255), return_inverse=True)
        levels[d] = keys, np.bincount(up[d + 1], count, len(keys))
    p, keep, contexts, of = {}, {}, {}, {}
    for d in range(2, DEPTH + 1):
        keys, n = levels[d]
        above = pairs[(keys >> 16 << 8) | (keys & 255)] if d == 2 else p[d - 1][up[d]]
        edge = runs(keys >> 8)
        contexts[d], of[d] = keys[edge[:-1]] >> 8, np.repeat(np.arange(len(edge) - 1), np.diff(edge))
        total = np.add.reduceat(n, edge[:-1])[of[d]]
        keep[d] = np.add.reduceat(_divergence(n, above, total), edge[:-1]) > least_gain
        p[d] = (n + PARENT_WEIGHT * above) / (total + PARENT_WEIGHT)
    for d in range(DEPTH, 2, -1):  # a retained context's suffixes are states too
        keep[d - 1][np.searchsorted(contexts[d - 1], contexts[d][keep[d]] >> 8)] = True
    out = np.where(keep[2][of[2]], np.log10(p[2]), np.nan)
    for d in range(3, DEPTH + 1):
        out = np.where(keep[d][of[d]], np.log10(p[d]), out[up[d]])
    return out


GROUPED = 1 << 18  # grams that a task works on at once, or one group if that is larger


def _tree(pairs: np.ndarray, least_gain: float):
    def work(rows: pa.Table) -> pa.RecordBatch:
        key, n, m = (rows.column(c).to_numpy() for c in ("key", "n", "m"))
        logp = group_scores(key, n, pairs, least_gain)
        size = np.floor(8 * np.log2(m)).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(turned(key)), pa.array(logp, from_pandas=True), pa.array(size)],
                                          ["key", "logp", "size"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= GROUPED and batch.num_rows:
                table = pa.Table.from_batches(held)
                two = table.column("two").to_numpy()
                whole = int(np.searchsorted(two, two[-1]))  # the last group may go on
                if whole:
                    yield work(table.slice(0, whole))
                    held = table.slice(whole).to_batches()
                rows = table.num_rows - whole if whole else 0
        if sum(b.num_rows for b in held):
            yield work(pa.Table.from_batches(held))
    return run


def gram_scores(scratch: Scratch, grams: DataFrame, pairs: np.ndarray, least_gain: float = LEAST_GAIN) -> DataFrame:
    """Grams (key) with logp, the log10 probability of a gram's byte after the others, and size.

    ``grams``: rows of _count_grams, added up here.  n: how often a gram was met
    in training texts, m: in all texts.  Only n teaches.  size is that of m.
    ``pairs``: counts of a byte (column) after another (row) in training texts.
    """
    root = (pairs.sum(0) + 0.5) / (pairs.sum() + 0.5 * SYMBOLS)
    total = pairs.sum(1, keepdims=True)
    after = (pairs + PARENT_WEIGHT * root) / (total + PARENT_WEIGHT)
    deep = scratch.keep(
        grams.repartition("two").groupBy("two", "key").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
        .sortWithinPartitions("two", "key").mapInArrow(_tree(after.ravel(), least_gain), "key long, logp double, size int"))
    one = F.shiftright("key", 8).bitwiseAND(255).cast("int")
    longer = [r["one"] for r in deep.filter("logp is not null").select(one.alias("one")).distinct().collect()]
    keep = _divergence(pairs, root, total).sum(1) > least_gain
    keep[longer] = True
    short = np.log10(np.where(keep[:, None], after, root))  # of one byte before or none: SYMBOLS ** 2 numbers
    pair = F.col("key").bitwiseAND(0xFFFF).cast("int")
    short = scratch.spark.createDataFrame(pa.table({"pair": pa.array(np.arange(short.size, dtype=np.int32)),
                                                    "short": pa.array(short.ravel())}))
    return deep.withColumn("pair", pair).join(F.broadcast(short), "pair") \
        .select("key", F.coalesce("logp", "short").alias("logp"), "size")


def frequent(scores: DataFrame, sent: int) -> int:
    """The least ``size`` such that at most ``sent`` grams have it or a larger one."""
    least = 1 << 30
    for r in sorted(scores.groupBy("size").count().collect(), key=lambda r: -r["size"]):
        sent -= r["count"]
        if sent < 0:
            break
        least = r["size"]
    return least


def mixed(c: np.ndarray, spelled: np.ndarray, n: int, w: float) -> np.ndarray:
    """log10 of w * 10**spelled + (1 - w) * c / n, also where the first is too small for a float."""
    with np.errstate(divide="ignore"):
        return np.logaddexp(np.log(w) + spelled * np.log(10), np.log((1 - w) * c / n)) / np.log(10)


def _lists(sizes: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), values)


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, logs, words, counts, n, w, ends = model.value
        spell = IntMap(grams[:0], np.zeros(0, np.int32), room=len(grams), spare=1)
        for i in range(0, len(grams), HANDED):
            spell.put(grams[i:i + HANDED], np.arange(i, min(i + HANDED, len(grams)), dtype=np.int32))
        known = IntMap((words.view(np.uint64) >> np.uint64(1)).view(np.int64), np.arange(len(words), dtype=np.int32))
        counts = np.append(counts, -1.0)
        for batch in batches:
            for part in slices(batch, most=WORKED):
                t = Texts(part.column("text"))
                lowered = t.lowered()
                gram = _grams(*streams(t, lowered))
                at = spell.get(gram)
                last = gram & 255
                token_end = np.flatnonzero((last == 0x20) | (last == END))
                is_end = last[token_end] == END
                spelled = np.diff(np.cumsum(logs[at])[token_end], prepend=0.0)
                to_join = np.diff(np.cumsum(at < 0)[token_end], prepend=0)
                h, doc = t.word_hash(values=lowered), np.cumsum(is_end) - is_end
                at_word = known.get((h >> np.uint64(1)).view(np.int64))
                if len(words):
                    at_word[(at_word >= 0) & (words[at_word].view(np.uint64) != h)] = -1
                key, c = np.zeros(len(doc), np.int64), np.full(len(doc), float(ends))
                key[~is_end], c[~is_end] = signed(h), counts[at_word]  # -1: joined later
                common = (c >= 0) & ~is_end
                base = np.bincount(doc[common], np.log10(c[common] + 0.1), t.n)
                n_common = np.bincount(doc[common], minlength=t.n)
                done = (c >= 0) & (to_join == 0)
                score = np.bincount(doc[done], mixed(c[done], spelled[done], n, w), t.n)
                seldom, opened = (c < 0) & (to_join == 0), to_join > 0
                n_seldom, n_open = np.bincount(doc[seldom], minlength=t.n), np.bincount(doc[opened], minlength=t.n)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("uid"),
                     pa.array(t.n_words + 1), pa.array(n_common.astype(np.int64)), pa.array(base.astype(float)),
                     pa.array(score.astype(float)), _lists(n_seldom, pa.array(key[seldom])),
                     _lists(n_seldom, pa.array(spelled[seldom].astype(np.float32))),
                     _lists(n_open, pa.array(key[opened])), _lists(n_open, pa.array(spelled[opened].astype(np.float32))),
                     _lists(n_open, pa.array(c[opened])),
                     _lists(n_open, _lists(to_join[opened], pa.array(gram[at < 0])))],
                    ["row", "uid", "n_tokens", "n_common", "common_base", "common_score", "words", "spelled",
                     "open_words", "open_spelled", "open_counts", "open_grams"])
    return run


def score_texts(docs: DataFrame, train: str = "train", least_gain: float = LEAST_GAIN,
                common_share: float = COMMON_SHARE, spelling: float = SPELLING, sent: int = SENT) -> DataFrame:
    """Each row of ``docs`` without its text, with n_tokens, n_known, train_tokens, base_score and score.

    The model learns from rows whose boolean column ``train`` is true.  Null and
    empty texts are the end alone.  Each row stands for itself, repeated ones
    too.  With nothing to learn from, all bytes are alike and no token is known.
    """
    added = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    keep = [c for c in docs.columns if c != "text" and c not in added]
    spark = docs.sparkSession
    with Scratch(spark, "suffixtree") as scratch:
        texts = docs.select("text", F.coalesce(F.col(train), F.lit(False)).alias("train"))
        counts = scratch.keep(texts.mapInArrow(_count, "kind int, key long, n long")
                              .groupBy("kind", "key").agg(F.sum("n").alias("n")))
        ends = docs.filter(F.col(train)).count()
        vocabulary = counts.filter(F.col("kind") == WORDS).select("key", "n")
        total = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
        n, v = total["n"] + ends, total["v"] + (ends > 0)
        least = max(1.0, n * common_share)
        common = vocabulary.filter(F.col("n") >= least).toArrow()
        pairs = np.zeros(SYMBOLS * SYMBOLS)
        for r in counts.filter(F.col("kind") == PAIRS).collect():   # SYMBOLS ** 2 rows at most
            pairs[r["key"]] = r["n"]
        grams = texts.mapInArrow(_count_grams, "two int, key long, n long, m long")
        scores = gram_scores(scratch, grams, pairs.reshape(SYMBOLS, SYMBOLS), least_gain)
        size = frequent(scores, sent)
        often = scores.filter(F.col("size") >= size).select("key", "logp").toArrow()
        weight = spelling if n else 1.0
        model = spark.sparkContext.broadcast(
            (np.asarray(often["key"]).astype(np.int64), np.append(np.asarray(often["logp"]).astype(np.float64), 0.0),
             np.asarray(common["key"]).astype(np.int64), np.asarray(common["n"]).astype(np.float64),
             max(n, 1), weight, ends))
        src = docs.select(F.struct(*keep).alias("row"), "text", F.monotonically_increasing_id().alias("uid"))
        schema = T.StructType([src.schema["row"]])
        longs, floats = T.ArrayType(T.LongType()), T.ArrayType(T.FloatType())
        for c, kind in (("uid", "long"), ("n_tokens", "long"), ("n_common", "long"), ("common_base", "double"),
                        ("common_score", "double"), ("words", longs), ("spelled", floats), ("open_words", longs),
                        ("open_spelled", floats), ("open_counts", T.ArrayType(T.DoubleType())),
                        ("open_grams", T.ArrayType(longs))):
            schema = schema.add(c, kind)
        scored = scratch.keep(src.mapInArrow(_score(model), schema))
        rows = scored.select("uid", F.explode(F.arrays_zip("words", "spelled")).alias("x")) \
            .select("uid", F.col("x.words").alias("key"), F.col("x.spelled").cast("double").alias("spelled"))
        # Tokens with a gram that the tasks did not know, spelled to the end here.
        opened = scored.select("uid", F.posexplode(F.arrays_zip("open_words", "open_spelled", "open_counts", "open_grams"))
                               .alias("token", "x")) \
            .select("uid", "token", "x", F.posexplode("x.open_grams").alias("place", "key"))
        first = F.col("place") == 0  # the only row of a token to carry what holds for the whole token
        opened = opened.select("uid", "token", "key", F.when(first, F.col("x.open_words")).alias("word"),
                               F.when(first, F.col("x.open_spelled")).alias("so_far"),
                               F.when(first, F.col("x.open_counts")).alias("count")) \
            .join(scores.filter(F.col("size") < size).select("key", "logp"), "key", "left").groupBy("uid", "token") \
            .agg(F.max("word").alias("key"), (F.max("so_far") + F.sum("logp")).alias("spelled"),
                 F.max("count").alias("count"))
        opened = scratch.keep(opened.drop("token"))
        seldom = vocabulary.filter(F.col("n") < least)
        met = rows.unionByName(opened.filter("count < 0").drop("count")).join(seldom, "key", "left") \
            .select("uid", "spelled", F.coalesce("n", F.lit(0)).cast("double").alias("c"), F.lit(True).alias("own"))
        met = met.unionByName(opened.filter("count >= 0")
                              .select("uid", "spelled", F.col("count").alias("c"), F.lit(False).alias("own")))
        c, own = F.col("c"), F.col("own")  # own: not yet in common_base and n_common
        counted, spelled = F.log10(c * ((1 - weight) / max(n, 1))), F.col("spelled") + float(np.log10(weight))
        rest = met.groupBy("uid").agg(
            F.sum(F.when(own, F.log10(c + 0.1)).otherwise(0.0)).alias("base"),
            F.sum((own & (c > 0)).cast("long")).alias("known"),
            F.sum(F.when(c > 0, counted + F.log10(1 + F.pow(F.lit(10.0), spelled - counted))).otherwise(spelled))
            .alias("score"))
        out = scored.select("row", "uid", "n_tokens", "n_common", "common_base", "common_score").join(rest, "uid", "left")
        norm = float(np.log10(n + 0.1 * (v + 1)))
        end = float(np.log10(ends + 0.1))
        return out.select(
            "row.*", "n_tokens", (F.col("n_common") + F.coalesce("known", F.lit(0)) + int(ends > 0)).alias("n_known"),
            F.lit(n).cast("long").alias("train_tokens"),
            (F.col("common_base") + F.coalesce("base", F.lit(0.0)) + end - F.col("n_tokens") * norm)
            .alias("base_score"),
            (F.col("common_score") + F.coalesce("score", F.lit(0.0))).alias("score")).checkpoint()


def op8_lm_scoring(spark, sf_dir: str) -> DataFrame:
    bucket = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text") \
        .withColumn("held_out", F.coalesce(bucket == 0, F.lit(True))).withColumn("train", ~F.col("held_out"))
    return score_texts(docs).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
