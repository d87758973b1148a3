"""BPE, packing, scoring, classifier and fingerprints against the library or plain Python."""
import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import SCHEMA, sentence, words
from pyspark.sql import functions as F

from fleetcast.llm import bpe, classifier, fingerprints, packing, suffixtree
from fleetcast.llm.textarrays import Texts

public_tokenizers = pytest.importorskip("public_tokenizers")
FILES = ("byte_bpe_50k.json", "word_bpe_49k.json")


def library(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.no_padding()
    t.no_truncation()
    return t


PIECES = ["'s", "'t", "'re", "'ll", "'LL", "'", " ", "  ", "\n", "\t", " ", "　", "abc", "Zürich", "123", "٣",
          "½", "!", "...", "$$$", "é", "é", "İ", "ß", "Σ", "中文", "😀", "​", "\x00", "\u0085", "ﬁ", "ǅ",
          "<|endoftext|>", "<|startoftext|>", "==========", "aaaaaaaa", "don't", "\r\n", "가", "नमस्ते", "\U00010400", "_"]


@pytest.mark.parametrize("name", FILES)
def test_encoding_equals_the_library(name, odd_rows):
    rng = random.Random(name)
    texts = [r[1] or "" for r in odd_rows] + ["=" * 5000, "ab" * 900, "x" * 300 + "y", "é" * 400]
    texts += ["".join(rng.choice(PIECES) for _ in range(rng.randrange(40))) for _ in range(1500)]
    enc, lib = bpe.encoder(public_tokenizers.path(name)), library(name)
    ids, count = enc.encode(texts)
    ends = np.cumsum(count)
    for text, a, b in zip(texts, ends - count, ends):
        want = lib.encode(text, add_special_tokens=False).ids
        assert ids[a:b].tolist() == want, text
        if not enc.lower:
            assert enc.decode(ids[a:b]).decode("utf-8", "replace") == lib.decode(want, skip_special_tokens=False)


def test_compatible_pairs_are_those_that_stay_apart():
    enc = bpe.encoder(public_tokenizers.path(FILES[0]))
    rng = np.random.default_rng(3)
    made = np.concatenate((enc.unit, np.arange(enc.first_merge, enc.first_merge + 3000)))
    a, b = rng.choice(made, 3000), rng.choice(made, 3000)
    byte = {t: i for i, t in enumerate(enc.unit.tolist())}

    def units(t):
        return [t] if t in byte else units(enc.left[t]) + units(enc.right[t])

    ok = enc.compatible(a, b)
    assert 0 < ok.sum() < len(ok)
    for x, y, fits in zip(a.tolist(), b.tolist(), ok):
        assert fits == (enc._merge_long(units(x) + units(y)) == [x, y])


def test_encode_texts(odd_docs, odd_rows, no_docs):
    path = public_tokenizers.path(FILES[0])
    lib = library(FILES[0])
    got = bpe.encode_texts(odd_docs.withColumn("ids", F.lit(0)), path).collect()
    want = Counter((r[0], tuple(lib.encode(r[1] or "", add_special_tokens=False).ids), r[1] or "") for r in odd_rows)
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in got) == want
    got = bpe.encode_texts(odd_docs, path, digests=True).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == Counter(
        (d, len(i), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
        for d, i, t in want.elements())
    assert bpe.encode_texts(no_docs, path).count() == 0


def check_places(rows, length):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, size in sorted(places):
            assert offset == at
            at += size
        assert at <= length
    return len(by)


def test_pieces_and_places(odd_docs, odd_rows, no_docs):
    path, lib = public_tokenizers.path(FILES[1]), library(FILES[1])
    want = Counter()
    for d, text, *_ in odd_rows:
        ids = lib.encode(text or "", add_special_tokens=False).ids + [0]
        for p in range(0, len(ids), 512):
            part = ids[p:p + 512]
            want[d, p // 512, p, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    got = packing.pack_documents(odd_docs.withColumn("own", F.lit(1)), path, 512).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    n = check_places(got, 512)
    assert n <= math.ceil(sum(r.length for r in got) / 512) * 1.1 + 1
    assert packing.pack_documents(no_docs, path).count() == 0


def test_packing_is_near_the_lower_bound(spark):
    rng = random.Random(1)
    items = [(i, min(2048, int(rng.expovariate(1 / 500)) + 1)) for i in range(6000)]
    df = spark.createDataFrame(items, "doc_id long, length long").repartition(5)
    got = packing.pack(df, 2048, shard_pieces=1000).collect()
    assert sorted(r.doc_id for r in got) == list(range(6000))
    assert check_places(got, 2048) <= 1.01 * math.ceil(sum(x for _, x in items) / 2048)


def test_sum_of_squares_rule():
    """Each place has the least sum of squares of open sequences per gap, as if tried one by one."""
    rng = random.Random(2)
    sizes = np.array([rng.randrange(1, 40) for _ in range(300)])
    where, offset, gap = packing.sum_of_squares(sizes, 40)
    left = []
    for s, b, o in zip(sizes.tolist(), where.tolist(), offset.tolist()):
        def squares(gaps):
            return sum(n * n for g, n in Counter(gaps).items() if 0 < g)
        options = [squares(left[:i] + [g - s] + left[i + 1:]) for i, g in enumerate(left) if g >= s]
        options.append(squares([*left, 40 - s]))
        if b == len(left):
            left.append(40)
        assert o == 40 - left[b]
        left[b] -= s
        assert squares(left) == min(options)
    assert left == gap.tolist()


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_scoring(odd_docs, odd_rows, no_docs):
    docs = odd_docs.withColumn("train", F.coalesce(F.col("doc_id") % 4 != 0, F.lit(False))).withColumn("uid", F.lit("u"))
    train = [d is not None and d % 4 != 0 for d, *_ in odd_rows]
    tokens = [[*words(low(t)), None] for _, t, *_ in odd_rows]
    c = Counter(w for t, ok in zip(tokens, train) if ok for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted((d or -1, len(t), sum(c[w] > 0 for w in t), n,
                   round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), 6))
                  for (d, *_), t in zip(odd_rows, tokens))
    for share in (suffixtree.COMMON_SHARE, 0.01, 2.0):  # all words common, some, none
        got = suffixtree.score_texts(docs, common_share=share).collect()
        assert sorted((r.doc_id or -1, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                      for r in got) == want
        assert all(-math.inf < r.score < 0 and r.uid == "u" for r in got)
        key = sorted((r.doc_id or -1, r.n_tokens, round(r.score, 2)) for r in got)
        assert share == suffixtree.COMMON_SHARE or key == before
        before = key
    assert suffixtree.score_texts(no_docs.withColumn("train", F.lit(True))).count() == 0
    nothing = suffixtree.score_texts(odd_docs.withColumn("train", F.lit(False))).collect()
    assert len(nothing) == len(odd_rows) and all(r.train_tokens == 0 and r.score < 0 for r in nothing)


def test_tree_against_plain_counts():
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["abra", "cadabra", "abc", "Ünit", "bra"]) for _ in range(60)) for _ in range(40)]
    t = Texts(pa.array(texts))
    raw, start = suffixtree.streams(t, t.lowered())
    d = suffixtree.DEPTH
    plain = [b"\n" * d + (" ".join(words(low(x))) + " ").encode() + b"\n" for x in texts]
    assert raw.tobytes() == b"".join(plain)
    grams = Counter(p[i - d:i + 1] for p in plain for i in range(d, len(p)))
    keys, n = np.unique(suffixtree._grams(raw, start), return_counts=True)
    assert Counter({int(k).to_bytes(d + 1, "big"): int(c) for k, c in zip(keys, n)}) == grams
    byte = Counter()
    for g, c in grams.items():
        byte[g[-1]] += c
    symbol = suffixtree.symbol_table(byte)
    rows = []
    for depth in range(d + 1):
        sums = Counter()
        for g, c in grams.items():
            context = 0
            for i in range(depth):
                context = context * suffixtree.SYMBOLS + int(symbol[g[d - 1 - i]])
            sums[context, int(symbol[g[d]])] += c
        rows.append(np.array([(a, b, c) for (a, b), c in sums.items()]))
    tree = suffixtree.grow(byte, rows)
    assert np.allclose((10.0 ** tree.logs.astype(float)).sum(1), 1, atol=1e-4)  # a distribution at every state
    assert 1 < len(tree.logs) and all((np.diff(k) > 0).all() for k in tree.contexts)
    known = [set(k.tolist()) for k in tree.contexts]
    for depth in range(2, d + 1):  # closed under suffixes
        assert all(k // suffixtree.SYMBOLS in known[depth - 1] for k in known[depth])
    first = np.concatenate(([0], np.cumsum([len(k) for k in tree.contexts])))
    spelled, is_end = tree.tokens(raw, start)
    total = np.bincount(np.cumsum(np.concatenate(([0], is_end[:-1]))), spelled)
    for p, got in zip(plain[:10], total):
        want = 0.0
        for i in range(d, len(p)):
            context, state = 0, 0
            for depth in range(1, d + 1):
                context = context * suffixtree.SYMBOLS + int(symbol[p[i - depth]])
                if context in known[depth]:
                    state = first[depth] + tree.contexts[depth].tolist().index(context)
            want += tree.logs[state, symbol[p[i]]] + tree.rare[p[i]]
        assert abs(want - got) < 1e-3


def test_every_byte_is_its_own_symbol():
    symbol = suffixtree.symbol_table({b: 1000 - b for b in range(0x20, 0xC0)})
    assert len({int(symbol[b]) for b in range(0x20, 0xC0)}) == 0xC0 - 0x20


def test_seldom_contexts_are_learned(spark):
    """Scores are those of a tree from all counts, with contexts that are a tiny share of the text."""
    rng = random.Random(5)
    common = ["alpha", "beta", "gamma", "delta", "eps", "zeta"]
    texts = [" ".join(rng.choice(common) for _ in range(900)) for _ in range(60)]
    texts += ["".join(chr(x) for x in range(0x430 + i, 0x450)) for i in range(4)] + ["qqjww qjqww"] * 2  # seldom bytes
    held = ["jww qqjwwjww", "alpha jww", "", "".join(chr(x) for x in range(0x433, 0x449))]
    rows = [(i, t, i < len(texts)) for i, t in enumerate(texts + held)]
    tokens = [[*words(low(t)), None] for _, t, _ in rows]
    c = Counter(w for x, (_, _, train) in zip(tokens, rows) if train for w in x)
    d, n = suffixtree.DEPTH, sum(c.values())
    plain = [b"\n" * d + "".join(w + " " for w in x[:-1]).encode() + b"\n" for x in tokens]
    sums = [Counter() for _ in range(d + 1)]
    for p in plain[:len(texts)]:
        for i in range(d, len(p)):
            for depth in range(d + 1):
                sums[depth][int.from_bytes(p[i - depth:i][::-1], "big"), p[i]] += 1
    assert 2 < sum(sums[0].values()) * 2.0 ** -17  # a context met twice is under such a share
    tree = suffixtree.grow({b: k for (_, b), k in sums[0].items()},
                           [np.array([(a, b, k) for (a, b), k in x.items()]) for x in sums])
    t = Texts(pa.array([t for _, t, _ in rows]))
    spelled, is_end = tree.tokens(*suffixtree.streams(t, t.lowered()))
    each = suffixtree.mixed(np.array([c[w] for x in tokens for w in x], float), spelled, n, suffixtree.SPELLING)
    want = np.bincount(np.cumsum(is_end) - is_end, each)
    docs = spark.createDataFrame(rows, "doc_id long, text string, train boolean").repartition(3)
    for sent, share in ((suffixtree.SENT, suffixtree.COMMON_SHARE), (50, 0.01), (0, 2.0), (0, 0.01)):
        got = {r.doc_id: r.score for r in suffixtree.score_texts(docs, sent=sent, common_share=share).collect()}
        assert np.allclose([got[i] for i, _, _ in rows], want, rtol=1e-5, atol=1e-3), (sent, share)


def test_groups_of_grams_give_the_scores_of_the_tree(monkeypatch):
    """One pass over grams in order of their contexts, however they are cut, is the tree from all counts."""
    rng, d = random.Random(10), suffixtree.DEPTH
    texts = [" ".join(rng.choice(["abra", "cadabra", "Ünit", "bra", "xy"]) for _ in range(60)) for _ in range(30)] + ["q"]
    t = Texts(pa.array(texts))
    raw, start = suffixtree.streams(t, t.lowered())
    grams, n = np.unique(suffixtree._grams(raw, start), return_counts=True)
    n[::7] = 0  # met, not learned
    sums = [Counter() for _ in range(d + 1)]
    pairs = np.zeros((256, 256))
    for g, c in zip(grams.tolist(), n.tolist()):
        b = g.to_bytes(d + 1, "big")
        pairs[b[-2], b[-1]] += c
        for depth in range(d + 1):
            sums[depth][int.from_bytes(b[d - depth:d][::-1], "big"), b[-1]] += c
    byte = {b: c for (_, b), c in sums[0].items()}
    tree = suffixtree.grow(byte, [np.array([(a, b, c) for (a, b), c in x.items()]) for x in sums])
    known = [{int(c): i for i, c in enumerate(k)} for k in tree.contexts]
    first = np.concatenate(([0], np.cumsum([len(k) for k in tree.contexts])))
    want = {}
    for g in grams.tolist():
        b = g.to_bytes(d + 1, "big")
        depth = max(i for i in range(d + 1) if int.from_bytes(b[d - i:d][::-1], "big") in known[i])
        at = first[depth] + known[depth][int.from_bytes(b[d - depth:d][::-1], "big")]
        want[g] = tree.logs[at, b[-1]] if depth > 1 else None
    root = (pairs.sum(0) + 0.5) / (pairs.sum() + 128)
    after = (pairs + 2 * root) / (pairs.sum(1, keepdims=True) + 2)
    key = suffixtree.turned(grams)
    order = np.argsort(key)
    rows = pa.RecordBatch.from_arrays([pa.array(x) for x in ((key >> 40)[order], key[order], n[order], n[order] + 1)],
                                      ["two", "key", "n", "m"])
    assert (suffixtree.turned(key) == grams).all()
    for grouped, size in ((1 << 18, 1 << 18), (20, 7), (1, 1)):
        monkeypatch.setattr(suffixtree, "GROUPED", grouped)
        parts = [rows.slice(i, size) for i in range(0, rows.num_rows, size)]
        got = pa.Table.from_batches(suffixtree._tree(after.ravel(), suffixtree.LEAST_GAIN)(iter(parts))).to_pylist()
        assert len(got) == len(want) and any(x is None for x in want.values())
        for r in got:
            x = want[r["key"]]
            assert r["logp"] is None if x is None else abs(r["logp"] - x) < 1e-5


def test_counting_holds_little(monkeypatch):
    """Grams and words are added up in little memory and handed on in small batches, none lost."""
    rng, d = random.Random(12), suffixtree.DEPTH
    texts = ["".join(rng.choice("abcdefghij    \n") for _ in range(rng.choice([0, 9, 30000]))) for _ in range(200)] + [None, "Ä"]
    train = [rng.random() < 0.8 for _ in texts]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(train)], ["text", "train"])
    n, m, vocabulary = Counter(), Counter(), Counter()
    for t, learn in zip(texts, train):
        x = b"\n" * d + "".join(w + " " for w in words(low(t or ""))).encode() + b"\n"
        grams = [int.from_bytes(x[i - d:i][::-1] + x[i:i + 1], "big") for i in range(d, len(x))]
        m.update(grams)
        if learn:
            n.update(grams)
            vocabulary.update(words(low(t or "")))

    def counted():
        got = Counter(), Counter(), Counter()
        for out in suffixtree._count_grams(iter([batch])):
            most.append(out.num_rows)
            for r in out.to_pylist():
                assert r["two"] == r["key"] >> 40
                got[0][r["key"]] += r["n"]
                got[1][r["key"]] += r["m"]
        for out in suffixtree._count(iter([batch.slice(0, 90), batch.slice(90)])):
            most.append(out.num_rows)
            for r in out.to_pylist():
                if r["kind"] == suffixtree.WORDS:
                    got[2][r["key"]] += r["n"]
        assert +got[0] == n and got[1] == m and sorted(got[2].values()) == sorted(vocabulary.values())

    tracemalloc.start()
    rows = sum(out.num_rows for out in suffixtree._count_grams(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == len(m) and peak < 56 * len(m), (peak, rows)
    for held, handed in ((1 << 30, 1 << 12), (1 << 16, 1 << 12), (1 << 30, 3)):
        most = []
        monkeypatch.setattr(suffixtree, "HELD", held)
        monkeypatch.setattr(suffixtree, "HANDED", handed)
        counted()
        assert max(most) <= handed + 1


def test_scoring_keeps_few_tables(odd_docs, monkeypatch):
    """The tree is not written level by level."""
    kept, keep = [], suffixtree.Scratch.keep
    monkeypatch.setattr(suffixtree.Scratch, "keep", lambda self, df, *a: (kept.append(df.columns), keep(self, df, *a))[1])
    suffixtree.score_texts(odd_docs.withColumn("train", F.lit(True)))
    assert len(kept) <= 4


def test_scores_of_held_out_text_are_near_the_entropy(spark):
    """Words of 2 to 5 random syllables: no model can do better than their entropy, and this one comes close."""
    rng = random.Random(6)
    parts = ["tion", "the", "ar", "ing", "ou", "wh"]
    rows = [(i, " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(2, 6))) for _ in range(120)), "en", "s", 0)
            for i in range(150)]
    got = suffixtree.score_texts(spark.createDataFrame(rows, SCHEMA).withColumn("train", F.col("doc_id") % 5 != 0))
    score, tokens = got.filter("not train").agg(F.sum("score"), F.sum("n_tokens")).first()
    entropy = math.log10(4) + 3.5 * math.log10(6)
    assert 0.98 * entropy < -score / tokens < 1.08 * entropy


def test_classifier_learns_and_scores_everything(spark, odd_docs, odd_rows, no_docs):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(500):
        bad = i % 4 == 0
        text = sentence(rng, 60)
        if bad:
            text = " ".join(w + rng.choice(["###", "$$$"]) for w in text.split()) if i % 8 else (sentence(rng, 6) + " ") * 9
        rows.append((i, text, "en", "s", 0))
        labels.append((i, int(not bad)))
    docs = spark.createDataFrame(rows, SCHEMA)
    truth = spark.createDataFrame([*labels, (3, None), (None, 1), (4, 7)], "doc_id long, quality int")
    model = classifier.fit(docs, truth.filter("doc_id % 5 <> 0 or doc_id is null"))
    scores = {r.doc_id: r.score for r in classifier.score(docs, model).collect()}
    held = [(scores[i], q) for i, q in labels if i % 5 == 0]
    assert np.mean([(s >= 0.3) == bool(q) for s, q in held]) > 0.95
    odd = classifier.score(odd_docs, model).collect()
    assert len(odd) == len(odd_rows) and all(0 <= r.score <= 1 for r in odd)
    assert classifier.score(no_docs, model).count() == 0
    one = classifier.fit(docs, truth.filter("quality = 1"))
    assert all(r.score > 0.99 for r in classifier.score(docs, one).collect())
    assert classifier.score(docs, classifier.fit(docs, truth.limit(0))).count() == 500


def test_fingerprints_of_neighbours(odd_docs, odd_rows, plain_docs, plain_rows, no_docs):
    for parts in (1, 3, 7):
        got = {r.doc_id: r for r in fingerprints.fingerprint_documents(
            plain_docs.withColumn("stub", F.lit(1)).withColumn("near_next", F.lit("x")), parts=parts).collect()}
        rows = sorted(plain_rows)
        texts = [r[1] or "" for r in rows]
        edited = [t[:len(t) - len(t) // 4] + n[:len(t) // 4] for t, n in zip(texts, texts[1:] + texts[:1])]
        a, b = fingerprints.fingerprints(texts), fingerprints.fingerprints(edited)
        for i, (d, *_) in enumerate(rows):
            r = got[d]
            assert r.n_chars == len(texts[i]) and r.edited_sha256 == hashlib.sha256(edited[i].encode()).hexdigest()
            assert r.fingerprint == fingerprints.as_text(a[i:i + 1])[0]
            assert r.edited_fingerprint == fingerprints.as_text(b[i:i + 1])[0]
            assert r.near_edited == np.mean(a[i] == b[i]) and r.near_next == np.mean(a[i] == a[(i + 1) % len(a)])
            assert r.stub == 1
    odd = fingerprints.fingerprint_documents(odd_docs, parts=4).collect()
    assert Counter(r.doc_id for r in odd) == Counter(r[0] for r in odd_rows)
    assert fingerprints.fingerprint_documents(no_docs).count() == 0
    single = fingerprints.fingerprint_documents(plain_docs.filter("doc_id = 0")).collect()
    assert len(single) == 1 and single[0].near_next == 1.0


def test_order_min_hash_by_brute_force(odd_rows):
    """The selected k-mers are those of least hash, in text order, occurrences apart."""
    texts = [r[1] or "" for r in odd_rows]
    k, size, m = 5, 3, 16
    got = fingerprints.fingerprints(texts, k, size, m)
    again = fingerprints.fingerprints(texts[::-1], k, size, m)[::-1]
    assert (got == again).all()  # whatever the neighbours in a batch
    kept, fingerprints._LIKELY = fingerprints._LIKELY, 1 << 40  # no limit: every k-mer is looked at
    try:
        assert (fingerprints.fingerprints(texts, k, size, m) == got).all()
    finally:
        fingerprints._LIKELY = kept
    base = sentence(random.Random(1), 300)
    swapped = base[len(base) // 2:] + base[:len(base) // 2]
    p = fingerprints.fingerprints([base, swapped, base[:-40] + "x" * 40, sentence(random.Random(2), 300)])
    near, moved, other = ((p[0] == p[i]).mean() for i in (2, 1, 3))
    assert near > 0.8 > moved > other  # order counts: the same k-mers in other order are less alike


def test_kept_part_is_hashed_once(monkeypatch, odd_rows):
    """Fingerprints of edited texts are those of the texts alone, without their kept k-mers hashed again."""
    rng = random.Random(12)
    texts = [r[1] or "" for r in odd_rows] + [sentence(rng, 200) for _ in range(12)] + ["a" * 90, "abc", "", "ab" * 30]
    which = np.array([i for i in range(len(texts) - 1) if i % 5 != 3])
    kept = np.array([len(texts[i]) - len(texts[i]) // 4 for i in which])
    edited = [texts[i][:c] + texts[i + 1][:len(texts[i]) - c] for i, c in zip(which, kept)]
    hashed = []
    below = fingerprints._below
    monkeypatch.setattr(fingerprints, "_below", lambda base, *rest: (hashed.append(len(base)), below(base, *rest))[1])
    a, b = fingerprints.with_edited(texts, which, edited, kept)
    assert hashed[1] < 0.35 * hashed[0]
    assert (a == fingerprints.fingerprints(texts)).all() and (b == fingerprints.fingerprints(edited)).all()
    a, b = fingerprints.with_edited(texts, which, edited, kept, 3, 4, 7)
    assert (a == fingerprints.fingerprints(texts, 3, 4, 7)).all()
    assert (b == fingerprints.fingerprints(edited, 3, 4, 7)).all()


def test_packing_stops_when_rounds_save_nothing(spark, monkeypatch):
    """Pieces that never share a sequence are not packed again and again."""
    rounds = []
    real = packing._pack_shard
    monkeypatch.setattr(packing, "_pack_shard", lambda *a: rounds.append(a) or real(*a))
    items = spark.range(3000).selectExpr("id AS doc_id", "1500L AS length")
    got = packing.pack(items, 2048, 1000)
    assert got.select("sequence_id").distinct().count() == 3000 and len(rounds) <= 5


END = " "   # stands after each text


def plain_grams(text):
    """Hashable n-grams of one text: words, word runs, character n-grams with marked ends, repeats of word 5-grams."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    out = Counter(("w", x) for x in w)
    for k in (2, 3, 4, 5):
        out.update((f"run{k}", *w[i:i + k]) for i in range(len(w) - k + 1))
    blank = lambda c: c in " \t\n\x0b\x0c\r"
    padded = low + END
    for k in (3, 4, 5):
        for i in range(len(padded) - k + 1):
            g = padded[i:i + k]
            edges = blank(g[0]) + blank(g[-1])
            if sum(map(blank, g)) == edges < 2:
                out["char" + g.replace("\0", " ") if False else ("char", g)] += 1
    seen = Counter()
    for i in range(len(w) - 4):
        g = tuple(w[i:i + 5])
        out["seen", min(seen[g], 3)] += 1
        seen[g] += 1
    return out


def test_classifier_features_by_brute_force():
    """As many rows as n-grams, equal n-grams in one row, and (nearly always) others in others."""
    texts = ["Ünï wörds here ünï wörds", "", "a b c d e a b c d e a b c d e f", "日本語 テキスト 日本語", "x", "AbC abc\tABC\n\nabc  q"]
    buckets = 1 << 40
    doc, row = classifier.features(Texts(pa.array(texts, pa.string())), buckets)
    where = {}
    for i, text in enumerate(texts):
        want = plain_grams(text)
        got = Counter(row[doc == i].tolist())
        assert sum(got.values()) == sum(want.values()) and sorted(got.values()) == sorted(want.values())
        where[i] = set(got)
    assert len(set().union(*where.values())) == len(set().union(*(plain_grams(t) for t in texts)))


def test_classifier_sample_bounds_and_clashes(spark):
    docs = spark.createDataFrame([(i, ("good " if i % 2 else "bad ") * 50 + str(i), 0.5, "x") for i in range(40)]
                                 + [(3, "good good other text", 0.5, "y"), (None, None, 0.5, "z")],
                                 "doc_id long, text string, score double, _text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(3, 0), (5, None), (7, 9)], "doc_id long, quality int")
    for kw in ({}, {"sample": 10}, {"size": 2000}, {"size": 0}):
        model = classifier.fit(docs, labels, **kw)
        got = classifier.score(docs, model, ("doc_id", "score", "_text", "text")).collect()
        assert len(got) == 42 and all(0 <= r.score <= 1 for r in got) and {r._text for r in got} == {"x", "y", "z"}


def test_neighbours_with_all_ids_null_and_few_long_texts(spark):
    """Rows without ids are dealt by their texts, and long texts weigh by their bytes."""
    rows = [(None, f"text {i} " * (400 if i % 40 == 0 else 5)) for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    near = fingerprints.with_neighbours(docs, 8).withColumn("task", F.spark_partition_id())
    sizes = [r["n"] for r in near.filter("not stub").groupBy("task").agg(F.sum(F.octet_length("text")).alias("n")).collect()]
    ranges = fingerprints._cuts(docs.select(F.lit(-1 << 63).alias("id"), F.xxhash64("text").alias("hash"),
                                            F.octet_length("text").cast("long").alias("bytes")), 8)
    assert len(ranges[0]) == 7 and len(sizes) == 8 and max(sizes) < 0.25 * sum(sizes)
    got = fingerprints.fingerprint_documents(docs, parts=8).collect()
    assert len(got) == 1200
    order = sorted((r.hash, r.text) for r in docs.select(F.xxhash64("text").alias("hash"), "text").collect())
    follows = {t: order[(i + 1) % len(order)][1] for i, (_, t) in enumerate(order)}
    edited = Counter(hashlib.sha256((t[:len(t) - len(t) // 4] + follows[t][:len(t) // 4]).encode()).hexdigest() for _, t in rows)
    assert Counter(r.edited_sha256 for r in got) == edited
