import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from llm_helpers import SCHEMA, words
from pyspark.sql import functions as F

from fleetcast.llm import audit, sharding, trie
from fleetcast.llm.shared import Scratch

# ---------------------------------------------------------------- sharding


def plain_capacity(sizes, n):
    """The smallest capacity by trying all sums of runs of groups."""
    upto = [0, *np.cumsum(sizes).tolist()]
    for c in sorted({b - a for i, a in enumerate(upto) for b in upto[i:]}):
        pos = 0
        for _ in range(n):
            pos = max(x for x in upto if x <= pos + c)
        if pos == upto[-1]:
            return c


def places_of(sizes, points):
    upto = np.cumsum(sizes)
    asked = []

    def split(edges):
        asked.append(sum(len(e) - 1 for e in edges))
        out = []
        for e in edges:
            for a, b in zip(e, e[1:]):
                v = upto[(upto > a) & (upto <= b)]
                if len(v):
                    out.append((len(v), v.min(), v.max()))
        return np.array(out, np.int64).reshape(-1, 3)

    return sharding.Places(int(upto[-1]) if len(upto) else 0, split, points), asked


@pytest.mark.parametrize("seed", range(12))
def test_minimax_search_is_exact_with_few_known_places(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 3, 16, 17, 40, 900]) + rng.randrange(5) for _ in range(rng.randrange(1, 150))]
    if seed % 3 == 0:
        sizes.insert(rng.randrange(len(sizes)), sum(sizes) // 2)   # a group with a third of all
    n = rng.choice([1, 2, 5, 40])
    places, asked = places_of(sizes, 8)
    capacity, cuts = sharding.minimax_cuts(places, n)
    assert max(asked, default=0) <= 16
    assert capacity == plain_capacity(sizes, n)
    upto = np.cumsum(sizes)
    assert len(cuts) == n - 1 and set(cuts) <= {0, *upto.tolist()} and cuts == sorted(cuts)
    assert max(np.diff([0, *cuts, upto[-1]])) <= capacity


def test_shards_keep_texts_together_and_slots_gapless(spark, odd_docs, odd_rows):
    got = sharding.shard(odd_docs.withColumn("shard", F.lit("x")).withColumn("digest", F.lit(1)), 5).collect()
    size = lambda t: len((t or "").encode()) + 16
    crc = lambda t: zlib.crc32((t or "").encode())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (i, size(t), crc(t)) for i, t, *_ in odd_rows)
    where, slots, load = defaultdict(set), defaultdict(list), Counter()
    for r in got:
        where[r["text_crc32"], r["size"]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
    assert all(len(s) == 1 for s in where.values()) and set(slots) <= set(range(5))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = defaultdict(int)
    for i, t, *_ in odd_rows:
        groups[hashlib.md5((t or "").encode()).digest()] += size(t)
    assert max(load.values()) <= plain_capacity([groups[g] for g in sorted(groups)], 5)


def test_shards_of_copies_over_many_ranges_and_of_nothing(spark, no_docs):
    rows = [(i, "copy" if i % 3 else f"text {i}", None, None, None) for i in range(900)]
    got = sharding.shard(spark.createDataFrame(rows, SCHEMA).repartition(6), 7).toPandas()
    texts = {i: t for i, t, *_ in rows}
    assert got[got.doc_id.map(texts) == "copy"].shard.nunique() == 1
    assert sorted(got.groupby("shard").slot.apply(lambda s: (sorted(s) == list(range(len(s))))).unique()) == [True]
    assert sharding.shard(no_docs, 4).count() == 0


# ---------------------------------------------------------------- audit


def plain_audit(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    docs = []
    for i, text, _, source, _ in rows:
        text = text or ""
        w = words(text)
        fails = set()
        if len(w) < 50:
            fails.add("A")
        if 100 * len(set(w)) < 65 * len(w):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text):
            fails.add("C")
        if re.search("[#$%&*|]", text):
            fails.add("D")
        if i is not None and any(j is not None and j < i and (t or "") == text for j, t, *_ in rows):
            fails.add("E")
        docs.append((source or "", fails, i in good, i in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        mine, shapley = [d for d in docs if d[0] == part], Counter()
        for order in permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                before = set(order[:step - 1])
                gone = [d for d in mine if f in d[1] and not d[1] & before]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    sum(not d[1] & (before | {f}) for d in mine), len(gone),
                    sum(f in d[1] and bool(d[1] & before) for d in mine), sum(d[1] == {f} for d in mine),
                    sum(d[2] for d in gone), sum(d[3] for d in gone)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audited(spark, docs, labels):
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = audit.interactions(audit.combinations(docs, labels)).collect()
    out = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in COUNTS] for r in got}
    assert len(out) == len(got)
    return out


def test_audit_by_brute_force(spark, odd_docs, odd_rows):
    labels = [(0, 1, 0), (0, 0, 1), (3, 1, None), (27, None, 1), (30, 0, 1), (None, 1, 1), (999, 1, 1)]
    more = odd_docs.withColumns({"part": F.lit("x"), "h1": F.lit(1), "bits": F.lit("b")})
    assert audited(spark, more, labels) == plain_audit(odd_rows, labels)


def test_audit_of_a_hot_text_and_of_equal_hashes(spark, monkeypatch):
    """One text on most rows is dealt over salts; texts that share a hash are still told apart."""
    monkeypatch.setattr(audit, "SALT_ROWS", 10)
    rows = [(i, "COPY" if i % 4 else ("TWIN" if i % 8 else f"text {i}"), None, f"s{i % 3}", None) for i in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert audited(spark, docs, [(1, 1, 1)]) == plain_audit(rows, [(1, 1, 1)])
    texts = docs.select("doc_id", F.col("source").alias("part"), F.lit(1).cast("long").alias("h1"),
                        F.lit(2).cast("long").alias("h2"), "text")
    with Scratch(spark, "test") as scratch:
        found = {r["doc_id"] for r in audit.later_copies(texts, texts.drop("text"), scratch).collect()}
    seen, want = set(), set()
    for i, t, *_ in rows:
        if t in seen:
            want.add(i)
        seen.add(t)
    assert found == want


def test_audit_of_nothing(spark, no_docs):
    assert audited(spark, no_docs, []) == {}


# ---------------------------------------------------------------- trie


def plain_trie(rows):
    own = defaultdict(list)
    mark = lambda r, t: hashlib.md5(f"{len(r)}:{r}{t}".encode()).digest()
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, mark(role, text), role, text))
    for turns in own.values():
        turns.sort()
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        built[c] = [t[3:] for t in own.get(base, [])[:h]] + [t[3:] for t in turns[h:]]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    nodes = sorted(members)
    out = {}
    for v in nodes:
        below = [u for u in nodes if u[:len(v)] == v]
        kids = [u for u in below if len(u) == len(v) + 1]
        inner = {u[:-1] for u in nodes if u}
        ends = ",".join(str(c) for c in sorted(c for c in members[v] if len(built[c]) == len(v)))
        out[min(members[v]), len(v)] = (
            min(members[v[:-1]]) if v else None, len(members[v]), len(kids), sum(u not in inner for u in below),
            sum((len(members[u]) - 1) * len(u[-1][1]) for u in below if u), hashlib.sha256(ends.encode()).hexdigest())
    return out


def run_trie(spark, df):
    with Scratch(spark, "test") as scratch:
        rows, ids = trie.rebuild(trie.narrow_turns(df), scratch.keep)
        nodes, lists = trie.prefix_trie(rows, ids, scratch)
        got = nodes.join(trie.ends_digest(lists), trie.PREFIX, "left").collect()
    none = hashlib.sha256(b"").hexdigest()
    out = {(r["conv_id"], r["depth"]): (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"],
                                        r["saved_tokens"], r["ends_sha256"] or none) for r in got}
    assert len(out) == len(got)
    return out


TURNS = "conv_id long, turn long, role string, text string"


def test_trie_by_brute_force(spark):
    rng = random.Random(5)
    texts = ["", "a", "bb", "ü😀", None]
    rows = [(c, t if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None]), rng.choice(texts))
            for c in [*range(0, 40), *range(95, 130), 250, 251, 252, -3, -100, 1 << 40]
            for t in range(rng.randrange(1, 5))]
    rows += [(7, 0, "user", "a")] * 2 + [(None, 0, "user", "lost"), (255, None, None, None)]
    df = spark.createDataFrame(rows, TURNS).withColumns({"depth": F.lit("x"), "p1": F.lit(1), "digest": F.lit(2)})
    assert run_trie(spark, df.repartition(3)) == plain_trie(rows)


def test_trie_of_one_very_long_conversation_and_many_copies(spark):
    rows = [(100, t, "user", f"t{t % 50}") for t in range(1500)]
    rows += [(c, t, "user", f"same {t}") for c in range(300, 700) for t in range(3)]
    got = run_trie(spark, spark.createDataFrame(rows, TURNS).repartition(6))
    own = plain_trie([r for r in rows if r[0] != 100])   # the long one has no base besides itself
    assert max(d for _, d in got) == 1500 and got[100, 0][1] == 401
    for key, value in own.items():
        if key[1]:
            assert got[key][1:] == value[1:]
    # The plain loop over all prefixes of the long one is a chain.
    assert all(got[100, d] == (100, 1, int(d < 1500), 1, 0, got[100, d][5]) for d in range(1, 1501))


def test_trie_parents_by_lookup_and_by_broadcast(spark, monkeypatch):
    rows = [(c, t, "user", f"{t} {c if t else c % 4}") for c in range(800) for t in range(2)]
    want = plain_trie(rows)
    df = spark.createDataFrame(rows, TURNS)
    assert run_trie(spark, df) == want
    monkeypatch.setattr(trie, "HOT_PARENTS", 1)
    assert run_trie(spark, df) == want


def test_trie_of_nothing(spark):
    assert run_trie(spark, spark.createDataFrame([], TURNS)) == {}
