"""Byte-pair encoding by speculation and verification (operator 7).

For the distinct pre-tokens of a slice at once: a greedy longest match over the
vocabulary proposes tokens; a vectorised check tests every adjacent pair of
them; pre-tokens with a failing pair are merged exactly, lowest rank first.

A proposal whose adjacent pairs are all compatible is the encoding: two
neighbouring tokens are compatible if merging the bytes of both gives the same
two tokens, which only needs a walk back through the merges that made them.

Tokenizer files are those of the ``tokenizers`` library, by path.  Two
pre-tokenizers are known: the byte-level one with an optional space in front,
and the one that splits a lower-cased text and drops white space.  Character
classes and lower case come from the library itself, so they are its own for
every code point.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textarrays import Ranges, runs, slices, spread

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0
WORDS = 1 << 19  # distinct pre-tokens to remember
LONG = 256  # units; longer pre-tokens are merged with a heap
PAIR = 1 << 20
BIG = 1 << 30
OPEN_SPACE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LOWER_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class IntMap:
    """Many lookups at once from non-negative integers to int32 (-1: absent)."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, room: int = 0, spare: int = 2):
        """``room``: keys that will be put in all, if more are to come; ``spare``: doublings of the places."""
        bits = max(4, max(len(keys), room).bit_length() + spare)
        self._shift = np.uint64(64 - bits)
        self._keys = np.full(1 << bits, -1, np.int64)
        self._values = np.full(1 << bits, -1, np.int32)
        self._mask = (1 << bits) - 1
        self.put(keys, values)

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Adds keys that are not there yet and differ from each other."""
        slot = self._slot(keys)
        while len(keys):
            free = self._keys[slot] == -1
            self._keys[slot[free]] = keys[free]
            won = self._keys[slot] == keys
            self._values[slot[won]] = values[won]
            keys, values, slot = keys[~won], values[~won], (slot[~won] + 1) & self._mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        there = self._keys[slot]
        out = np.where(there == keys, self._values[slot], np.int32(-1))
        todo = np.flatnonzero((there != keys) & (there != -1))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self._mask
            there = self._keys[slot[todo]]
            hit = there == keys[todo]
            out[todo[hit]] = self._values[slot[todo[hit]]]
            todo = todo[~hit & (there != -1)]
        return out


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in vocabulary files."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


_CLASSES: dict[str, np.ndarray] = {}


def _all_characters() -> tuple[np.ndarray, str]:
    # Behind 0x34000 there are neither letters, numbers, white space nor capitals.
    points = np.concatenate((np.arange(0xD800), np.arange(0xE000, 0x34000)))
    return points, points.astype("<u4").tobytes().decode("utf-32-le")


def character_classes() -> np.ndarray:
    """LETTER, NUMBER, SPACE or OTHER for every code point, by the library's regular expressions."""
    if "class" not in _CLASSES:
        from tokenizers import Regex
        from tokenizers.pre_tokenizers import Split

        points, text = _all_characters()
        out = np.zeros(0x110000, np.uint8)
        for kind, name in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
            inside = np.ones(len(points), bool)
            for _, (a, b) in Split(Regex(name), "removed").pre_tokenize_str(text):
                inside[a:b] = False
            out[points[inside]] = kind
        _CLASSES["class"] = out
    return _CLASSES["class"]


def lower_table() -> np.ndarray:
    """Lower case of every code point; U+0130, which becomes two, is left out."""
    if "lower" not in _CLASSES:
        from tokenizers.normalizers import Lowercase

        points, text = _all_characters()
        low = np.frombuffer(Lowercase().normalize_str(text.replace("İ", "ı")).encode("utf-32-le"), "<u4")
        assert len(low) == len(points)
        out = np.arange(0x110000, dtype=np.uint32)
        out[points] = low
        _CLASSES["lower"] = out
    return _CLASSES["lower"]


def _composed(text: str) -> str:
    """NFC; only texts with characters that it may change go through the library."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    odd = points >= 0x300
    if odd.any():
        p = points[odd]
        same = ((p >= 0x2010) & (p <= 0x205E)) | ((p >= 0x4E00) & (p <= 0x9FFF)) | ((p >= 0x1F300) & (p <= 0x1F5FF))
        if not same.all():
            from tokenizers.normalizers import NFC

            return NFC().normalize_str(text)
    return text


class Encoder:
    """A byte-pair vocabulary as arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pre = json.dumps(spec["pre_tokenizer"])
        self.lower = bool(spec["normalizer"])
        suffix = model["end_of_word_suffix"] or ""
        if model["type"] != "BPE" or (json.dumps(LOWER_PATTERN) not in pre if self.lower else
                                      spec["pre_tokenizer"]["type"] != "ByteLevel"):
            raise ValueError(f"{path}: not one of the two known kinds of tokenizer")
        letters = byte_letters()
        n = max(max(vocab.values()), *self.special.values()) + 1
        self.unit = np.array([vocab[letters[b]] for b in range(256)]
                             + ([vocab[letters[b] + suffix] for b in range(256)] if suffix else []))
        self.suffix = bool(suffix)
        pieces: list[tuple[int, ...]] = [()] * n
        for i, t in enumerate(self.unit):
            pieces[t] = (i,)
        self.left, self.right = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        made = []
        for m in model["merges"]:
            a, b = m if isinstance(m, list) else m.split(" ")
            x, y = vocab[a], vocab[b]
            z = vocab[a + b]
            self.left[z], self.right[z] = x, y
            pieces[z] = pieces[x] + pieces[y]
            made.append(z)
        made = np.array(made)
        if (np.diff(made) <= 0).any() or self.unit.max() >= made[0]:
            raise ValueError(f"{path}: ids do not follow the ranks of the merges")
        self.first_merge = int(made[0])
        self.merges = IntMap(self.left[made] * PAIR + self.right[made], made.astype(np.int32))
        # Tokens that their own bytes would not give are never proposed.
        good = np.zeros(n, bool)
        good[self.unit] = True
        good[made] = self.compatible(self.left[made], self.right[made], made)
        edges: dict[int, int] = {}
        ends = [-1]
        for t in [*self.unit.tolist(), *made[good[made]].tolist()]:
            node = 0
            for u in pieces[t]:
                key = node * 512 + u
                node = edges.setdefault(key, len(ends))
                if node == len(ends):
                    ends.append(-1)
            ends[node] = t
        self.edges = IntMap(np.fromiter(edges.keys(), np.int64, len(edges)),
                            np.fromiter(edges.values(), np.int32, len(edges)))
        self.ends = np.array(ends, np.int64)
        # Bytes of each token, for decoding; special tokens stand for their own text.
        size = np.array([len(p) for p in pieces])
        raw = [bytes(u & 255 for u in p) for p in pieces]
        for text, t in self.special.items():
            raw[t] = text.encode()
            size[t] = len(raw[t])
        self.byte_size = size
        self.byte_start = np.concatenate(([0], np.cumsum(size)[:-1]))
        self.byte_pool = np.frombuffer(b"".join(raw), np.uint8)
        self._known: IntMap | None = None

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether neighbours a[i], b[i] stay apart when their bytes are merged.

        Walks back in time: the token made last is split, and the pieces now in
        touch must not have merged before that; equal merges go left first.
        """
        ok = np.ones(len(a), bool)
        live = np.arange(len(a))
        a, b = a.astype(np.int64), b.astype(np.int64)
        limit = np.full(len(a), BIG) if limit is None else limit.astype(np.int64)
        while len(live):
            joined = self.merges.get(a * PAIR + b)
            bad = (joined >= 0) & (joined < limit)
            ok[live[bad]] = False
            go = ~bad & ((a >= self.first_merge) | (b >= self.first_merge))
            live, a, b = live[go], a[go], b[go]
            from_left = a > b
            limit = np.where(from_left, a, b + 1)
            a, b = np.where(from_left, self.right[a], a), np.where(from_left, b, self.left[b])
        return ok

    def _propose(self, units: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, token) in order of words by greedy longest match."""
        words, tokens, steps = [], [], []
        live = np.arange(len(start))
        pos = start.copy()
        step = 0
        while len(live):
            best_end, best = pos.copy(), np.full(len(live), -1, np.int64)
            at, node, cur = np.arange(len(live)), np.zeros(len(live), np.int64), pos.copy()
            stop = end[live]
            while len(at):
                node = self.edges.get(node * 512 + units[cur]).astype(np.int64)
                on = node >= 0
                at, node, cur = at[on], node[on], cur[on] + 1
                token = self.ends[node]
                is_end = token >= 0
                best[at[is_end]] = token[is_end]
                best_end[at[is_end]] = cur[is_end]
                on = cur < stop[at]
                at, node, cur = at[on], node[on], cur[on]
            words.append(live)
            tokens.append(best)
            steps.append(np.full(len(live), step))
            step += 1
            on = best_end < stop
            live, pos = live[on], best_end[on]
        words, tokens, steps = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (words, tokens, steps))
        order = np.argsort(words * (step + 1) + steps)
        return words[order], tokens[order]

    def _merge(self, words: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, token) after exact merging of (word, symbol) rows, all words in step."""
        done_w, done_t = [], []
        while len(words):
            joined = np.full(len(words), BIG)
            near = np.flatnonzero(words[1:] == words[:-1])
            got = self.merges.get(symbols[near] * PAIR + symbols[near + 1])
            joined[near[got >= 0]] = got[got >= 0]
            edge = runs(words)
            low = np.minimum.reduceat(joined, edge[:-1])
            each = np.repeat(low, np.diff(edge))
            over = each == BIG
            done_w.append(words[over])
            done_t.append(symbols[over])
            # The first place of the lowest rank in each word that goes on.
            hit = np.flatnonzero((joined == each) & ~over)
            hit = hit[np.concatenate(([True], words[hit[1:]] != words[hit[:-1]]))] if len(hit) else hit
            symbols = symbols.copy()
            symbols[hit] = joined[hit]
            keep = ~over
            keep[hit + 1] = False
            words, symbols = words[keep], symbols[keep]
        words, tokens = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (done_w, done_t))
        order = np.argsort(words, kind="stable")
        return words[order], tokens[order]

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """Exact merging of one long word with a heap."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def offer(i: int) -> None:
            j = after[i]
            if j < n:
                m = int(self.merges.get(np.array([symbols[i] * PAIR + symbols[j]]))[0])
                if m >= 0:
                    heapq.heappush(heap, (m, i, symbols[i], symbols[j]))

        pairs = np.array(symbols, np.int64)
        first = self.merges.get(pairs[:-1] * PAIR + pairs[1:])
        heap = [(int(first[i]), int(i), symbols[i], symbols[i + 1]) for i in np.flatnonzero(first >= 0)]
        heapq.heapify(heap)
        while heap:
            m, i, x, y = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != x or j >= n or symbols[j] != y:
                continue
            symbols[i], symbols[j] = m, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [s for s in symbols if s >= 0]

    def encode_words(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pre-tokens data[start:end], one after another, and how many each has.

        Pre-tokens are known by 126 bits of their hashes; those of earlier slices
        are remembered, up to WORDS of them.
        """
        if not len(start):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        raised = data.astype(np.uint64) + np.uint64(1)
        h1 = (Ranges(raised, 0).of(start, end) >> np.uint64(1)).view(np.int64)
        h2 = Ranges(raised, 1).of(start, end)
        if self._known is None or len(self._second) > WORDS:
            self._known = IntMap(np.zeros(0, np.int64), np.zeros(0, np.int32), 2 * WORDS)
            self._second = np.zeros(0, np.uint64)
            self._pool, self._first, self._count = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        kind = self._known.get(h1).astype(np.int64)
        new = kind < 0
        if len(self._second):
            new |= self._second[kind] != h2  # (a word whose first hash is taken is encoded anew each time)
        todo = np.flatnonzero(new)
        if len(todo):
            order = todo[np.argsort(h1[todo])]
            a, b = h1[order], h2[order]
            head = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
            one = order[head]
            number = len(self._second)
            kind[order] = number + np.cumsum(head) - 1
            tokens, count = self._encode_distinct(data, start[one], end[one])
            self._first = np.concatenate((self._first, len(self._pool) + np.cumsum(count) - count))
            self._count = np.concatenate((self._count, count))
            self._pool = np.concatenate((self._pool, tokens.astype(np.int32)))
            self._second = np.concatenate((self._second, h2[one]))
            fresh = (self._known.get(h1[one]) < 0) & np.concatenate(([True], h1[one][1:] != h1[one][:-1]))
            self._known.put(h1[one][fresh], (number + np.flatnonzero(fresh)).astype(np.int32))
        count = self._count[kind]
        return self._pool[spread(self._first[kind], count)], count

    def _encode_distinct(self, data: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = e - s
        at = np.concatenate(([0], np.cumsum(size)))
        units = data[spread(s, size)].astype(np.int64)
        if self.suffix:
            units[at[1:] - 1] += 256
        short = np.flatnonzero(size <= LONG)
        w, t = self._propose(units, at[short], at[short + 1])
        w = short[w]
        near = np.flatnonzero(w[1:] == w[:-1])
        pairs, back = np.unique(t[near] * PAIR + t[near + 1], return_inverse=True)
        fits = self.compatible(pairs // PAIR, pairs % PAIR)[back]
        fails = np.zeros(len(s), bool)
        fails[w[near[~fits]]] = True
        ok = ~fails[w]
        w, t = w[ok], t[ok]
        redo = np.flatnonzero(fails)
        rw, rt = self._merge(np.repeat(redo, size[redo]), self.unit[units[spread(at[redo], size[redo])]])
        parts = [(w, t), (rw, rt)]
        for i in np.flatnonzero(size > LONG):
            got = self._merge_long(self.unit[units[at[i]:at[i + 1]]].tolist())
            parts.append((np.full(len(got), i), np.array(got, np.int64)))
        w = np.concatenate([p[0] for p in parts])
        order = np.argsort(w, kind="stable")
        t = np.concatenate([p[1] for p in parts])[order]
        return t, np.bincount(w, minlength=len(s))

    def _segments(self, texts: list[str]) -> tuple[list[str], list[int], list[int]]:
        """Texts cut at special tokens: the pieces, their text, and the special id behind each (-1: none)."""
        pieces, owner, behind = [], [], []
        for i, text in enumerate(texts):
            rest = text
            while any(s in rest for s in self.special):
                at, s = min((rest.find(s), s) for s in self.special if s in rest)
                pieces.append(rest[:at])
                owner.append(i)
                behind.append(self.special[s])
                rest = rest[at + len(s):]
            pieces.append(rest)
            owner.append(i)
            behind.append(-1)
        return pieces, owner, behind

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each has."""
        pieces, owner, behind = self._segments(texts)
        if self.lower:
            pieces = [_composed(p).replace("İ", "i̇") for p in pieces]
        lengths = np.array([len(p) for p in pieces], np.int64)
        points = np.frombuffer("".join(pieces).encode("utf-32-le"), "<u4")
        if self.lower:
            points = lower_table()[points]
        start, end = pre_tokens(points, lengths, self.lower)
        width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        place = np.concatenate(([0], np.cumsum(width)))
        text = points.astype("<u4").tobytes().decode("utf-32-le").encode()
        ids, count = self.encode_words(np.frombuffer(text, np.uint8), place[start], place[end])
        piece = np.searchsorted(np.cumsum(lengths), start, "right")
        owner, behind = np.array(owner, np.int64), np.array(behind, np.int64)
        n_piece = np.bincount(piece, count, len(pieces)).astype(np.int64)
        if (behind >= 0).any():
            ids = np.insert(ids, np.cumsum(n_piece)[behind >= 0], behind[behind >= 0])
            n_piece += behind >= 0
        return ids, np.bincount(owner, n_piece, len(texts)).astype(np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids."""
        return self.byte_pool[spread(self.byte_start[ids], self.byte_size[ids])].tobytes()


def pre_tokens(points: np.ndarray, lengths: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (code points) of the pre-tokens of texts that stand one after another."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = character_classes()[points]
    fresh = np.zeros(n + 1, bool)
    ends = np.cumsum(lengths)
    fresh[np.concatenate(([0], ends))] = True       # where a text starts
    cut = fresh.copy()
    cut[1:n] |= kind[1:] != kind[:-1]
    run = np.flatnonzero(cut)
    start, end = run[:-1], run[1:]
    of = kind[start]
    size = end - start
    goes_on = ~fresh[end]                            # the next run is in the same text
    attached = np.zeros(len(start), bool)
    if lower:
        cut[:n] |= kind == NUMBER
    else:
        space = (of == SPACE) & goes_on
        cut[end[space] - 1] = True
        joins = space & (points[end - 1] == 0x20)
        cut[end[joins]] = False
        attached[1:] = joins[:-1]
    # Contractions: one apostrophe that starts a match, and the letters behind it.
    quote = np.flatnonzero((of == OTHER) & (size == 1) & (points[start] == 0x27) & goes_on & ~attached)
    if len(quote):
        nxt = quote + 1
        ok = of[nxt] == LETTER
        quote, nxt = quote[ok], nxt[ok]
        a = points[start[nxt]]
        b = np.where(size[nxt] > 1, points[np.minimum(start[nxt] + 1, n - 1)], 0)
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) \
            | ((a == ord("l")) & (b == ord("l")))
        take = np.where(one, 1, np.where(two, 2, 0))
        on = take > 0
        cut[start[nxt[on]]] = False
        cut[start[nxt[on]] + take[on]] = True
    at = np.flatnonzero(cut)
    start, end = at[:-1], at[1:]
    if lower:
        keep = kind[start] != SPACE
        start, end = start[keep], end[keep]
    return start, end


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a tokenizer file, made once a process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode_slices(batch: pa.RecordBatch, enc: Encoder, column: str = "text"):
    """(slice of the batch, ids of its texts, number of ids of each text)."""
    for part in slices(batch, column):
        texts = part.column(column).fill_null("").to_pylist()
        yield (part, *enc.encode(texts))


def encode_texts(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), digests: bool = False) -> DataFrame:
    """``keep`` columns with ``ids`` array<int> of each row's whole text, and ``decoded``, the text of these ids.

    With ``digests``, their number and SHA-256 instead (n_tokens, ids_sha256 of
    little-endian unsigned 32-bit ids, decoded_sha256 of UTF-8).  Null texts are
    empty; each row stands for itself, repeated ones too; the text column itself
    may be among ``keep``.
    """
    src = docs.select(*keep, F.col("text").alias("_text"))
    more = ["n_tokens long", "ids_sha256 string", "decoded_sha256 string"] if digests \
        else ["ids array<int>", "decoded string"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != "_text"] + more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            for part, ids, count in encode_slices(batch, enc, "_text"):
                edge = np.concatenate(([0], np.cumsum(count)))
                byte_edge = np.concatenate(([0], np.cumsum(enc.byte_size[ids])))[edge]
                raw = memoryview(enc.decode(ids))
                decoded = [str(raw[a:b], "utf-8", "replace") for a, b in zip(byte_edge[:-1], byte_edge[1:])]
                if digests:
                    flat = memoryview(ids.astype("<u4").tobytes())
                    out = [pa.array(count),
                           pa.array([hashlib.sha256(flat[4 * a:4 * b]).hexdigest()
                                     for a, b in zip(edge[:-1], edge[1:])], pa.string()),
                           pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string())]
                else:
                    out = [pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(ids.astype(np.int32))),
                           pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in keep] + out, [*keep, *(m.split(" ")[0] for m in more)])

    return src.mapInArrow(run, schema)


def op7_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode_texts(docs, public_tokenizers.path("byte_bpe_50k.json"), digests=True)
