"""WARC archives and the pipeline against plain Python."""
import hashlib
import io
import random
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from llm_helpers import SCHEMA, sentence, words
from pyspark.sql import functions as F
from test_words import plain_classes, plain_lines, plain_measures, plain_substrings

from fleetcast.llm import neardup, quality, warc
from fleetcast.llm.shared import Scratch

PAGES = "page_id long, url string, html string"


def pages():
    rng = random.Random(3)
    long = "<p>" + sentence(rng, 60) + "</p>"
    rows = [(i, f"https://www.Ex{i % 7}.example.com/p/{i % 5}?q=é#frag" if i % 6 else None,
             long if i % 3 == 0 else f"<b>{i}</b>" + sentence(rng, i)) for i in range(60)]
    rows += [(100, "http://a.b/\r\nWARC-Type: x", ""), (101, "not a url", None), (102, "http://a.b", "short"),
             (103, "http://a.b", "short"), (104, "http://a.b/x", "\r\n\r\n" * 40 + "é" * 30000),
             (5, "http://a.b/again", long), (0, "https://x.y/", long), (None, "http://n.n/", long),
             (105, "http://a.b/x", "\r\n\r\n" * 40 + "é" * 30000)]
    return rows


def test_round_trip(spark):
    rows = pages()
    df = spark.createDataFrame(rows, PAGES).withColumn("digest", F.lit("clash")).repartition(4)
    got = warc.round_trip(df, F.lit(1704067200) + F.col("page_id")).collect()
    late = warc.NO_ID
    first = {}
    for i, _, html in rows:
        raw = (html or "").encode()
        first[raw] = min(first.get(raw, late), late if i is None else i)
    want = Counter()
    for i, _, html in rows:
        raw = (html or "").encode()
        again = len(raw) >= 100 and first[raw] < (late if i is None else i)
        want[i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response",
             first[raw] if again else None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert sum(r.record_type == "revisit" for r in got) > 10
    got.sort(key=lambda r: r.history)
    assert [r.history for r in got] == list(range(len(rows)))
    order = [(r.url_key, r.seconds, late if r.page_id is None else r.page_id) for r in got]
    assert order == sorted(order)
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_archives_can_be_read_by_offset(spark):
    """What the index says about a record holds for the file, read without this module's reader."""
    import gzip

    rows = pages()
    with Scratch(spark, "test") as scratch:
        files = scratch.keep(warc.write_warc(spark.createDataFrame(rows, PAGES).repartition(3), scratch.path + "/w"))
        got = warc.read_warc(files, with_payload=True).collect()
        assert sum(r.records for r in files.collect()) == len(got) == len(rows)
        texts = {}
        for i, _, html in rows:
            texts.setdefault(i, set()).add((html or "").encode())
        for r in got:
            _, path = warc.file_system(r.file)
            with open(path, "rb") as f:
                f.seek(r.offset)
                data = gzip.GzipFile(fileobj=io.BytesIO(f.read(r.length))).read()
            assert data.startswith(b"WARC/1.1\r\nWARC-Type: " + r.record_type.encode())
            if r.record_type == "response":
                assert r.payload in texts[r.page_id] and data.endswith(r.payload + b"\r\n\r\n")
            else:
                assert r.payload == b"" and f"<urn:x-page:{r.refers_to}>".encode() in data


def test_damaged_archives_are_refused():
    data = zlib.compress(b"x" * 100, wbits=31)
    assert [x[:2] for x in warc.members(io.BytesIO(data + data))] == [(0, len(data)), (len(data), len(data))]
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(data + data[:-3])))


def test_loser_tree():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 7, 16):
        lists = [sorted(rng.randrange(50) for _ in range(rng.randrange(30))) for _ in range(k)]
        merged = list(warc.LoserTree(lists, lambda x: x))
        assert merged == sorted(x for run in lists for x in run)


def test_url_keys():
    assert warc.url_key("HTTP://www.Blog.Example.com/A?b#c") == "com,example,blog)/A?b"
    assert warc.url_key("https://a.b") == "b,a)/" and warc.url_key(None) == "" and warc.url_key("x") == "x"


def plain_pipeline(rows, tokenizer):
    """All five stages on a list of documents, without labels (only the base rule rejects)."""
    def base_ok(r):
        n, _, _, _, repeat = plain_measures(r[1])
        return n >= 10 and 100 * repeat <= 20 * n
    rows = [r for r in rows if base_ok(r)]
    texts = {(r[0], r[1]): r for r in rows}
    cleaned = []
    for r, out in zip(rows, [next(iter(plain_lines_of(r, rows))) for r in rows]):
        cleaned.append((r[0], out, *r[2:]))
    label = plain_classes(cleaned)
    rows = [r for r in cleaned if label[r[0]] == r[0]]
    kept = []
    spans = {}
    for d, n, gone, text in plain_substrings(rows).elements():
        spans[d] = (n, gone, text)
    for r in rows:
        n, gone, text = spans[r[0]]
        if gone == 0:
            kept.append(r[:2])
        elif gone < n:
            kept.append((r[0], text))
    want = Counter()
    for d, text in kept:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for p in range(0, len(ids), 2048):
            part = ids[p:p + 2048]
            want[d, p // 2048, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    return want, texts


def plain_lines_of(row, rows):
    return [text for d, text, *_ in plain_lines(rows) if d == row[0]]


def corpus(plain_rows):
    rng = random.Random(12)
    rows = list(plain_rows)
    passage = sentence(rng, 70)
    for i in range(120):
        body = [sentence(rng, 30) for _ in range(4)]
        if i % 5 == 0:
            body.insert(rng.randrange(4), passage)
        if i % 2:
            body.append("All rights reserved, see the site for terms.")
        text = "\n".join(body)
        if i % 6 == 3:  # a near copy of the row before the last
            w = rows[-2][1].split(" ")
            w[rng.randrange(len(w))] = "edited"
            text = " ".join(w)
        rows.append((500 + i, text, "en", f"site{i % 11}", len(text)))
    return rows


def test_pipeline_by_brute_force(spark, tmp_dir, plain_rows):
    from tokenizers import Tokenizer
    public_tokenizers = pytest.importorskip("public_tokenizers")
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.no_padding()
    t.no_truncation()
    rows = corpus(plain_rows)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    want, _ = plain_pipeline(rows, t)
    got = corpus_pipeline.run(spark, tmp_dir).collect()
    assert Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in got) == want
    assert len({r.doc_id for r in got}) < len(rows) - 15
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in x) <= 2048 for x in by.values())


def test_stages_keep_columns_and_take_anything(spark, tmp_dir, odd_docs, odd_rows, no_docs):
    """Odd rows, clashing columns and empty tables go through every stage; all but the last keep the columns."""
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    clash = odd_docs
    for c in ("row", "hash", "id", "key", "n", "least", "label", "spans", "parts", "wide", "drop", "first", "h1", "site",
              "all", "new", "own", "shard", "gap", "_text", "n_words", "kept"):
        clash = clash.withColumn(c, F.lit("x"))
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, tmp_dir).count() == 0
        out = stage(spark, clash, tmp_dir)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == clash.columns, name
            got = out.collect()
            assert all(r[c] == "x" for r in got for c in ("row", "hash", "all", "n_words"))
            assert 0 < len(got) <= len(odd_rows)


def test_one_document_of_each_class_stays(spark, odd_docs, odd_rows):
    label = plain_classes(odd_rows)
    got = [r.doc_id for r in neardup.stage(spark, odd_docs, "").collect()]
    assert sorted(i for i in got if i is not None) == sorted(i for i, c in label.items() if i == c)
    assert got.count(None) == 1


def test_rejected_documents_go(spark, tmp_dir, odd_docs, odd_rows):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    kept = quality.stage(spark, odd_docs, tmp_dir).collect()
    want = [r for r in odd_rows if len(words(r[1])) >= 10
            and 100 * plain_measures(r[1])[4] <= 20 * plain_measures(r[1])[0]]
    assert Counter(tuple(r) for r in kept) == Counter(want)
