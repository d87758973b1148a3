import random

import pytest
from llm_helpers import SCHEMA, sentence


@pytest.fixture(scope="session")
def odd_rows():
    """Documents with nulls in every column, empty, blank and very long texts, ties, repeats and near copies."""
    rng = random.Random(7)
    base = sentence(rng, 180)
    passage = sentence(rng, 60)
    edited = base.split()
    edited[20], edited[150] = "changed", "again"
    texts = [base, base, " ".join(edited), None, "", " \t\n ", "one", "one two three",
             sentence(rng, 40) + "\n" + passage + "\n" + sentence(rng, 30),
             sentence(rng, 45) + " " + passage + " " + sentence(rng, 35),
             "same line\nsame line\nother $$$ line\n\n" + sentence(rng, 25),
             sentence(rng, 6000), "x" * 3000 + " " + "Ünï😀 　漢字 don't 12345 <|endoftext|> \r\n\x0b z",
             "la la la la la " * 60, sentence(rng, 300), sentence(rng, 120)]
    rows = [(i * 3, t, ("en", "de", None)[i % 3], f"s{i % 4}" if i % 5 else None, len(t) if t else None)
            for i, t in enumerate(texts)]
    rows.append(rows[9])                                       # a repeated row
    rows.append((30, sentence(rng, 70), "en", "s1", None))     # an id that another text has
    rows.append((None, base, "en", "s2", 5))                   # no id
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def plain_rows(odd_rows):
    """The same without repeated or missing ids."""
    out = {}
    for r in odd_rows:
        if r[0] is not None:
            out.setdefault(r[0], r)
    return list(out.values())


@pytest.fixture(scope="session")
def plain_docs(spark, plain_rows):
    return spark.createDataFrame(plain_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
