"""Filter interaction audit by an existential self-join (operator 12).

Documents that fail E, identical to a text with a smaller doc_id, are marked by
a left-semi join on hash, exact text and smaller doc_id.  Their ids are united
with the ids that fail the other filters, and the bits of each id are combined.
What any order of the filters removes then follows from the number of documents
in each of a part's 32 combinations.

Hashes are counted before any text moves.  Texts are dealt once, by hash and, for
a hash on a large share of all rows, by a salt; copies meet the first holders of
their hash where they lie.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Scratch

FILTERS = "ABCDE"
BLANKS = r"[ \t\n\x0B\f\r]+"   # between words
HOT_TEXTS = 4096               # at most so many hashes are on a share of 1/HOT_TEXTS of all rows or more
SALT_ROWS = 256                # copies of such a text for each of its salts
MOST_SALTS = 1 << 16           # of one text, and so the rows that stand for it

KEY = ["h1", "h2"]


def own_failures(text: Column) -> Column:
    """Bits 1, 2, 4, 8 of filters A to D for a text that is not null."""
    words = F.filter(F.split(text, BLANKS), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    failed = [n < 50, 100 * distinct < 65 * n, 100 * capitals > 5 * F.char_length(text), text.rlike("[#$%&*|]")]
    return sum((F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(failed)), F.lit(0))


def later_copies(texts: DataFrame, narrow: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, part, h1, h2 of all rows whose text a smaller doc_id has too.

    ``texts`` has doc_id, part, h1, h2 and text (not null), ``narrow`` the same
    rows without text.  Null doc_ids are neither smaller nor larger than others;
    rows of one doc_id are no copies of each other.
    """
    repeated = scratch.keep(narrow.filter("doc_id is not null").groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
        .filter("lo < hi").select(*KEY, "n"))
    hot = F.col("n") * HOT_TEXTS >= narrow.count()
    salts = F.when(hot, F.least(F.lit(MOST_SALTS), F.ceil(F.col("n") / SALT_ROWS)).cast("int")).otherwise(F.lit(1))
    salted = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    # Few by counting, so they are broadcast; all other hashes have a small share of the rows each.
    few = F.broadcast(repeated.filter(hot).select(*KEY, salts.alias("spread")))
    dealt = texts.filter("doc_id is not null").join(few, KEY, "left").withColumn(
        "salt", F.coalesce(F.pmod(F.xxhash64("doc_id"), "spread"), F.lit(0)).cast("int")).drop("spread")
    copies = dealt.join(repeated.select(*KEY, salts.alias("salts")).select(*KEY, "salts", salted), [*KEY, "salt"])
    # Each distinct text of a hash with its smallest doc_id: in a salt first, where it lies, then of all.
    firsts = copies.groupBy(*KEY, "salt", "text", "salts").agg(F.min(F.struct("doc_id", "part")).alias("first")) \
        .groupBy(*KEY, "text", "salts").agg(F.min("first").alias("first")) \
        .select(*KEY, F.col("text").alias("first_text"), "first", salted)
    # Two bounds, not "=": the text is a condition on pairs, not one more key to deal the copies by.
    same_text = (F.col("text") >= F.col("first_text")) & (F.col("text") <= F.col("first_text"))
    a, b = copies.alias("a"), firsts.alias("b")
    on = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in (*KEY, "salt")]
    return a.join(b, [*on, same_text, F.col("b.first.doc_id") < F.col("a.doc_id")], "left_semi") \
        .select("doc_id", "part", *KEY)


def combinations(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """part, bits, n, good, toxic: documents of each part by the filters they fail (bit 1 is A, 16 is E).

    ``docs`` needs doc_id, text and the column ``part``; other columns are not
    read.  Null texts and null parts are empty strings.  Repeated rows count each
    time.  A document is good (toxic) if a row of ``labels`` with its doc_id has
    quality (toxic) 1; repeated labels count once, null ids have none.
    """
    text = F.coalesce("text", F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
                        text.alias("text")).select(
        "doc_id", "part", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"), "text")
    with Scratch(docs.sparkSession, "audit") as scratch:
        narrow = scratch.keep(texts.select("doc_id", "part", *KEY, own_failures(F.col("text")).alias("bits")))
        copies = later_copies(texts, narrow.drop("bits"), scratch)
        marks = narrow.withColumn("n", F.lit(1)).unionByName(
            copies.withColumns({"bits": F.lit(1 << FILTERS.index("E")), "n": F.lit(0)}))
        by_id = marks.groupBy("doc_id", "part", *KEY).agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n")) \
            .groupBy("doc_id", "part", "bits").agg(F.sum("n").alias("n"))
        marked = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
            *[F.max(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0))).alias(c) for c in ("quality", "toxic")])
        counted = [F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(a)
                   for c, a in (("quality", "good"), ("toxic", "toxic"))]
        return by_id.join(marked, "doc_id", "left").groupBy("part", "bits").agg(F.sum("n").alias("n"), *counted) \
            .checkpoint()


def interactions(combos: DataFrame) -> DataFrame:
    """What every filter does at every step of every order, for each part of ``combinations``."""
    cells = combos.groupBy("part").agg(F.collect_list(F.struct("bits", "n", "good", "toxic")).alias("cells"))  # 32 most
    orders = ",".join("".join(p) for p in permutations(FILTERS))
    steps = cells.withColumn("filter_order", F.explode(F.split(F.lit(orders), ","))) \
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    bit = f"shiftleft(1, instr('{FILTERS}', {{}}) - 1)"
    steps = steps.withColumn("own", F.expr(bit.format("substr(filter_order, step, 1)"))).withColumn("before", F.expr(
        f"aggregate(sequence(1, step), 0, (m, i) -> if(i < step, m | {bit.format('substr(filter_order, i, 1)')}, m))"))

    def total(which, value=lambda c: c["n"]):
        return F.aggregate(F.filter("cells", lambda c: which(c["bits"])), F.lit(0).cast("long"),
                           lambda n, c: n + value(c))

    def has(b, mask):
        return b.bitwiseAND(mask) != 0

    own, before, both = F.col("own"), F.col("before"), F.col("own").bitwiseOR(F.col("before"))

    def here(b):
        return has(b, own) & ~has(b, before)

    turns = 1
    for i in range(2, len(FILTERS) + 1):
        turns *= i
    # A document is removed by each of the k filters it fails in the orders where that one comes first: 120 / k.
    return steps.select(
        "part", "filter_order", "step", total(lambda b: ~has(b, both)).alias("kept"), total(here).alias("removed"),
        total(lambda b: has(b, own) & has(b, before)).alias("redundant"),
        total(lambda b: b == own).alias("unique_fails"),
        total(here, lambda c: c["good"]).alias("good_lost"), total(here, lambda c: c["toxic"]).alias("toxic_lost"),
        total(lambda b: has(b, own), lambda c: c["n"] * (F.lit(turns) / F.bit_count(c["bits"])).cast("long"))
        .alias("shapley"))


def op12_filter_audit(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return interactions(combinations(docs.select("doc_id", "text", "source"), labels))


_STEPS = ", ".join(f"('{''.join(p)}', {s}, {1 << FILTERS.index(p[s - 1])}, "
                   f"{sum(1 << FILTERS.index(x) for x in p[:s - 1])})"
                   for p in permutations(FILTERS) for s in range(1, 6))

ORACLE = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part,
    list_filter(string_split_regex(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') AS words
  FROM documents),
f AS (
  SELECT d.doc_id, part,
    (len(words) < 50)::INT + 2 * (100 * len(list_distinct(words)) < 65 * len(words))::INT
    + 4 * (100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 5 * length(text))::INT
    + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(d.doc_id > first, false)::INT AS bits,
    coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM d LEFT JOIN (SELECT text, min(doc_id) AS first FROM d GROUP BY text) USING (text)
    LEFT JOIN (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic
               FROM labels GROUP BY doc_id) l ON l.doc_id = d.doc_id),
o(filter_order, step, own, prior) AS (VALUES {_STEPS})
SELECT part, filter_order, step, count(*) FILTER (bits & (own | prior) = 0) AS kept,
  count(*) FILTER (bits & own > 0 AND bits & prior = 0) AS removed,
  count(*) FILTER (bits & own > 0 AND bits & prior > 0) AS redundant,
  count(*) FILTER (bits = own) AS unique_fails,
  coalesce(sum(good) FILTER (bits & own > 0 AND bits & prior = 0), 0)::BIGINT AS good_lost,
  coalesce(sum(toxic) FILTER (bits & own > 0 AND bits & prior = 0), 0)::BIGINT AS toxic_lost,
  coalesce(sum(120 // greatest(bit_count(bits), 1)) FILTER (bits & own > 0), 0)::BIGINT AS shapley
FROM f CROSS JOIN o GROUP BY ALL
"""
