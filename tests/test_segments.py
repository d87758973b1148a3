import random

from pyspark.sql import functions as F

from fleetcast.functions.segments import (RANGE, in_ranges, last_known, previous, running_count, running_sum,
                                          running_xor, scan)


def test_running_values_equal_a_plain_loop_also_for_one_hot_key(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.6 else f"k{rng.randrange(40)}", rng.randrange(50), i, rng.randrange(1 << 40),
             rng.randrange(9) if rng.random() < 0.3 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, t int, id int, v long, w int").repartition(7)
    ranged = in_ranges(df, ["k"], ["t", "id"])
    got = {r["id"]: r for r in scan(ranged, ["k"], ["t", "id"], n=running_count(), s=running_sum(F.col("v")),
                                    x=running_xor(F.col("v")), last=last_known(F.col("w")),
                                    prev=previous("id", "w")).collect()}
    assert len(got) == len(rows)
    state, before = {}, {}
    for k, t, i, v, w in sorted(rows, key=lambda r: r[:3]):
        n, s, x, last = state.get(k, (0, 0, 0, None))
        state[k] = n, s, x, last = n + 1, s + v, x ^ v, last if w is None else w
        r = got[i]
        assert (r["n"], r["s"], r["x"], r["last"]) == (n, s, x, last)
        assert (tuple(r["prev"]) if r["prev"] else None) == before.get(k)
        before[k] = (i, w)


def test_one_key_and_one_instant_lie_on_all_tasks(spark):
    df = spark.range(4000).select(F.lit("k").alias("k"), F.lit(1).alias("t"), "id").repartition(8)
    ranged = in_ranges(df, ["k"], ["t", "id"])
    sizes = [r["count"] for r in ranged.groupBy(RANGE).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 2500
    assert scan(ranged, ["k"], ["t", "id"], n=running_count()).filter("n <> id + 1").count() == 0


def test_empty_table(spark):
    df = spark.createDataFrame([], "k string, t int")
    assert scan(in_ranges(df, ["k"], ["t"]), ["k"], ["t"], n=running_count()).count() == 0
