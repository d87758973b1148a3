"""Small DataFrame helpers shared by operators."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (to the shared ``spark.checkpoint.dir``) computed once.

    A bare ``checkpoint()`` runs the plan twice: once for the eager action and
    once more to write the files.  Persisting first makes the write read the
    cached blocks; the cache is dropped once the files exist.
    """
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out


def with_group_index(df: DataFrame, order_cols: list, group_cols: list[str] | None = None,
                     name: str = "idx") -> DataFrame:
    """0-based position of each row in ``order_cols`` order, per group.

    Distributed: a range-partitioned sort, then per-partition row counts (one
    small row per partition and group) turned into offsets, and the in-partition
    position taken from ``monotonically_increasing_id``.  No window without a
    partition key, so no single task sees all rows.  The sorted, id-tagged rows
    are checkpointed so a retried task cannot renumber them.  ``order_cols``
    must make the order total.
    """
    group_cols = list(group_cols or [])
    keys = [F.col(c) for c in group_cols] + [c if isinstance(c, Column) else F.col(c) for c in order_cols]
    tagged = (df.orderBy(*keys)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    tagged = cut_lineage(tagged)
    per_part = tagged.groupBy("_pid", *group_cols).agg(
        F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*group_cols).orderBy("_pid") if group_cols else Window.orderBy("_pid")
    # One row per (partition, group): bounded by partitions x groups per partition.
    offsets = per_part.withColumn(
        "_off", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1))).fillna(0, ["_off"])
    joined = tagged.join(F.broadcast(offsets.select("_pid", *group_cols, "_first", "_off")),
                         ["_pid", *group_cols], "inner")
    return joined.withColumn(name, (F.col("_off") + F.col("_mid") - F.col("_first")).cast("long")) \
        .drop("_pid", "_mid", "_first", "_off")
