"""Tables written between the steps of an operator, in the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


class Scratch:
    """Parquet tables below the cluster's shared checkpoint folder, deleted on leaving the ``with``.

    Written tables cut the lineage (a lost executor costs no recomputation) and
    stay columnar, so later steps read only the columns they need.  What an
    operator returns must not read them: it keeps its last, small table with
    ``checkpoint()``, whose files Spark deletes once nothing refers to them.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path, self._n, self._at = spark, scratch_path(spark, name), 0, {}

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *_) -> None:
        self._delete(self.path)

    def _delete(self, path: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def free(self, *tables: DataFrame) -> None:
        """Delete kept tables whose readers have all been written."""
        for t in tables:
            self._delete(self._at.pop(id(t))[0])

    def keep(self, df: DataFrame, tasks: int | None = None) -> DataFrame:
        """``tasks``: at most so many write it, for tables known to be small for the cluster."""
        self._n += 1
        df = df if tasks is None else df.coalesce(tasks)
        to = f"{self.path}/{self._n}"
        df.write.parquet(to)
        kept = self.spark.read.schema(df.schema).parquet(to)
        self._at[id(kept)] = (to, kept)   # held, so that the number is no other table's
        return kept


HOT_KEYS = 4096   # at most so many keys are on a share of 1/HOT_KEYS of all rows or more
SALTS = 64        # tasks that share the rows of such a key


def is_hot(count: str, total: int) -> Column:
    """Whether a key with ``count`` of all ``total`` rows has such a share."""
    return F.col(count) * HOT_KEYS >= total


def join_hot(rows: DataFrame, side: DataFrame, keys: list[str], hot: str = "hot") -> DataFrame:
    """``rows`` joined to ``side`` (one row a key); rows of its hot keys are dealt over ``SALTS`` tasks a key.

    The hot keys, ``HOT_KEYS`` at most by counting, reach the driver; only their
    rows of ``side`` are copied.  No other key has a larger share of the rows.
    """
    few = [r[0] for r in side.filter(hot).select(keys[0]).distinct().collect()]
    side = side.drop(hot)
    if not few:
        return rows.join(side, keys)
    dealt = F.col(keys[0]).isin(few)
    salt = F.when(dealt, F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS))).otherwise(0).cast("int")
    copies = F.when(dealt, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("_salt", salt).join(side.withColumn("_salt", F.explode(copies)), [*keys, "_salt"]).drop("_salt")
