"""Running values over groups of any size, without a task that holds a whole group.

A window by key puts all rows of a key into one task.  Here rows are dealt to
ranges of the order ``(keys, order)`` (``in_ranges``), so a key with a third of
all rows lies on a third of the ranges.  ``scan`` then runs its windows inside
each range and adds what earlier ranges of the same key carry in.  A range
needs a carry only for its first key, so the carries are one row a range: a
table bounded by the number of partitions, which is broadcast.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetcast.functions.frames import cut_lineage

RANGE = "_range"


@dataclass(frozen=True)
class Running:
    """An associative aggregate, as a running value: of rows, of a range's rows, and of a carry with a local value.

    ``upto`` is the last row of the frame, from the current one.
    """

    value: Column
    fold: Callable[[Column], Column]
    join: Callable[[Column, Column], Column]
    ordered: bool = False
    upto: int = 0


def running_sum(value) -> Running:
    """Sum of the rows up to and with the current one."""
    return Running(value, F.sum, lambda before, here: F.coalesce(before, F.lit(0)) + here)


def running_count() -> Running:
    """1-based position in the group."""
    return running_sum(F.lit(1).cast("long"))


def running_xor(value) -> Running:
    """Exclusive or of 64-bit values up to and with the current row."""
    return Running(value, F.bit_xor, lambda before, here: F.coalesce(before, F.lit(0).cast("long")).bitwiseXOR(here))


def last_known(value) -> Running:
    """Newest value that is not null, up to and with the current row."""
    return Running(value, lambda c: F.last(c, ignorenulls=True), lambda before, here: F.coalesce(here, before),
                   ordered=True)


def previous(*values) -> Running:
    """``values`` of the row before, as a struct; null for a group's first row."""
    return Running(F.struct(*values), F.last, lambda before, here: F.coalesce(here, before), ordered=True, upto=-1)


def in_ranges(df: DataFrame, keys: list[str], order: list, keep: Callable[[DataFrame], DataFrame] = cut_lineage
              ) -> DataFrame:
    """Rows of ``df`` with their range in ``_range``; ``keep`` writes them, so that a retried task cannot deal anew.

    Ranges follow the order ``(keys, order)``.  Equal rows share a range, so the
    order should be total.  Keys must not be null.
    """
    dealt = df.repartitionByRange(*keys, *order)
    return keep(dealt.withColumn(RANGE, F.spark_partition_id()))


def scan(ranged: DataFrame, keys: list[str], order: list, **scans: Running) -> DataFrame:
    """``ranged`` with a running value a name, in ``order`` within ``keys``.

    Several calls on the same rows share one exchange of the rows.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    rows = Window.partitionBy(RANGE, *keys).orderBy(*order)
    inside = rows.rowsBetween(Window.unboundedPreceding, 0)
    edges = ranged.groupBy(RANGE).agg(F.min(F.struct(*keys)).alias("_first"), F.max(F.struct(*keys)).alias("_last"))
    # What the last key of a range hands on; a key that fills several ranges is the last of all but its final one.
    held = ranged.join(F.broadcast(edges), RANGE).filter(F.struct(*keys) == F.col("_last"))
    if any(s.ordered for s in scans.values()):
        # The last row of an ordered fold is found by the same window, so that no order is assumed of a group's rows.
        held = held.withColumns({f"_v_{n}": s.fold(s.value).over(inside) for n, s in scans.items()}) \
            .withColumn("_at", F.row_number().over(rows))
        totals = held.groupBy(RANGE).agg(F.max_by(F.struct(*[f"_v_{n}" for n in scans]), "_at").alias("_t")) \
            .select(RANGE, *[F.col(f"_t._v_{n}").alias(f"_v_{n}") for n in scans])
    else:
        totals = held.groupBy(RANGE).agg(*[s.fold(s.value).alias(f"_v_{n}") for n, s in scans.items()])
    along = Window.partitionBy("_last").orderBy(RANGE).rowsBetween(Window.unboundedPreceding, 0)
    summed = edges.join(totals, RANGE).withColumns({f"_v_{n}": s.fold(F.col(f"_v_{n}")).over(along)
                                                    for n, s in scans.items()})
    before = Window.orderBy(RANGE)  # one row a range
    carried = summed.select(RANGE, F.col("_first").alias("_key"),
                            (F.lag("_last").over(before) == F.col("_first")).alias("_same"),
                            *[F.lag(f"_v_{n}").over(before).alias(f"_c_{n}") for n in scans]) \
        .filter("_same").drop("_same")
    local = ranged.withColumns({n: s.fold(s.value).over(rows.rowsBetween(Window.unboundedPreceding, s.upto))
                                for n, s in scans.items()}) \
        .withColumn("_key", F.struct(*keys))
    out = local.join(F.broadcast(carried), [RANGE, "_key"], "left")
    return out.withColumns({n: s.join(F.col(f"_c_{n}"), F.col(n)) for n, s in scans.items()}) \
        .select(*ranged.columns, *[n for n in scans if n not in ranged.columns])
