"""Top-k search by branch and bound over a summary of the drivers.

The drivers' box is cut into 4 x 4 cells, crowded cells again, and so on
(``build_index``).  Static scores (the part of the logit that does not depend on
the request) are the third side of a cell, cut by the same step as the places
where both change a score alike; so a cell's scores come closer with each level,
and the drivers looked at for a request do not grow with all drivers.  A cell's
summary is one row: how many drivers it holds, their tight box, and the least and
the greatest static score.  So for a request a cell has a worst and a best score.  The search (``candidates``) goes down the levels: sorted by worst
score, the cells that together hold k drivers give a floor, and cells whose best
score is below it are dropped with all that is in them.  Only drivers of the
cells left at the end are paired with the request.

Every request has its own k, so a large one widens nobody else's search.  Drivers
on one spot are parted by their rank there (by static score, then id) and, where
they share the static score too, by their rank by id: a request looks at the
ranks up to its k only.
"""

from __future__ import annotations

import datetime as dt
import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fleetcast.functions.frames import cut_lineage
from fleetcast.functions.geo import EARTH_RADIUS_KM
from fleetcast.functions.scoring import Ranker, sigmoid
from fleetcast.functions.segments import in_ranges, running_count, scan

LEAF_ROWS = 8                  # a cell with so many drivers is not cut again
EXTRA_LEVELS = 4               # beyond those that evenly spread drivers need: crowds of 65,536 times the mean density
MOST_LEVELS = 9                # 4 ** 9 cells a side
SCORE_LEVELS = 6               # static scores are cut at the first levels only: 4 ** 6 steps
KM_PER_DEGREE = 111.2
BROADCAST_ROWS = 1_000_000     # a level or the drivers are broadcast only when they count no more
SALTS = 16                     # copies of a larger table, so that a crowd of requests in one cell is dealt out
RANK_BASE = 8                  # ranks on a spot: up to 8, to 64, to 512, ...
ROUNDING = 1e-7                # more than the distance formula's, relative (antipodes) and in km
SUMMARY = ["n", "a0", "a1", "o0", "o1", "g0", "g1", "r0", "t0", "t1", "f0", "later", "ages"]
TIMES = ["position_ts", "features_ts"]
# Shares of the drivers with an older position, at whose times the drivers of a cell are counted.
AGES = [i / 8 for i in range(1, 8)] + [1 - 2 ** -i for i in range(4, 17)]
NEVER = "0001-01-01 00:00:00"
LAYOUT = 2                     # of the stored tables
ROOT = 0


@dataclass(frozen=True)
class Expiry:
    """Positions and features older than these times (None: any age) count as missing."""

    position: dt.datetime | None = None
    features: dt.datetime | None = None


@dataclass(frozen=True)
class DriverIndex:
    """``steps``: (level, parent, cell, leaf, summary); ``drivers``: (cell, driver columns).

    ``levels`` counts (cells, leaves) a level; ``whole`` is the summary of all
    drivers.  ``times`` (ISO) ascend; ``ages`` of a summary counts the drivers with
    a position of that time or later.
    """

    steps: DataFrame
    drivers: DataFrame
    levels: dict[int, tuple[int, int]]
    n_drivers: int
    whole: dict
    times: list[str]

    def save(self, path: str) -> None:
        """Both tables, the drivers in folders by the part of the box they are in, so that a search reads its parts only."""
        self.steps.write.mode("overwrite").parquet(f"{path}/steps")
        self.drivers.withColumn("part", part_of(F.col("cell"))).repartition("part").sortWithinPartitions("cell") \
            .write.mode("overwrite").partitionBy("part").parquet(f"{path}/drivers")
        meta = json.dumps({"levels": self.levels, "n_drivers": self.n_drivers, "whole": self.whole, "times": self.times,
                           "steps": self.steps.schema.jsonValue(), "drivers": self.drivers.schema.jsonValue()}, default=str)
        self.steps.sparkSession.createDataFrame([(meta,)], "meta string").coalesce(1) \
            .write.mode("overwrite").parquet(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> DriverIndex:
        meta = json.loads(spark.read.parquet(f"{path}/meta").first()[0])
        steps, drivers = (T.StructType.fromJson(meta[t]) for t in ("steps", "drivers"))
        drivers.add("part", T.IntegerType())
        return DriverIndex(spark.read.schema(steps).parquet(f"{path}/steps"),
                           spark.read.schema(drivers).parquet(f"{path}/drivers"),
                           {int(k): tuple(v) for k, v in meta["levels"].items()}, meta["n_drivers"], meta["whole"], meta["times"])


# A cell's number: level (4 bits), row and column at its level (18 bits each), step of the static score (12 bits), part
# of a crowded spot (10 bits).

def _right(c: Column, bits: Column) -> Column:
    return F.call_function("shiftright", c, bits.cast("int"))


def _cell(level: Column, y: Column, x: Column, z: Column) -> Column:
    at = F.shiftleft(level.cast("long"), 48).bitwiseOR(F.shiftleft(y.cast("long"), 30)) \
        .bitwiseOR(F.shiftleft(x.cast("long"), 12)).bitwiseOR(z.cast("long"))
    return F.shiftleft(at, 10)


def part_of(cell: Column) -> Column:
    """Which of the 16 first cells this one is in."""
    down = (F.shiftright(cell, 58) - 1) * 2
    side = F.lit((1 << 18) - 1)
    y, x = (_right(F.shiftright(cell, bits).bitwiseAND(side), down) for bits in (40, 22))
    return (y * 4 + x).cast("int")


def _times(times: list[str]) -> list[Column]:
    return [F.to_timestamp_ntz(F.lit(t)) for t in times]


def _summaries(rows: DataFrame, *keys: str, times: list[str] = ()) -> DataFrame:
    seen = F.coalesce("features_ts", F.to_timestamp_ntz(F.lit(NEVER)))
    ages = [F.count_if((F.col("position_ts") >= t) & F.col("_g").isNotNull()) for t in _times(times)]
    return rows.groupBy(*keys).agg(
        F.count("_g").alias("n"), F.count(F.lit(1)).alias("rows"), F.min("lat").alias("a0"), F.max("lat").alias("a1"),
        F.min("lon").alias("o0"), F.max("lon").alias("o1"),
        F.min("_g").alias("g0"), F.max("_g").alias("g1"), F.min("_r").alias("r0"),
        F.min("position_ts").alias("t0"), F.max("position_ts").alias("t1"), F.min(seen).alias("f0"),
        F.bool_and(seen >= F.col("position_ts")).alias("later"),
        F.array(*ages).cast("array<bigint>").alias("ages"))


def _expired(ranker: Ranker) -> float | None:
    """Static score of a driver whose features have expired; None: it has none."""
    feats = [f for f in ranker.features if f != "distance_km"]
    if not all(f in ranker.impute for f in feats):
        return None
    return float(sum(ranker.weights[f] * ranker.impute[f] for f in feats))


def build_index(drivers: DataFrame, ranker: Ranker, leaf_rows: int = LEAF_ROWS) -> DriverIndex:
    """Index of ``drivers``: driver_id, lat, lon (not null) and the ranker's other features.

    With position_ts and features_ts the index serves searches at any time: a
    cell's bounds are widened while features of its drivers may have expired, and
    its drivers are counted as of the next later of the times that are kept.

    A pass for the box, one aggregation for the cells of all levels, and one join
    that tells each driver its cell.
    """
    feats = [f for f in ranker.features if f != "distance_km"]
    times = [F.col(t) if t in drivers.columns else F.lit(None).cast("timestamp_ntz").alias(t) for t in TIMES]
    drv = drivers.select("driver_id", "lat", "lon", *feats, *times).withColumns(
        {"_g": ranker.static_logit(), "_r": F.lit(1).cast("long")}).persist()
    whole = _summaries(drv).first().asDict()
    kept = [] if whole["t1"] is None else sorted(set(drv.select(F.explode(F.transform(
        F.percentile_approx("position_ts", AGES, 1_000_000), lambda t: t.cast("string")))).toPandas().iloc[:, 0]))
    n = whole["rows"]
    depth = min(MOST_LEVELS, math.ceil(math.log(n / leaf_rows + 1, 16)) + EXTRA_LEVELS)
    side = float(4 ** depth)

    def at(c: str, lo, hi) -> Column:
        lo = lo or 0.0
        width = max((hi or 0.0) - lo, 1e-9)
        return F.least(F.floor((F.col(c) - F.lit(lo)) / F.lit(width) * side), F.lit(side - 1)).cast("long")

    # A step of the static score is as wide as what the wider side of a cell changes a score by.
    degrees = max((whole["a1"] or 0.0) - (whole["a0"] or 0.0), (whole["o1"] or 0.0) - (whole["o0"] or 0.0))
    low, high = whole["g0"] or 0.0, whole["g1"] or 0.0
    width = max(degrees * KM_PER_DEGREE * abs(float(ranker.weights["distance_km"])), high - low, 1e-9)
    step = F.floor((F.col("_g") - F.lit(low)) / F.lit(width) * side)
    z = F.coalesce(F.greatest(F.least(step, F.lit(side - 1)), F.lit(0.0)), F.lit(0.0)).cast("long")
    placed = drv.withColumns({"_y": at("lat", whole["a0"], whole["a1"]), "_x": at("lon", whole["o0"], whole["o1"]), "_z": z})
    exploded = placed.withColumn("level", F.explode(F.sequence(F.lit(1), F.lit(depth))))

    def key(level: Column) -> Column:
        down = (F.lit(depth) - level) * 2
        flat = F.greatest(down, F.lit(2 * (depth - SCORE_LEVELS)))
        return _cell(level, _right(F.col("_y"), down), _right(F.col("_x"), down), _right(F.col("_z"), flat))

    level = F.col("level")
    up = F.when(level == 1, F.lit(ROOT).cast("long")).otherwise(key(level - 1))
    cells = _summaries(exploded.select("level", key(level).alias("cell"), up.alias("parent"), "lat", "lon", "_g", "_r", *TIMES),
                       "level", "cell", "parent", times=kept)
    # What lies below a cell that is small enough is not needed.  A parent has 64 children at most.
    with_all = F.sum("rows").over(Window.partitionBy("level", "parent"))
    cells = cells.withColumn("_all", with_all).filter((level == 1) | (F.col("_all") > leaf_rows)).drop("_all") \
        .withColumn("leaf", F.col("rows") <= leaf_rows).persist()
    counted = {r["level"]: r for r in cells.groupBy("level").agg(
        F.count(F.lit(1)).alias("cells"), F.count_if("leaf").alias("leaves"), F.max("rows").alias("most")).collect()}
    ends = cells.filter(F.col("leaf") | (level == depth)).select("cell", "rows")
    few = sum(r["cells"] for r in counted.values()) <= BROADCAST_ROWS
    homed = exploded.select("driver_id", "lat", "lon", *feats, *TIMES, "_g", "_r", key(level).alias("cell")) \
        .join(F.broadcast(ends) if few else ends, "cell")
    keep = ["cell", "driver_id", "lat", "lon", *feats, *TIMES]
    steps = cells.select("level", "parent", "cell", "leaf", *SUMMARY)
    levels = {k: (r["cells"], r["leaves"]) for k, r in counted.items()}
    if depth in counted and counted[depth]["most"] > leaf_rows:
        crowd = _by_rank(homed.filter(F.col("rows") > leaf_rows))
        below = _summaries(crowd.withColumn("level", F.lit(depth + 1)), "level", "cell", "parent", times=kept) \
            .select("level", "parent", "cell", F.lit(True).alias("leaf"), *SUMMARY)
        steps = steps.unionByName(below)
        levels[depth + 1] = (below.count(),) * 2
        homed = homed.filter(F.col("rows") <= leaf_rows).select(*keep).unionByName(crowd.select(*keep))
    index = DriverIndex(cut_lineage(steps), cut_lineage(homed.select(*keep)), levels, n, whole, kept)
    for held in (cells, drv):
        held.unpersist()
    return index


def _by_rank(crowd: DataFrame) -> DataFrame:
    """Drivers of cells that no finer grid parts, in parts by their ranks on their spot."""
    down = F.coalesce(-F.col("_g"), F.lit(float("inf")))
    ranged = in_ranges(crowd.drop("_r").withColumn("_d", down), ["lat", "lon"], ["_d", "driver_id"])
    ranked = scan(ranged, ["lat", "lon"], ["_d", "driver_id"], _p=running_count())
    ranked = scan(ranked, ["lat", "lon", "_d"], ["driver_id"], _r=running_count())

    def size(rank: str) -> Column:
        return F.least(F.greatest(F.floor(F.log(float(RANK_BASE), F.col(rank) - 0.5)), F.lit(0)), F.lit(31)).cast("long")

    return cut_lineage(ranked.withColumn("parent", F.col("cell"))
                       .withColumn("cell", F.col("cell") + size("_p") * 32 + size("_r")))


# -------------------------------------------------------------------- search

def cosines(s) -> dict[str, Column]:
    """Least and greatest cosine of a latitude of a cell; null where the cell goes beyond a pole."""
    a, b = F.cos(F.radians(s("a0"))), F.cos(F.radians(s("a1")))
    known = (s("a0") >= -90) & (s("a1") <= 90)
    over = (s("a0") <= 0) & (s("a1") >= 0)
    return {"c0": F.when(known, F.greatest(F.least(a, b), F.lit(0.0))),
            "c1": F.when(known, F.when(over, F.lit(1.0)).otherwise(F.greatest(a, b, F.lit(0.0))))}


def score_bounds(lat: Column, lon: Column, ranker: Ranker, s) -> tuple[Column, Column]:
    """Worst and best score that a driver of a cell can have; ``s(name)`` is a column of its summary or a cosine.

    Both leave room for rounding.  Beyond the poles there are no bounds on the
    distance.  No part of an expression occurs in it twice, as a Generate would
    compute it twice.
    """
    def sin2(deg: Column) -> Column:
        return F.pow(F.sin(F.radians(deg) / 2), 2)

    def km(a: Column, unknown: float) -> Column:
        return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.coalesce(a, F.lit(unknown)), F.lit(1.0))))

    here = F.when(F.abs(lat) <= 90, F.greatest(F.cos(F.radians(lat)), F.lit(0.0)))
    away = F.greatest(F.abs(lon - s("o0")), F.abs(lon - s("o1")))
    # The other way round the globe may be shorter.
    beside = F.greatest(F.least(F.greatest(s("o0") - lon, lon - s("o1")), F.lit(360.0) - away), F.lit(0.0))
    near = sin2(F.greatest(s("a0") - lat, lat - s("a1"), F.lit(0.0))) + here * s("c0") * sin2(beside)
    far = sin2(F.greatest(F.abs(lat - s("a0")), F.abs(lat - s("a1")))) \
        + here * s("c1") * sin2(F.least(away, F.lit(180.0)))
    w, b = float(ranker.weights["distance_km"]), float(ranker.intercept)
    room = 1e-9 * (1 + abs(b))
    best = F.greatest(km(near, 0.0) * (1 - ROUNDING) - ROUNDING, F.lit(0.0)) * w + (s("g1") + F.abs(s("g1")) * 1e-9 + b + room)
    worst = (km(far, 1.0) * (1 + ROUNDING) + ROUNDING) * w + (s("g0") - F.abs(s("g0")) * 1e-9 + b - room)
    return sigmoid(worst), sigmoid(best)


def _at_time(step: DataFrame, index: DriverIndex, ranker: Ranker, expiry: Expiry) -> DataFrame:
    """Cells that hold a driver not expired, their ``n`` at least so many of them, bounds that hold for all of them."""
    if expiry.position is not None:
        after = F.lit(expiry.position)
        # Those as new as the first kept time that is not before.
        earlier = sum((F.when(t < after, 1).otherwise(0) for t in _times(index.times)), F.lit(0))
        counted = F.coalesce(F.get("ages", earlier), F.lit(0))
        step = step.filter(F.col("t1") >= after).withColumn("n", F.when(F.col("t0") >= after, F.col("n")).otherwise(counted))
    if expiry.features is not None:
        fresh = F.col("f0") >= F.lit(expiry.features)
        if expiry.position is not None and expiry.features <= expiry.position:
            fresh = fresh | F.col("later")   # who has a position in time then has features in time
        expired = _expired(ranker)
        if expired is None:
            step = step.withColumn("n", F.when(fresh, F.col("n")).otherwise(0))
        else:
            step = step.withColumns({"g0": F.when(fresh, F.col("g0")).otherwise(F.least("g0", F.lit(expired))),
                                     "g1": F.when(fresh, F.col("g1")).otherwise(F.greatest("g1", F.lit(expired)))})
    return step.drop("t0", "t1", "f0", "later", "ages")


def drivers_at(index: DriverIndex, ranker: Ranker, expiry: Expiry) -> DataFrame:
    """The index's drivers as they are at a time: none with an expired position, expired features null."""
    out = index.drivers
    if expiry.position is not None:
        out = out.filter(F.col("position_ts") >= F.lit(expiry.position))
    if expiry.features is not None:
        fresh = F.col("features_ts") >= F.lit(expiry.features)
        out = out.withColumns({f: F.when(fresh, F.col(f)) for f in ranker.features if f != "distance_km"})
    return out.drop(*TIMES)


def _fitting(table: DataFrame, rows: int, key: str, limit: int) -> tuple[DataFrame, bool]:
    """``table`` for a join on ``key``: broadcast when counted small, else in salted copies."""
    if rows <= limit:
        return F.broadcast(table), True
    return table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), False


def candidates(requests: DataFrame, own: list[str], index: DriverIndex, ranker: Ranker,
               broadcast_rows: int = BROADCAST_ROWS, expiry: Expiry = Expiry()) -> DataFrame:
    """``own`` columns, ``_floor`` and ``cell``: the cells whose drivers may be among a request's ``_k`` best.

    ``requests`` holds rider_lat, rider_lon and _k among its ``own`` columns,
    which tell a request from others.
    """
    lat, lon = F.col("rider_lat"), F.col("rider_lon")
    # A hash in front: rows of different requests are told apart by it when they are sorted, not by long equal prefixes.
    tag = "_tag"
    # The root's number, 0, is written so that it is not folded: the join with its 64 cells at most keeps its key.
    front = requests.select(F.xxhash64(*own).alias(tag), *own, F.lit(None).cast("double").alias("_floor")) \
        .withColumn("cell", F.col(tag) % 1 + ROOT)
    out, own = own, [tag, *own]
    salt = F.pmod(F.col(tag), F.lit(SALTS)).cast("int")
    group = Window.partitionBy(*own)
    worst_first = group.orderBy(F.col("_worst").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    settled = 0
    for level in sorted(index.levels):
        # Leaves met earlier stand for themselves.
        step = index.steps.filter(F.col("level") == level).select(F.col("parent").alias("cell"), F.col("cell").alias("_to"),
                                                                  *SUMMARY)
        if settled:
            step = step.unionByName(index.steps.filter((F.col("level") < level) & F.col("leaf")).select(
                "cell", F.col("cell").alias("_to"), *SUMMARY))
        step = _at_time(step, index, ranker, expiry).withColumns(cosines(F.col))
        cells, leaves = index.levels[level]
        step, small = _fitting(step, cells + settled, "cell", broadcast_rows)
        settled += leaves
        met = front.join(step, "cell") if small else front.withColumn("_salt", salt).join(step, ["cell", "_salt"])
        worst, best = score_bounds(lat, lon, ranker, F.col)
        # What is below the floor of the level above cannot raise it, so it is dropped before any sorting.  The bounds
        # come from a Generate (``inline``), so that the filter does not compute them once more.
        met = met.filter(F.col("r0") <= F.col("_k")).select(
            *own, "_floor", F.col("_to").alias("cell"), "n",
            F.inline(F.array(F.struct(worst.alias("_worst"), best.alias("_best"))))) \
            .filter(F.col("_floor").isNull() | (F.col("_best") >= F.col("_floor")))
        sure = F.max(F.when(F.col("_sum") >= F.col("_k"), F.col("_worst"))).over(group)
        met = met.withColumn("_sum", F.sum("n").over(worst_first)).withColumn("_floor", F.greatest("_floor", sure))
        front = met.filter(F.col("_floor").isNull() | (F.col("_best") >= F.col("_floor"))).select(*own, "cell", "_floor")
    return front.select(*out, "cell", "_floor")


def pairs(requests: DataFrame, own: list[str], index: DriverIndex, ranker: Ranker,
          broadcast_rows: int = BROADCAST_ROWS, expiry: Expiry = Expiry()) -> DataFrame:
    """Requests with the drivers that may be among their ``_k`` best."""
    front = candidates(requests, own, index, ranker, broadcast_rows, expiry)
    drivers = drivers_at(index, ranker, expiry)
    if index.n_drivers > broadcast_rows and "part" in drivers.columns:
        # A stored index: only the folders of the parts that were reached are read.
        front = cut_lineage(front)
        reached = [r[0] for r in front.select(part_of(F.col("cell"))).distinct().collect()]   # 16 at most
        drivers = drivers.filter(F.col("part").isin(reached))
    drivers, small = _fitting(drivers.drop("part"), index.n_drivers, "cell", broadcast_rows)
    if small:
        return front.join(drivers, "cell").drop("cell")
    salt = F.pmod(F.xxhash64(*own), F.lit(SALTS)).cast("int")
    return front.withColumn("_salt", salt).join(drivers, ["cell", "_salt"]).drop("cell", "_salt")


def all_tied(index: DriverIndex, ranker: Ranker) -> Column:
    """All drivers have one and the same score for the request, as for one very far away: only ids decide."""
    if index.whole["n"] < index.n_drivers or not all(f in ranker.impute for f in ranker.features if f != "distance_km"):
        return F.lit(False)   # some have, or may come to have, no score at all
    least, most = index.whole["g0"], index.whole["g1"]
    if index.times:   # features may expire
        least, most = min(least, _expired(ranker)), max(most, _expired(ranker))
    box = {c: F.lit(index.whole[c]).cast("double") for c in ("a0", "a1", "o0", "o1")}
    box.update(g0=F.lit(float(least)), g1=F.lit(float(most)))
    box.update(cosines(box.get))
    worst, best = score_bounds(F.col("rider_lat"), F.col("rider_lon"), ranker, box.get)
    return worst == best
