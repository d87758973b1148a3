"""Prefix trie of conversations by whole-sequence collapse (operator 13).

Identical conversations are first grouped into weighted sequences, each with the
list of the ids that end there.  Sequences that are proper prefixes of others
are dropped by an anti-join, which leaves the leaves.  Then the weighted
prefixes of all distinct sequences are aggregated to nodes.

A prefix is known by 128 bits: the exclusive or of its turns' hashes, each mixed
with its place.  So prefixes are running values (``segments.scan``), and no row
ever holds a whole conversation.

Sums over a subtree need no walk through the tree.  Every node is owned by its
smallest member; a sequence owns the lower end of its path, from ``own`` on, as a
member of a node is a member of all nodes above.  So what holds once a node
(children, lengths) is a sum over sequences too, each adding its owned part only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetcast.functions.segments import RANGE, in_ranges, running_count, running_sum, running_xor, scan

from .shared import Scratch

HEAD = 5            # a head has so many turns at most: the remainder of a division by HEAD + 1
FAMILY = 100        # conversations of one base
BLOCK_BITS = 13     # ids of an end list come in blocks of 2^13 consecutive numbers
HOT_PARENTS = 4096  # at most so many parents have a share of 1/HOT_PARENTS of all children or more

PREFIX = ["p1", "p2"]


def _mixed(*seed) -> Column:
    return F.xxhash64(*seed, "depth", "digest")


def narrow_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, digest (of role and text) and points (code points of the text); null role and text are empty.

    Rows without conv_id belong to no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    marked = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(marked)).alias("digest"), F.char_length(text).cast("long").alias("points"))


def rebuild(turns: DataFrame, keep) -> tuple[DataFrame, DataFrame]:
    """Conversations with the head of their base: rows (conv_id, part, i, digest, points), and all conv_ids.

    Turns are ordered by ``turn`` (null first), turns of one number by digest.
    The first h turns of conversation c are those of c - c % 100, where h is the
    unsigned crc32 of c's decimal form modulo 6; its own come after its first h.
    """
    order = [F.col("turn").asc_nulls_first(), "digest"]
    own = keep(scan(in_ranges(keep(turns), ["conv_id"], order, keep), ["conv_id"], order, i=running_count())
               .select("conv_id", "i", "digest", "points"))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD + 1)
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    ids = keep(own.select("conv_id").distinct())
    heads = own.filter((F.col("i") <= HEAD) & (F.col("conv_id") == base)).groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("i", "digest", "points"))).alias("turns"))  # HEAD turns at most
    lent = ids.withColumn("h", head).withColumn("base", base).filter("h > 0").join(heads, "base").select(
        "conv_id", F.explode(F.slice("turns", F.lit(1), F.col("h").cast("int"))).alias("t"))
    rows = lent.select("conv_id", F.lit(0).alias("part"), "t.i", "t.digest", "t.points").unionByName(
        own.filter(F.col("i") > head).select("conv_id", F.lit(1).alias("part"), "i", "digest", "points"))
    return rows, ids


def prefix_trie(rows: DataFrame, ids: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The trie of the sequences in ``rows`` (conv_id, part, i, digest, points); ``ids`` names them all, also empty ones.

    Nodes: p1 and p2 (the prefix), conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens.  Ends: p1, p2, block and ids, the
    members that end in the node, in ascending blocks of 2^13 numbers.  No ids,
    no nodes, not even a root.
    """
    keep, order = scratch.keep, ["part", "i"]
    ranged = in_ranges(keep(rows), ["conv_id"], order, keep)
    placed = scan(ranged, ["conv_id"], order, depth=running_count())
    path = keep(scan(placed, ["conv_id"], order, p1=running_xor(_mixed()), p2=running_xor(_mixed(F.lit(1))),
                     points_to=running_sum(F.col("points")))
                .select("conv_id", RANGE, "depth", "points", "points_to", "p1", "p2",
                        F.col("p1").bitwiseXOR(_mixed()).alias("up1"),
                        F.col("p2").bitwiseXOR(_mixed(F.lit(1))).alias("up2")))
    ends = path.groupBy("conv_id").agg(F.max_by(F.struct("p1", "p2", "depth", "points_to"), "depth").alias("e"))
    zero = F.lit(0).cast("long")
    whole = keep(ids.join(ends, "conv_id", "left").select(
        "conv_id", *[F.coalesce(f"e.{c}", zero).alias(c) for c in ("p1", "p2", "depth", "points_to")]))
    # Whole sequences: weight, smallest id, length.
    seqs = keep(whole.groupBy(*PREFIX).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight"), F.first("depth").alias("n"),
        F.first("points_to").alias("total")))
    # A sequence's pieces, one a range it lies on: a very long one is joined in many tasks.
    places = keep(path.groupBy("conv_id", RANGE).agg(F.count(F.lit(1)).alias("_n")).drop("_n")
                  .join(seqs.select("conv_id", "n"), "conv_id")
                  .unionByName(seqs.select("conv_id", F.lit(-1).alias(RANGE), "n")))
    roots = seqs.select("conv_id", F.lit(-1).alias(RANGE), *[zero.alias(c) for c in (
        "depth", "points", "points_to", "p1", "p2", "up1", "up2")])
    prefixes = keep(path.unionByName(roots).join(places, ["conv_id", RANGE]))
    inner = prefixes.filter("depth < n").groupBy(*PREFIX).agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    leaves = seqs.join(inner, PREFIX, "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    owned = prefixes.groupBy(*PREFIX).agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
        F.first(F.col("points_to") - F.col("points")).alias("above")) \
        .groupBy("conv_id").agg(F.min(F.struct("depth", "above")).alias("o"))
    known = seqs.join(leaves, "conv_id", "left").join(owned, "conv_id", "left").select(
        "conv_id", "weight", "total", F.coalesce("leaf", F.lit(0)).alias("leaf"),
        F.coalesce("o.depth", F.col("n") + 1).alias("own"), F.coalesce("o.above", "total").alias("own_above"))
    facts = places.join(known, "conv_id").drop("n")
    above = F.col("points_to") - F.col("points")
    below = F.col("depth") + 1
    nodes = keep(prefixes.join(facts, ["conv_id", RANGE]).groupBy(*PREFIX).agg(
        F.min(F.struct("conv_id", "own")).alias("o"), F.first("depth").alias("depth"),
        F.first("up1").alias("up1"), F.first("up2").alias("up2"), F.sum("weight").alias("n_convs"),
        F.sum(((F.col("n") >= below) & (F.col("own") <= below)).cast("long")).alias("n_children"),
        F.sum("leaf").alias("n_leaves"),
        F.sum(F.col("weight") * (F.col("total") - above)
              - (F.col("total") - F.greatest(above, "own_above"))).alias("saved_tokens"))
        .select(*PREFIX, "o.conv_id", "o.own", "depth", "up1", "up2", "n_convs", "n_children", "n_leaves",
                "saved_tokens"))
    block = F.shiftright("conv_id", BLOCK_BITS).alias("block")
    lists = whole.groupBy(*PREFIX, block).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    return _with_parents(nodes), lists


def _with_parents(nodes: DataFrame) -> DataFrame:
    """Only the top node of those a sequence owns has a parent with another id; it is looked up.

    Parents of very many children are few by counting (at most HOT_PARENTS) and
    are broadcast; the others are joined, none with more than that share of rows.
    """
    cols = [*PREFIX, "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    top = (F.col("own") == F.col("depth")) & (F.col("depth") > 0)
    total = nodes.count() - 1
    hot = F.col("n_children") * HOT_PARENTS >= total

    def parents(which):
        return nodes.filter((F.col("n_children") > 0) & which).select(
            F.col("p1").alias("up1"), F.col("p2").alias("up2"), F.col("conv_id").alias("parent_conv_id"))

    same = F.when(F.col("depth") > 0, F.col("conv_id"))
    few = F.broadcast(parents(hot))
    return nodes.filter(~top).withColumn("parent_conv_id", same).select(*cols) \
        .unionByName(nodes.filter(top).join(few, ["up1", "up2"]).select(*cols)) \
        .unionByName(nodes.filter(top).join(few, ["up1", "up2"], "left_anti")
                     .join(parents(~hot), ["up1", "up2"]).select(*cols))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's comma-joined ids; blocks come in order, and only the hash of one node is held."""
    node, state = None, None

    def rows(done):
        return pa.RecordBatch.from_arrays(
            [pa.array([n[0] for n, _ in done], pa.int64()), pa.array([n[1] for n, _ in done], pa.int64()),
             pa.array([s.hexdigest() for _, s in done], pa.string())], ["p1", "p2", "ends_sha256"])

    for batch in batches:
        done = []
        for p1, p2, text in zip(*(batch.column(c).to_pylist() for c in ("p1", "p2", "text"))):
            if (p1, p2) != node:
                if node is not None:
                    done.append((node, state))
                node, state = (p1, p2), hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.encode())
        yield rows(done)
    if node is not None:
        yield rows([(node, state)])


def ends_digest(lists: DataFrame) -> DataFrame:
    """p1, p2, ends_sha256 of end lists."""
    return lists.select(*PREFIX, "block", F.array_join("ids", ",").alias("text")) \
        .repartition(*PREFIX).sortWithinPartitions(*PREFIX, "block") \
        .mapInArrow(_digests, "p1 long, p2 long, ends_sha256 string")


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    turns = narrow_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    with Scratch(spark, "trie") as scratch:
        rows, ids = rebuild(turns, scratch.keep)
        nodes, lists = prefix_trie(rows, ids, scratch)
        nothing = F.lit(hashlib.sha256(b"").hexdigest())
        return nodes.join(ends_digest(lists), PREFIX, "left").select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", nothing).alias("ends_sha256")).checkpoint()


# The crc32 of the decimal id, bit by bit: 0xEDB88320 = 3988292384, 0xFFFFFFFF = 4294967295.
ORACLE = """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY i) AS own FROM t GROUP BY conv_id),
h AS (
  SELECT conv_id, own, conv_id - conv_id % 100 AS base, xor(list_reduce(
      list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT for x in string_split(conv_id::VARCHAR, '')]),
      lambda crc, x: list_reduce(list_prepend(xor(crc, x), [k::BIGINT for k in range(8)]),
        lambda a, k: xor(a >> 1, (a & 1) * 3988292384))), 4294967295) % 6 AS h
  FROM c),
r AS (
  SELECT h.conv_id, list_concat(coalesce(b.own, [])[1:h.h], h.own[h.h + 1:]) AS turns
  FROM h LEFT JOIN c b ON b.conv_id = h.base),
p AS (
  SELECT conv_id, d AS depth, len(turns) AS n, md5(turns[1:d]::VARCHAR || d) AS node,
    CASE WHEN d > 0 THEN md5(turns[1:d - 1]::VARCHAR || (d - 1)) END AS parent,
    CASE WHEN d > 0 THEN length(turns[d].text) ELSE 0 END AS points
  FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM r)),
n AS (
  SELECT node, min(conv_id) AS conv_id, min(depth) AS depth, min(parent) AS parent, count(*) AS n_convs,
    min(points) AS points,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '') AS ends
  FROM p GROUP BY node),
k AS (SELECT parent AS node, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY 1),
a AS (SELECT DISTINCT u.node AS above, v.node AS node FROM p u JOIN p v USING (conv_id) WHERE u.depth <= v.depth),
s AS (
  SELECT a.above AS node, count(*) FILTER (k.node IS NULL) AS n_leaves,
    sum((n.n_convs - 1) * n.points)::BIGINT AS saved_tokens
  FROM a JOIN n USING (node) LEFT JOIN k USING (node) GROUP BY 1)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
  s.n_leaves, s.saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN s USING (node) LEFT JOIN k USING (node) LEFT JOIN n up ON up.node = n.parent
"""
