"""Conversation prefix trie: nodes by prefix digests, subtree totals by depth bands.

``rebuilt_turns`` numbers each conversation's turns (``ordered.row_rank``, so a conversation of any length is cut
across tasks) and rebuilds conversations with shared openings.  A node is a distinct sequence of first turns.  Its
id chains the digests of its turns; chains are computed in groups of at most ``height`` turns of a conversation,
groups of groups where that is not enough, so no group grows with a conversation.

The rollup goes by bands of ``height`` depths.  Each node explodes only to its ancestors within its band, at most
``height`` of them, which completes the totals inside every band at once.  Then the totals of band roots go up
band by band, deepest first, on the few rows of the roots alone, and a last explosion hands each completed root
to the ancestors it has in the band above.  With a height of at least the square root of the depth neither the rounds nor
the explosion exceed that.

The hash over a node's ending conversations is computed in order but never from a list of them: ranges of (node,
conversation) are joined to text chunks in parallel and one hash object a node reads the chunks in order.

Defined cases: null roles and texts are empty; null turns stand first; equal turn numbers stand in the order of the
digest of role and text, so repeated rows are repeated turns; rows without conv_id belong to no conversation; a
rebuilt conversation without turns is a member of the root alone; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import row_rank
from .common import in_slices, join_hot, materialise, read_table, scratch_path

#: Turns at most that a rebuilt conversation can take from another.
SHARED = 8


def digest(value: Column) -> Column:
    """The first 16 bytes of the SHA-256 of a string or binary column."""
    return F.unhex(F.substring(F.sha2(value, 256), 1, 32))


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos, digest, bytes, last) of each rebuilt turn, pos 0 being the root; and (conv_id, n) of each conversation."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    known = digest(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    rows = turns.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), "turn", known.alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    ordered = materialise(row_rank(rows, ["conv_id"], "turn", ["digest"], rank_col="pos").drop("turn"), "ordered")
    own = ordered.groupBy("conv_id").agg(F.max("pos").alias("own"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (SHARED + 1)
    own = materialise(own.select("conv_id", "own", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % 5).alias("base")), "own")
    bases = own.select(F.col("conv_id").alias("base"), F.col("own").alias("base_turns"))
    shared = F.least("h", F.coalesce("base_turns", F.lit(0)))
    n = F.col("shared") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    convs = materialise(own.join(bases, "base", "left").withColumn("shared", shared).withColumn("n", n), "convs")
    later = join_hot(ordered, convs.select("conv_id", "h", "shared", "n"), ["conv_id"], F.col("pos"), how="inner").where("pos > h")
    later = later.select("conv_id", (F.col("shared") + F.col("pos") - F.col("h")).alias("pos"), "digest", "bytes", "n")
    # A base has at most nine followers, and at most eight of its turns are shared.
    opening = ordered.where(F.col("pos") <= SHARED).withColumnRenamed("conv_id", "base")
    first = opening.join(convs.select("conv_id", "base", "h", "n"), "base").where("pos <= h").select("conv_id", "pos", "digest", "bytes", "n")
    root = convs.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(b"").alias("digest"), F.lit(0).cast("long").alias("bytes"), "n")
    both = later.unionByName(first).unionByName(root)
    return both.select("conv_id", "pos", "digest", "bytes", (F.col("pos") == F.col("n")).alias("last")), convs.select("conv_id", "n")


def grouped(rows: DataFrame, fan: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """(conv_id, pos, digest, ...) -> (conv_id, band, path): rows of ``fan`` following positions as one ordered array."""
    path = F.array_sort(F.collect_list(F.struct("pos", "digest", *extra))).alias("path")
    return rows.groupBy("conv_id", F.floor(F.col("pos") / fan).cast("long").alias("band")).agg(path)


def chained(bands: DataFrame, fan: int, last_band: int) -> DataFrame:
    """``bands`` with ``start``, the id of what stands before a band, and ``ids``, those of its positions."""
    if last_band == 0:
        started = bands.withColumn("start", F.lit(b""))
    else:
        whole = F.aggregate("path", F.lit(b""), lambda acc, x: F.concat(acc, x["digest"]))
        above = grouped(bands.select("conv_id", F.col("band").alias("pos"), digest(whole).alias("digest")), fan)
        above = chained(materialise(above, "bands"), fan, last_band // fan)
        before = above.select("conv_id", F.posexplode("ids").alias("k", "start"), "band").select("conv_id", (F.col("band") * fan + F.col("k") + 1).alias("band"), "start")
        started = bands.join(before, ["conv_id", "band"], "left").withColumn("start", F.coalesce("start", F.lit(b"")))
    step = lambda acc, x: F.concat(acc, F.array(digest(F.concat(F.element_at(acc, -1), x["digest"]))))
    chain = F.aggregate("path", F.array(F.col("start")), step)
    return started.withColumn("ids", F.slice(chain, 2, F.size("path")))


def trie_nodes(rows: DataFrame, depth: int, height: int) -> tuple[DataFrame, DataFrame]:
    """Nodes (id, depth, parent, up: ancestors within the band from its root on, bytes, conv_id, n_convs), and (id, conv_id) where a conversation ends."""
    bands = materialise(chained(materialise(grouped(rows, height, ("bytes", "last")), "paths"), height, depth // height), "chains")
    # The parent of a band's first node is the last node of the band before.
    ahead = bands.select("conv_id", (F.col("band") + 1).alias("band"), F.element_at("ids", -1).alias("ahead"))
    bands = bands.join(ahead, ["conv_id", "band"], "left") if depth >= height else bands.withColumn("ahead", F.lit(None).cast("binary"))
    at = bands.select("conv_id", "ahead", "ids", F.posexplode("path").alias("k", "turn"))
    own, k = F.expr("ids[k]"), F.col("k")
    parent = F.when(k == 0, F.col("ahead")).otherwise(F.expr("ids[k - 1]"))
    seen = at.select(own.alias("id"), F.col("turn.pos").alias("depth"), parent.alias("parent"), F.slice("ids", F.lit(1), k).alias("up"), F.col("turn.bytes").alias("bytes"), "conv_id", "turn.last")
    # The other columns follow from the id; as keys they leave sums of fixed width, which hash aggregation takes.
    nodes = seen.groupBy("id", "depth", "parent", "up", "bytes").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    return nodes, seen.where("last").select("id", "conv_id")


def subtree_totals(nodes: DataFrame, values: list[str], depth: int, height: int) -> DataFrame:
    """(id, values): sums over the subtrees of ``nodes`` (id, depth, parent, up, values)."""
    sums = [F.sum(v).alias(v) for v in values]
    own = nodes.select("id", F.explode(F.concat("up", F.array("id"))).alias("top"), *values)
    inside = materialise(own.groupBy(F.col("top").alias("id")).agg(*sums), "inside")
    if depth < height:
        return inside
    roots = nodes.where((F.col("depth") % height == 0) & (F.col("depth") > 0)).select("id", "parent", (F.col("depth") / height).cast("int").alias("band"))
    last = nodes.where(F.col("depth") % height == height - 1).select(F.col("id").alias("parent"), F.concat("up", F.array("id")).alias("chain"))
    path = scratch_path(nodes.sparkSession, "band-roots")
    roots.join(last, "parent").join(inside, "id").select("id", "chain", *values, "band").write.partitionBy("band").parquet(path)
    roots = nodes.sparkSession.read.parquet(path)
    below: DataFrame | None = None
    complete = []
    for band in range(depth // height, 0, -1):
        here = roots.where(F.col("band") == band).select("id", "chain", *values)
        if below is not None:
            added = below.groupBy(F.col("chain")[0].alias("id")).agg(*[F.sum(v).alias(f"_{v}") for v in values])
            here = here.join(added, "id", "left").select("id", "chain", *[(F.col(v) + F.coalesce(f"_{v}", F.lit(0))).alias(v) for v in values])
        below = materialise(here, "band")
        complete.append(below)
    every = complete[0]
    for more in complete[1:]:
        every = every.unionByName(more)
    handed = every.select(F.explode("chain").alias("id"), *values)
    return inside.unionByName(handed).groupBy("id").agg(*sums)


def ordered_hash(ends: DataFrame, chunk: int = 1 << 16) -> DataFrame:
    """(id, conv_id) -> (id, sha256): the hash of each id's conv_ids in ascending order, as decimals joined by commas."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, parts, size = None, None, [], 0
        out: list[tuple] = []

        def flush() -> None:
            if parts:
                out.append((now, first, ",".join(parts)))

        for batch in in_slices(batches, 4096):
            for i, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if i != now or size >= chunk:
                    flush()
                    now, first, parts, size = i, c, [], 0
                parts.append(str(c))
                size += len(parts[-1]) + 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.string()))], names=["id", "first", "part"])
                out.clear()
        flush()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.string()))], names=["id", "first", "part"])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, h = None, None
        out: list[tuple] = []
        for batch in in_slices(batches, 256):
            for i, part in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if i != now:
                    if h is not None:
                        out.append((now, h.hexdigest()))
                    now, h = i, hashlib.sha256()
                else:
                    h.update(b",")
                h.update(part.encode())
            if len(out) > 4096:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.binary(), pa.string()))], names=["id", "sha256"])
                out.clear()
        if h is not None:
            out.append((now, h.hexdigest()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.binary(), pa.string()))], names=["id", "sha256"])

    ranged = ends.repartitionByRange("id", "conv_id").sortWithinPartitions("id", "conv_id")
    parts = ranged.mapInArrow(chunks, "id binary, first long, part string")
    return parts.repartition("id").sortWithinPartitions("id", "first").mapInArrow(hashes, "id binary, sha256 string")


def prefix_trie(turns: DataFrame, least_height: int = 8) -> DataFrame:
    """A row per node of the trie of the rebuilt conversations of ``turns`` (conv_id, turn, role, text); see the module."""
    rows, convs = rebuilt_turns(turns)
    depth = convs.agg(F.max("n")).first()[0]
    depth = 0 if depth is None else int(depth)
    height = max(least_height, math.isqrt(depth) + 1)
    nodes, ends = trie_nodes(rows, depth, height)
    nodes = materialise(nodes, "nodes")
    children = nodes.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = nodes.withColumn("n_leaves", (F.col("n_children") == 0).cast("long")).withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("bytes"))
    nodes = materialise(nodes, "nodes")
    totals = subtree_totals(nodes.select("id", "depth", "parent", "up", "n_leaves", "saved_tokens"), ["n_leaves", "saved_tokens"], depth, height)
    # Both sides are scans or sums of scans, so adaptive execution can split the children of a hot parent.
    parents = nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.drop("n_leaves", "saved_tokens").join(parents, "parent", "left").join(totals, "id").join(ordered_hash(ends), "id", "left")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha256", none).alias("ends_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read_table(spark, sf_dir, "conversations"))


#: Turn lists as lists of digests; a node is a list's beginning.  CRC-32 goes bit by bit.
ORACLE = """
WITH t AS (
  SELECT conv_id AS c, sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS d, octet_length(encode(coalesce(text, ''))) AS b, turn
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, d, b, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, substr(d, 1, 32)) AS p FROM t),
l AS (SELECT c, list({'d': d, 'b': b} ORDER BY p) AS own FROM o GROUP BY c),
k AS (
  SELECT c, own, xor(list_reduce(list_concat([4294967295], flatten(list_transform(range(1, length(c::VARCHAR) + 1), lambda i: list_transform(range(8), lambda j: (ascii(substr(c::VARCHAR, i, 1)) >> j) & 1)))),
      lambda x, y: xor(x >> 1, CASE WHEN (xor(x, y) & 1) = 1 THEN 3988292384 ELSE 0 END)), 4294967295) % 9 AS h
  FROM l),
r AS (SELECT k.c, list_concat(coalesce(s.own[1:k.h], []), k.own[k.h + 1:]) AS path FROM k LEFT JOIN l s ON s.c = k.c - k.c % 5),
m AS (SELECT c, path[1:i] AS node, i AS depth, i = len(path) AS last FROM (SELECT c, path, unnest(range(0, len(path) + 1)) AS i FROM r)),
n AS (
  SELECT node, depth, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * coalesce(node[-1].b, 0) AS saved,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '')) AS ends
  FROM m GROUP BY node, depth),
ch AS (SELECT node[1:depth - 1] AS node, count(*) AS n FROM n WHERE depth > 0 GROUP BY 1),
x AS (SELECT n.*, coalesce(ch.n, 0) AS n_children FROM n LEFT JOIN ch USING (node)),
up AS (SELECT node[1:i] AS node, sum(saved) AS saved, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS leaves FROM (SELECT *, unnest(range(0, depth + 1)) AS i FROM x) GROUP BY 1)
SELECT x.conv_id, x.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, x.n_convs, x.n_children, up.leaves::BIGINT AS n_leaves, up.saved::BIGINT AS saved_tokens, x.ends AS ends_sha256
FROM x JOIN up USING (node) LEFT JOIN n p ON x.depth > 0 AND p.node = x.node[1:x.depth - 1]
"""
