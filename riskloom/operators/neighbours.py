"""Exact k nearest neighbours of every row among all rows, by space partition and box pruning.

1. Equal vectors become one, which keeps its ``k + 1`` smallest keys, so a group of copies of any size is one point.
2. The points are put in an order that keeps near ones together (the skew-safe ordered scan): by the pattern of the columns
   that hold only 0 and 1, then by the nearest of at most ``max_pivots`` pivots, then by the distance from it.  The order is
   cut into rings of equal size: a sixteenth of the points, but from ``ring_rows`` to 32 times as many.
3. Each ring is searched within itself: the k-th distance found bounds how far a point must look.
4. A point is sent only to rings of which its ball can reach a box (least and greatest value by column of a 64th or so of
   the ring).  Rings asked by many points are answered in parts, and only with what lies inside the ball.
5. The lists are merged and the keys of equal vectors put back.

Inside a ring, and between a ring and a part of its askers, both sides are cut into leaves of like points, and only leaves
whose boxes are near enough are compared.  No pair of points is formed outside such a ring-and-part group, and no group
grows beyond 32 ``ring_rows``.  A point is sent to no more than one row per ring, so up to 16 * 32 * ``ring_rows`` points
what is sent grows as the points do.  What goes to the driver and the tasks is the pivots and at most 64 boxes per ring.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_table
from .ordered import ordered_scan

_LIST = "array<struct<distance: double, id: long>>"


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances, summed column by column so that each pair's value depends on nothing else."""
    total = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        total += np.subtract.outer(a[:, j], b[:, j]) ** 2
    return np.sqrt(total)


def _closest(queries: np.ndarray, own: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int, within: np.ndarray | None = None) -> list[list[tuple[float, int]]]:
    """``_closest_array`` as lists of (distance, id)."""
    return [[(n["distance"], n["id"]) for n in found] for found in _closest_array(queries, own, points, ids, k, within).to_pylist()]


def _closest_array(queries: np.ndarray, own: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int, within: np.ndarray | None = None, rows: int = 256) -> pa.ListArray:
    """For each query the k closest of ``points`` other than itself, by (distance, id); those farther than its ``within`` are left out."""
    ready = _ready(points)
    found = [_closest_pairs(queries[s : s + rows], own[s : s + rows], points, ids, ready, k, None if within is None else within[s : s + rows]) for s in range(0, len(queries), rows)]
    return _lists(len(queries), [(at + n * rows, d, other) for n, (at, d, other) in enumerate(found)])


def _ready(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(centre, points less the centre with minus half of their square as a last column)."""
    with np.errstate(over="ignore", invalid="ignore"):
        centre = points.mean(0) if len(points) else np.zeros(points.shape[1])
        centre[~np.isfinite(centre)] = 0.0
        moved = points - centre
        return centre, np.column_stack([moved, (moved**2).sum(1) / -2])


def _closest_pairs(q: np.ndarray, own: np.ndarray, points: np.ndarray, ids: np.ndarray, ready: tuple[np.ndarray, np.ndarray], k: int, within: np.ndarray | None, some: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the query, distance, id) of what ``_closest_array`` finds among ``some`` of the points, ordered by query, distance and id.

    One matrix product gives half of (|q|^2 - distance^2) of all pairs up to rounding.  It only rules out points that are
    farther, by more than that rounding, than the k-th or than ``within``; the others' distances are summed column by
    column and decide.
    """
    size, (centre, moved) = q.shape[1], ready
    if some is not None:
        moved = moved[some]
    with np.errstate(over="ignore", invalid="ignore"):
        a = q - centre
        length = (a**2).sum(1)
        half = np.column_stack([a, np.ones(len(a))]) @ moved.T
        # Rounding of the centred values, of the product and of the squares.
        slack = 1e-15 * (size + 9) * 4 * (length - 2 * moved[:, -1].min(initial=0.0) + (centre**2).sum())
        limit = (np.full(len(q), np.inf) if within is None else within) ** 2 * (1 + 1e-12) + slack
    if np.isfinite(slack).all():
        loose = np.flatnonzero(~np.isfinite(limit))
        if len(loose) and len(moved) > k + 1:  # the query itself may be one of k + 1
            nth = np.partition(half[loose], len(moved) - k - 1, axis=1)[:, len(moved) - k - 1]
            limit[loose] = length[loose] - 2 * nth + 2 * slack[loose]
        at, other = np.nonzero(half >= ((length - limit) / 2)[:, None])
    else:  # squares that overflow rule nothing out
        at, other = np.nonzero(np.ones(half.shape, bool))
    if some is not None:
        other = some[other]
    keep = own[at] != ids[other]
    at, other = at[keep], other[keep]
    total = np.zeros(len(at))
    with np.errstate(over="ignore"):
        for j in range(size):
            total += (q[at, j] - points[other, j]) ** 2
    d = np.sqrt(total)
    keep = d < np.inf if within is None else (d < np.inf) & (d <= within[at])
    at, d, other = at[keep], d[keep], ids[other[keep]]
    order = np.lexsort((other, d, at))
    at, d, other = at[order], d[order], other[order]
    first = np.arange(len(at)) - np.searchsorted(at, at) < k
    return at[first], d[first], other[first]


def _lists(number: int, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.ListArray:
    """The lists of ``number`` queries from (place, distance, id) pieces; the pieces of one query are in one of them, in order."""
    at, d, other = (np.concatenate([f[i] for f in found] or [np.zeros(0, t)]) for i, t in enumerate((np.int64, np.float64, np.int64)))
    order = np.argsort(at, kind="stable")
    ends = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=number))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(d[order], pa.float64()), pa.array(other[order], pa.int64())], names=["distance", "id"]))


def _leaves(x: np.ndarray, rows: int = 256, patterns: bool = True) -> list[np.ndarray]:
    """Places of the rows of ``x``, cut into groups of at most ``rows`` like ones: by the columns of two values (with ``patterns``), then by halving the column that varies most."""
    if not len(x):
        return []
    low, high = x.min(0), x.max(0)
    two = ((x == low) | (x == high)).all(0) & (low < high) & patterns
    order = np.lexsort((x[:, two] == high[two]).T) if two.any() else np.arange(len(x))
    starts = 1 + np.flatnonzero((np.diff((x[order][:, two] == high[two]).astype(np.int8), axis=0) != 0).any(1)) if two.any() else []
    out, todo = [], np.split(order, starts)
    while todo:
        part = todo.pop()
        if len(part) <= rows:
            out.append(part)
            continue
        with np.errstate(over="ignore", invalid="ignore"):
            spread = np.ptp(x[part], axis=0) if not np.isfinite(v := x[part].var(0)).all() else v
        cut = np.argpartition(x[part, spread.argmax()], len(part) // 2)
        todo += [part[cut[: len(part) // 2]], part[cut[len(part) // 2 :]]]
    return out


def _boxes(x: np.ndarray, leaves: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([x[i].min(0) for i in leaves]), np.array([x[i].max(0) for i in leaves])


def _apart(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """A lower bound of the distance between points of each box of the first kind and of the second; rounding never makes it too large."""
    total = np.zeros((len(low), len(lows)))
    with np.errstate(over="ignore"):
        for j in range(low.shape[1]):
            total += np.maximum(np.maximum(np.subtract.outer(low[:, j], highs[:, j]), -np.subtract.outer(high[:, j], lows[:, j])), 0.0) ** 2
    total[~np.isfinite(total)] = 0.0
    return np.sqrt(total) * (1 - 1e-9) - 1e-12


def _closest_of_leaves(queries: np.ndarray, own: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int, ball: np.ndarray | None = None) -> pa.ListArray:
    """``_closest_array`` by leaves: those of ``points`` whose box no ball of a leaf of ``queries`` reaches are not looked at.

    Without ``ball`` the queries are the points, and each one's k-th distance within its leaf is its ball.
    """
    if ball is None:
        mine = leaves = _leaves(queries)
        ball = np.full(len(queries), np.inf)
        for leaf in leaves:
            at, d, _ = _closest_pairs(queries[leaf], own[leaf], queries[leaf], own[leaf], _ready(queries[leaf]), k, None)
            last = np.flatnonzero(np.bincount(at, minlength=len(leaf)) == k)
            ball[leaf[last]] = d[np.searchsorted(at, last, "right") - 1]
    else:
        leaves = _leaves(points)
        # One far point must not make a leaf look everywhere: a leaf holds balls of like size.
        mine = [part[leaf] for part in np.array_split(np.argsort(ball, kind="stable"), 4) for leaf in _leaves(queries[part])]
    if not mine or not leaves:
        return _lists(len(queries), [])
    reach = _apart(*_boxes(queries, mine), *_boxes(points, leaves)) <= np.array([ball[i].max() for i in mine])[:, None]
    found, ready = [], _ready(points)
    for leaf, near in zip(mine, reach):
        others = [leaves[i] for i in np.flatnonzero(near)]
        if others:
            at, d, other = _closest_pairs(queries[leaf], own[leaf], points, ids, ready, k, ball[leaf], np.concatenate(others))
            found.append((leaf[at], d, other))
    return _lists(len(queries), found)


def _batch(names: list[str], columns: list, types: list) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


_ARROW_LIST = pa.list_(pa.struct([("distance", pa.float64()), ("id", pa.int64())]))


def _distinct_points(points: DataFrame, k: int) -> DataFrame:
    """(id, vector, ids): a row per different vector, with its k + 1 smallest keys; id is the first."""
    order = Window.partitionBy("vector").orderBy("key")
    first = points.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k + 1)
    ids = F.array_sort(F.collect_list("key"))
    return first.groupBy("vector").agg(ids.alias("ids")).select(F.col("ids")[0].alias("id"), "vector", "ids")


def nearest_neighbours(points: DataFrame, key: str, vector: str, k: int, max_pivots: int = 256, ring_rows: int = 1024, part_rows: int = 16384) -> DataFrame:
    """(key, neighbours): for each row of ``points`` its k nearest others as an array of (distance, id), nearest first.

    ``key`` is a unique integer, ``vector`` an array of doubles of one length.  Ties go to the smaller key.  Rows whose
    key, vector or a component is null or not finite take no part; with fewer than k others all of them are given.
    """
    clean = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    points = points.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).where(clean)
    # Zero of either sign is one vector.
    points = scratch_table(points.select(F.col(key).cast("long").alias("key"), F.transform(vector, lambda x: x + F.lit(0.0)).alias("vector")), "points")
    distinct = scratch_table(_distinct_points(points, k), "distinct")
    number = distinct.count()
    if not number:
        return points.select("key", F.lit(None).cast(_LIST).alias("neighbours"))
    pivots = min(max_pivots, max(1, round((number / ring_rows) ** 0.5 * 4)))
    chosen = distinct.select("id", "vector").orderBy(F.xxhash64("id"), "id").limit(pivots).collect()
    centre = np.array([r["vector"] for r in chosen], np.float64).reshape(len(chosen), -1)
    size = max(ring_rows, min(-(-number // 16), 32 * ring_rows))
    rings = scratch_table(_rings(distinct.select("id", "vector"), centre, size), "rings")
    own = scratch_table(_within_rings(rings, k), "own")
    asked = scratch_table(_asked(own, _extent(rings), k), "asked")
    found = own.select("id", F.explode("found").alias("n")).unionByName(_answers(asked, rings, k, part_rows).select("id", F.explode("found").alias("n")))
    best = found.withColumn("_r", F.row_number().over(Window.partitionBy("id").orderBy("n.distance", "n.id"))).where(F.col("_r") <= k)
    return _per_row(points, distinct, scratch_table(best.select("id", "n.distance", F.col("n.id").alias("other")), "best"), k)


def _spread(df: DataFrame, *by: str) -> DataFrame:
    """Dealt to as many tasks as shuffles have: few bytes can be much work, so their number of tasks does not follow the bytes."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def _marks(distinct: DataFrame, size: int) -> np.ndarray:
    """Places of the columns that hold 0 and 1 only."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = np.ones(size, bool)
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                only &= ((x == 0.0) | (x == 1.0)).all(0)
        yield pa.RecordBatch.from_arrays([pa.array([only.tolist()], pa.list_(pa.bool_()))], names=["only"])

    found = distinct.select("vector").mapInArrow(look, "only array<boolean>").distinct().collect()  # at most one row per task
    return np.flatnonzero(np.all([r["only"] for r in found], axis=0))


def _rings(distinct: DataFrame, centre: np.ndarray, size: int) -> DataFrame:
    """(id, vector, ring): the points in an order that keeps near ones together, cut into rings of ``size``."""
    marks = _marks(distinct, centre.shape[1])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(1))
                d = _distances(x, centre)
                cell = d.argmin(1)
                pattern = [row.tobytes() for row in np.packbits(x[:, marks] == 1.0, axis=1)]
                columns = [*batch.columns, pa.array(pattern, pa.binary()), pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell])]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "vector", "pattern", "cell", "radius"])

    placed = _spread(distinct).mapInArrow(place, "id long, vector array<double>, pattern binary, cell int, radius double")
    ranked = ordered_scan(placed, [], [F.col("pattern"), F.col("cell"), F.col("radius"), F.col("id")], rank_col="_r")
    return ranked.select("id", "vector", F.floor((F.col("_r") - 1) / size).cast("int").alias("ring"))


def _extent(rings: DataFrame, number: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ring, low, high): boxes that hold the points of each ring, at most ``number`` of a ring."""

    def box(table: pa.Table) -> pa.Table:
        x = _matrix(table.column("vector"))
        low, high = _boxes(x, _leaves(x, max(16, -(-2 * len(x) // number)), patterns=False))
        ring = np.full(len(low), table.column("ring")[0].as_py(), np.int32)
        return pa.Table.from_arrays([pa.array(ring), *[pa.array(v.tolist(), pa.list_(pa.float64())) for v in (low, high)]], names=["ring", "low", "high"])

    boxes = _spread(rings, "ring").groupBy("ring").applyInArrow(box, "ring int, low array<double>, high array<double>").collect()
    boxes = sorted(boxes, key=lambda r: (r["ring"], r["low"], r["high"]))
    return np.array([r["ring"] for r in boxes]), np.array([r["low"] for r in boxes]), np.array([r["high"] for r in boxes])


def _within_rings(rings: DataFrame, k: int) -> DataFrame:
    """(id, vector, ring, found): what each point finds in its own ring."""

    def search(table: pa.Table) -> pa.Table:
        ids, vectors = table.column("id").to_numpy(), _matrix(table.column("vector"))
        return table.select(["id", "vector", "ring"]).append_column("found", _closest_of_leaves(vectors, ids, vectors, ids, k))

    return _spread(rings, "ring").groupBy("ring").applyInArrow(search, f"id long, vector array<double>, ring int, found {_LIST}")


def _asked(own: DataFrame, extent: tuple[np.ndarray, np.ndarray, np.ndarray], k: int) -> DataFrame:
    """(id, vector, ring, ball): the other rings that each point's ball reaches, and its radius."""
    boxed, lows, highs = extent
    numbers, first = np.unique(boxed, return_index=True)

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                vectors = _matrix(part.column(1))
                # The k-th distance found; a ring of k points or fewer bounds nothing.
                found, ball = part.column(3), np.full(part.num_rows, np.inf)
                lengths = found.value_lengths().to_numpy(zero_copy_only=False)
                full = np.flatnonzero(lengths == k)
                ball[full] = found.flatten().field("distance").to_numpy()[np.cumsum(lengths)[full] - 1]
                same = numbers[None, :] == part.column(2).to_numpy()[:, None]
                apart = np.minimum.reduceat(_apart(vectors, vectors, lows, highs), first, axis=1)
                q, target = np.nonzero((apart <= ball[:, None]) & ~same)
                take = part.take(pa.array(q))
                yield pa.RecordBatch.from_arrays([take.column(0), take.column(1), pa.array(numbers[target].astype(np.int32)), pa.array(ball[q])], names=["id", "vector", "ring", "ball"])

    return _spread(own).mapInArrow(reach, "id long, vector array<double>, ring int, ball double")


def _answers(asked: DataFrame, rings: DataFrame, k: int, part_rows: int) -> DataFrame:
    """(id, found): what each point finds inside its ball in each ring it asks, if anything; a ring is answered in parts of about ``part_rows`` askers."""
    load = scratch_table(asked.groupBy("ring").agg(F.ceil(F.count(F.lit(1)) / part_rows).cast("int").alias("parts")), "load")
    askers = asked.join(load, "ring").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).drop("parts")
    held = rings.join(load, "ring").select("id", "vector", "ring", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _batch(["id", "found"], [[], []], [pa.int64(), _ARROW_LIST])
        ids = left.column("id").to_numpy()
        found = _closest_of_leaves(_matrix(left.column("vector")), ids, _matrix(right.column("vector")), right.column("id").to_numpy(), k, left.column("ball").to_numpy())
        hit = np.flatnonzero(np.diff(found.offsets.to_numpy()))
        return pa.Table.from_arrays([pa.array(ids[hit]), found.take(pa.array(hit))], names=["id", "found"])

    by = ["ring", "part"]
    return _spread(askers, *by).groupBy(*by).cogroup(_spread(held, *by).groupBy(*by)).applyInArrow(answer, f"id long, found {_LIST}")


def _per_row(points: DataFrame, distinct: DataFrame, best: DataFrame, k: int) -> DataFrame:
    """Neighbours of each row: its equals first, then the keys of the nearest other vectors."""
    others = best.join(distinct.select(F.col("id").alias("other"), "ids"), "other")
    apart = others.groupBy("id").agg(F.array_sort(F.flatten(F.collect_list(F.transform("ids", lambda x: F.struct(F.col("distance"), x.alias("id")))))).alias("apart"))
    known = distinct.join(apart, "id", "left").select("vector", "ids", F.slice(F.coalesce("apart", F.array().cast(_LIST)), 1, k).alias("apart"))
    equals = F.transform(F.filter("ids", lambda x: x != F.col("key")), lambda x: F.struct(F.lit(0.0).alias("distance"), x.alias("id")))
    return points.join(known, "vector").select("key", F.slice(F.concat(equals, F.col("apart")), 1, k).alias("neighbours"))
