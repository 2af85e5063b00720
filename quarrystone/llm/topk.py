"""Exact top-k by inner product with pivot tables.

Integer vectors are set into a metric: with one more component that gives every candidate the same length,
the largest inner product is the smallest Euclidean distance.  The distances of every candidate to
``PIVOTS`` pivots are computed once and kept in a table.  By the triangle inequality the largest
difference between a query's and a candidate's distances to a pivot is a lower bound; a query evaluates
candidates in the order of their bounds and stops when the next bound exceeds its k-th best distance.  Nothing
that could score as high is passed over, ties included.

Candidates are grouped by their nearest pivot, and of each group the smallest and largest distance to every pivot is
known.  Small groups of close pivots are bundled.  A query first searches the bundle of its own group; its k-th best
score there goes with it, and bundles of groups whose distances show that nothing in them can reach it never see the
query.  Bundles are cut into blocks by a hash of the id, the queries that come to a bundle likewise, and every pair of
blocks is a cell in which each query keeps its k best; these few are ranked in a window.  No block grows with the data.

Defined results: queries are the rows whose id ``every`` divides; vectors that are null or hold null or
non-finite components take no part; shorter vectors count as padded with zeros; rows with a null id take no
part; an id that is there several times counts once, with the least of its vectors by hash; scores are exact while
they stay below 2**53; a query with fewer than k candidates gets them all; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.scratch import written
from .common import group_starts, hash_sample, ref, require, whole_groups
from .vectors import binaries, dimension, matrix, rows, squared_distances, valid

K, EVERY, SCALE = 5, 50, 256
PIVOTS = 256
# Candidates for pivots: a hash sample of so many rows at most.
PIVOT_SAMPLE = 2_000
CANDIDATE_BLOCK, QUERY_BLOCK = 4_096, 512
# Candidates evaluated at first; the number doubles as long as bounds allow, up to the most at once.
FIRST, AT_ONCE = 32, 512
# Pivots whose distances are compared at once.
PIVOT_ROWS = 32


def choose_pivots(points: np.ndarray, count: int) -> np.ndarray:
    """Each next pivot is the point farthest from those chosen."""
    if not len(points):
        return points
    chosen = [int(squared_distances(points, points.mean(0, keepdims=True))[:, 0].argmax())]
    nearest = squared_distances(points, points[chosen])[:, 0]
    while len(chosen) < min(count, len(points)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared_distances(points, points[chosen[-1:]])[:, 0])
    return points[chosen]


def _scaled(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.floor(SCALE * matrix(batch.column(1), width)) + 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), binaries(x), pa.array((x * x).sum(1))], ["id", "vector", "square"]
            )

    return run


def _lifted(x: np.ndarray, square: np.ndarray, most: float) -> np.ndarray:
    return np.concatenate([x, np.sqrt(np.maximum(most - square, 0))[:, None]], 1)


def _homes(pivots: np.ndarray, width: int, most: float):
    """Each row with its nearest pivot, told by the pivot table; queries are not lifted, their further component is zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _lifted(rows(batch.column(1), "<f8", width), batch.column(2).to_numpy(), most)
            home = squared_distances(points, pivots).argmin(1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home)], [*batch.schema.names, "home"])

    return run


def _ranges(pivots: np.ndarray, width: int, most: float):
    """Of the rows of a task, for each group and pivot the smallest and largest distance; rows of the group at its own pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(pivots)
        low, high, size = np.full((n, n), np.inf), np.full((n, n), -np.inf), np.zeros(n, np.int64)
        for batch in batches:
            points = _lifted(rows(batch.column(1), "<f8", width), batch.column(2).to_numpy(), most)
            distances, home = np.sqrt(squared_distances(points, pivots)), batch.column(3).to_numpy()
            for g in np.unique(home):
                own = distances[home == g]
                low[g], high[g] = np.minimum(low[g], own.min(0)), np.maximum(high[g], own.max(0))
                size[g] += len(own)
        g, p = np.divmod(np.flatnonzero(np.repeat(size > 0, n)), n)
        columns = [g.astype(np.int32), p.astype(np.int32), low[g, p], high[g, p], np.where(g == p, size[g], 0)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["home", "pivot", "low", "high", "n"])

    return run


def bundled(pivots: np.ndarray, members: np.ndarray) -> np.ndarray:
    """A number for each group: small groups with pivots close to each other share one, up to a block of rows."""
    apart = squared_distances(pivots, pivots)
    number, rows_in, at = 0, 0, 0
    out, free = np.zeros(len(pivots), np.int64), np.ones(len(pivots), bool)
    for _ in range(len(pivots)):
        if rows_in and rows_in + members[at] > CANDIDATE_BLOCK:
            number, rows_in = number + 1, 0
        out[at], free[at] = number, False
        rows_in += members[at]
        at = int(np.where(free, apart[at], np.inf).argmin())
    return out


def _slack(offset: float) -> float:
    """More than rounding can add to a lower bound of a squared distance."""
    return 1e-6 * offset + 1e-3


def _reached(pivots: np.ndarray, width: int, most: float, low: np.ndarray, high: np.ndarray, bundle: np.ndarray):
    """Each query with the bundles of groups, its own left out, that may hold a score as high as its k-th best so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, square = rows(batch.column(1), "<f8", width), batch.column(2).to_numpy()
            home, least = batch.column(3).to_numpy(), batch.column(4).to_numpy()
            to = np.sqrt(squared_distances(np.c_[x, np.zeros(len(x))], pivots))
            regions = []
            for i in range(len(x)):
                bound = np.maximum(np.maximum(low - to[i], to[i] - high).max(1), 0) ** 2
                may = bound <= square[i] + most - 2 * least[i] + _slack(square[i] + most)
                other = np.unique(bundle[may])
                regions.append(other[other != bundle[home[i]]].astype(np.int32))
            lists = pa.array(regions, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "regions"])

    return run


def nearest(
    query: np.ndarray, own: int, x: np.ndarray, ids: np.ndarray, bounds: np.ndarray, offset: float, k: int, slack: float,
    least: float = -np.inf,
) -> tuple[np.ndarray, np.ndarray, int]:
    """Places and scores of the k best, ties to smaller ids, and how many candidates were evaluated.

    ``bounds`` are lower bounds of squared distances, which are ``offset`` less two scores.  Scores below ``least`` may
    be left out.
    """
    return _in_order(query, own, x, ids, np.argsort(bounds, kind="stable"), bounds, offset, k, slack, least)


def _in_order(
    query: np.ndarray, own: int, x: np.ndarray, ids: np.ndarray, order: np.ndarray, bounds: np.ndarray, offset: float, k: int,
    slack: float, least: float,
) -> tuple[np.ndarray, np.ndarray, int]:
    """:func:`nearest` of candidates whose order is known."""
    place, score, done, step = np.zeros(0, np.int64), np.zeros(0), 0, FIRST
    while done < len(order):
        reach = max(least, score[-1] if len(score) == k else -np.inf)
        some = order[done : done + step]
        some = some[: np.searchsorted(bounds[some], offset - 2 * reach + slack, side="right")]
        if not len(some):
            break
        done, step = done + len(some), min(step * 2, AT_ONCE)
        some = some[ids[some] != own]
        found = x[some] @ query
        may = found >= reach
        place, score = np.append(place, some[may]), np.append(score, found[may])
        best = np.lexsort((ids[place], -score))[:k]
        place, score = place[best], score[best]
    return place, score, done


def _coded(known: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Distances of candidates and queries to the pivots in equal steps, a row for each pivot, and the step's width."""
    low, high = min(known.min(), to.min()), max(known.max(), to.max())
    width = max((high - low) / 65_535, 1e-9)
    known, to = (((d - low) / width).astype(np.uint16).T for d in (known, to))
    return np.ascontiguousarray(known), np.ascontiguousarray(to), width


def _gaps(known: np.ndarray, far: np.ndarray) -> np.ndarray:
    """The largest difference of each candidate from the query over all pivots, in steps; rounding takes one at most."""
    gap = np.zeros(known.shape[1], known.dtype)
    over, under = (np.empty((min(PIVOT_ROWS, len(known)), len(gap)), known.dtype) for _ in range(2))
    for a in range(0, len(known), PIVOT_ROWS):
        some, own = known[a : a + PIVOT_ROWS], far[a : a + PIVOT_ROWS, None]
        n = len(some)
        np.subtract(np.maximum(some, own, out=over[:n]), np.minimum(some, own, out=under[:n]), out=over[:n])
        np.maximum(gap, over[:n].max(0), out=gap)
    return gap


def _search(width: int, pivots: np.ndarray, most: float, k: int):
    """The k best of every query in every cell, and in a row without id how many candidates it evaluated there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 0):
            cell, side, ids = (table.column(c).to_numpy() for c in range(3))
            x, square = rows(table.column(3), "<f8", width), table.column(4).to_numpy()
            least = table.column(5).to_numpy()
            edges = group_starts(cell)
            for a, b in zip(edges, edges[1:]):
                there, queries = a + np.flatnonzero(side[a:b] == 0), a + np.flatnonzero(side[a:b] == 1)
                if not len(there) or not len(queries):
                    continue
                own_x, own_ids = x[there], ids[there]
                # The pivot table of the block, once for all its queries.
                known = np.sqrt(squared_distances(_lifted(own_x, square[there], most), pivots))
                to = np.sqrt(squared_distances(np.c_[x[queries], np.zeros(len(queries))], pivots))
                known, to, unit = _coded(known, to)
                found: list[tuple[list, list, list, list]] = []
                for q, far in zip(queries, to.T):
                    gap = _gaps(known, far)
                    bounds = (np.maximum(gap - 1.0, 0) * unit) ** 2
                    offset = square[q] + most
                    # Whole numbers are sorted by their digits.
                    order = np.argsort(gap, kind="stable")
                    place, score, done = _in_order(
                        x[q], ids[q], own_x, own_ids, order, bounds, offset, k, _slack(offset), least[q]
                    )
                    n = len(place)
                    found.append((
                        [int(ids[q])] * (n + 1), [*own_ids[place].tolist(), None],
                        [*score.astype(np.int64).tolist(), None], [*[None] * n, done],
                    ))
                columns = [pa.array([v for f in found for v in f[c]], pa.int64()) for c in range(4)]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score", "evaluated"])

    return run


def exact_top_k(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    every: int = EVERY,
    evaluated: bool = False,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows with the highest inner products of every query.

    With ``evaluated`` also how many inner products with candidates the query took.
    """
    require(df, id_col, vector_col)
    own = df.select(ref(id_col).cast("bigint").alias("id"), ref(vector_col).alias("vector"))
    own = own.where("id is not null")
    width = dimension(own, "vector")
    schema = "id bigint, vector binary, square double"
    scaled = own.where(valid("vector")).mapInArrow(_scaled(width), schema)
    least = F.min(F.struct(F.xxhash64("vector").alias("hash"), "vector", "square")).alias("s")
    known = written(scaled.groupBy("id").agg(least).select("id", "s.vector", "s.square"))
    sizes = known.agg(F.count("*").alias("n"), F.max("square").alias("most")).first()
    most = sizes.most or 0.0
    sample = sorted((r.id, bytes(r.vector), r.square) for r in hash_sample(known, "id", PIVOT_SAMPLE, sizes.n).collect())
    points = np.frombuffer(b"".join(v for _, v, _ in sample), "<f8").reshape(len(sample), width)
    pivots = choose_pivots(_lifted(points, np.array([s for _, _, s in sample]), most), PIVOTS)
    kind = "query_id bigint, vec_id bigint, score bigint, evaluated bigint"
    if not len(pivots):
        empty = df.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint, evaluated bigint")
        return empty if evaluated else empty.drop("evaluated")
    table = written(known.mapInArrow(_homes(pivots, width, most), schema + ", home int"))
    # At most PIVOTS x PIVOTS rows, whatever the size of the table.
    ranges = table.mapInArrow(_ranges(pivots, width, most), "home int, pivot int, low double, high double, n bigint")
    low, high = np.full((len(pivots),) * 2, np.inf), np.full((len(pivots),) * 2, -np.inf)
    members = np.zeros(len(pivots), np.int64)
    merged = ranges.groupBy("home", "pivot").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
    for r in merged.collect():
        low[r.home, r.pivot], high[r.home, r.pivot] = r.low, r.high
        members[r.home] += r.n
    bundle = bundled(pivots, members)
    blocks = -(-np.bincount(bundle, members).astype(np.int64) // CANDIDATE_BLOCK)
    bundle_of = F.get(F.array(*[F.lit(int(b)) for b in bundle]), F.col("home"))

    def searched(queries: DataFrame) -> DataFrame:
        """The cells of queries (id, vector, square, least, region), a region being a bundle."""
        groups = np.zeros(len(blocks), np.int64)
        for r in queries.groupBy("region").count().collect():
            groups[r.region] = -(-r["count"] // QUERY_BLOCK)
        blocks_of, groups_of = (F.array(*[F.lit(int(v)) for v in side]) for side in (blocks, groups))
        most_blocks, most_groups = int(max(blocks.max(), 1)), int(max(groups.max(), 1))

        def cells(part: DataFrame, number: int) -> DataFrame:
            own_block, own_group = F.get(blocks_of, F.col("region")), F.get(groups_of, F.col("region"))
            place = lambda many: F.pmod(F.xxhash64("id", F.lit("block")), many)
            all_of = lambda many: F.explode(F.sequence(F.lit(0), many - 1))
            some = part.where((own_block > 0) & (own_group > 0))
            block, group = (place(own_block), all_of(own_group)) if number == 0 else (all_of(own_block), place(own_group))
            cut = some.withColumn("block", block).withColumn("group", group)
            cell = (F.col("region").cast("bigint") * most_blocks + F.col("block")) * most_groups + F.col("group")
            return cut.select(cell.alias("cell"), F.lit(number).alias("side"), "id", "vector", "square", "least")

        candidates = table.select("id", "vector", "square", F.lit(None).cast("double").alias("least"), bundle_of.alias("region"))
        both = cells(candidates, 0).unionByName(cells(queries, 1))
        return both.repartition("cell").sortWithinPartitions("cell", "side").mapInArrow(_search(width, pivots, most, k), kind)

    queries = table.where(F.col("id") % every == 0)
    first = written(searched(queries.withColumn("least", F.lit(float("-inf"))).withColumn("region", bundle_of)))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    kth = first.where("vec_id is not null").withColumn("rank", place).where(F.col("rank") == k)
    told = queries.join(kth.select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("least")), "id", "left")
    told = told.select("id", "vector", "square", "home", F.coalesce("least", F.lit(float("-inf"))).alias("least"))
    reach = told.mapInArrow(
        _reached(pivots, width, most, low, high, bundle), schema + ", home int, least double, regions array<int>"
    )
    spread = written(reach.select("id", "vector", "square", "least", F.explode("regions").alias("region")))
    found = first.unionByName(searched(spread))
    ordered = Window.partitionBy("query_id").orderBy(F.desc_nulls_last("score"), "vec_id")
    total = F.sum("evaluated").over(Window.partitionBy("query_id"))
    ranked = found.withColumn("rank", F.row_number().over(ordered)).withColumn("evaluated", total)
    best = ranked.where((F.col("rank") <= k) & F.col("vec_id").isNotNull())
    return best.select("query_id", "rank", "vec_id", "score", *(["evaluated"] if evaluated else []))
