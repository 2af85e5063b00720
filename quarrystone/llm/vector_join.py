"""Near duplicates among embeddings by product quantisation.

Vectors are scaled to length one and identical ones become one representative.  A coarse quantiser deals them
into inverted lists; what is left after the centre is coded in ``SUBSPACES`` parts of one byte.  Each
vector probes its own list and every list that a neighbour at the threshold could well lie in: those whose
border it is nearer to than ``SPREADS`` standard deviations of a random shift of that length.  In a list the
asymmetric distances of a probing vector to all members come from lookup tables; a member stays
a candidate if its distance is within the threshold plus the member's own quantisation error, which
is kept with its code, so that the codes lose no pair.  Candidates are decided by exact cosine in double precision.

Centres and codebooks are trained in the driver on a hash sample of at most ``SAMPLE`` vectors; every vector is
indexed.  Lists and their probes are cut into blocks, and each pair of a member block and a probe block is one
cell: one list may hold any share of all vectors.  Cells emit one row per vector.

Result: one row for each id: ``n_links``, the other vectors linked directly (identical ones included);
``component_id``, the smallest id reachable by links; ``kept``.

Defined results: vectors that are null, zero, or hold null or non-finite components link with nothing; shorter
vectors count as padded with zeros; rows with a null id have no result; an id that is there several times counts
once, with the least of its vectors by hash; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from ..plans.scratch import written
from .common import group_starts, hash_sample, ref, require, roots, whole_groups
from .components import components
from .vectors import binaries, dimension, kmeans, matrix, rows, squared_distances, valid

THRESHOLD = 0.95
SAMPLE = 20_000
# Vectors to a list on average, and the most lists a sample of that size can place.
LIST_SIZE, MAX_LISTS = 200, 4_096
SUBSPACES, CODES = 8, 256
COARSE_STEPS, CODE_STEPS = 8, 6
# How far over a border a list is still probed, in standard deviations of a shift spread over so many dimensions.
SPREADS, SPREAD_DIMENSIONS = 2.5, 64
MEMBER_BLOCK, PROBE_BLOCK = 1_024, 2_048


@dataclass
class Index:
    centres: np.ndarray
    books: list[np.ndarray]  # of each subspace
    width: int  # components, padded to whole subspaces
    reach: float  # the distance of two unit vectors at the threshold

    def residual_parts(self, x: np.ndarray) -> list[np.ndarray]:
        return np.split(x, len(self.books), axis=1)

    def probes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The list of each vector, and which lists it probes."""
        d = squared_distances(x, self.centres)
        own = d.argmin(1)
        apart = np.sqrt(squared_distances(self.centres, self.centres))[own]
        beyond = (d - d[np.arange(len(x)), own][:, None]) / np.maximum(2 * apart, 1e-12)
        near = beyond <= SPREADS * self.reach / np.sqrt(min(SPREAD_DIMENSIONS, self.width))
        near[np.arange(len(x)), own] = True
        return own, near

    def encode(self, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and how far what they stand for is from the residual."""
        codes, error = np.zeros((len(residual), len(self.books)), np.uint8), np.zeros(len(residual))
        for k, part in enumerate(self.residual_parts(residual)):
            d = squared_distances(part, self.books[k])
            codes[:, k] = d.argmin(1)
            error += d.min(1)
        return codes, np.sqrt(error)

    def lookups(self, residual: np.ndarray) -> np.ndarray:
        """Squared distances to every codeword: one table for each residual and subspace."""
        parts = zip(self.residual_parts(residual), self.books)
        return np.stack([squared_distances(part, book) for part, book in parts], 1)


def train(x: np.ndarray, total: int, threshold: float, seed: int = 3) -> Index:
    rng = np.random.default_rng(seed)
    centres = kmeans(x, int(np.clip(total // LIST_SIZE, 1, MAX_LISTS)), COARSE_STEPS, rng)
    near = np.concatenate([squared_distances(x[i : i + 4096], centres).argmin(1) for i in range(0, len(x), 4096)])
    parts = np.split(x - centres[near], SUBSPACES, axis=1)
    books = [kmeans(part, CODES, CODE_STEPS, rng) for part in parts]
    return Index(centres, books, x.shape[1], float(np.sqrt(2 - 2 * threshold)))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.maximum(np.abs(x).max(1, keepdims=True, initial=0), 1e-300)
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-300)


def _scaled(width: int, kind: str):
    """The components as they came, and a hash of the vector scaled to length one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), width)
            digests = [xxhash.xxh128_digest(u.tobytes()) for u in _unit(x) + 0.0]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), binaries(x.astype(kind))], ["id", "digest", "vector"]
            )

    return run


def _units(column: pa.Array | pa.ChunkedArray, kind: str, width: int) -> np.ndarray:
    return _unit(rows(column, kind, width).astype(np.float64))


def _placed(index: Index, kind: str):
    """Own list and probed lists of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 2048):
                some = batch.slice(a, 2048)
                own, near = index.probes(_units(some.column(1), kind, index.width))
                probes = [np.flatnonzero(r) for r in near]
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array(own.astype(np.int64)), pa.array(probes, pa.list_(pa.int64()))],
                    ["id", "vector", "copies", "own", "probes"],
                )

    return run


def _scan(index: Index, kind: str, threshold: float):
    """In each cell: probing vectors against members, by table lookup and then exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 0):
            cell, where, side, ids, copies, own = (table.column(k).to_numpy() for k in range(6))
            unit = _units(table.column(6), kind, index.width)
            bounds = group_starts(cell)
            out: list[list[np.ndarray]] = [[], [], []]
            for a, b in zip(bounds, bounds[1:]):
                members, seekers = a + np.flatnonzero(side[a:b] == 0), a + np.flatnonzero(side[a:b] == 1)
                if not len(members) or not len(seekers):
                    continue
                centre = index.centres[where[a]]
                codes, error = index.encode(unit[members] - centre)
                limit = (index.reach + error + 1e-6) ** 2
                found: list[tuple[np.ndarray, np.ndarray]] = []
                for s in range(0, len(seekers), 64):
                    tables = index.lookups(unit[seekers[s : s + 64]] - centre)
                    distance = tables[:, 0, codes[:, 0]]
                    for k in range(1, len(index.books)):
                        distance = distance + tables[:, k, codes[:, k]]
                    q, m = np.nonzero(distance <= limit)
                    q, m = seekers[s + q], members[m]
                    q, m = q[ids[q] != ids[m]], m[ids[q] != ids[m]]
                    exact = np.einsum("ij,ij->i", unit[q], unit[m]) >= threshold
                    found.append((q[exact], m[exact]))
                q, m = (np.concatenate(x) for x in zip(*found))
                if not len(q):
                    continue
                # The member counts the probing vector here only if it does not find it in that one's own list.
                sought, which = np.unique(m, return_inverse=True)
                back = ~index.probes(unit[sought])[1][which, own[q]]
                known, place = np.unique(ids[a:b], return_inverse=True)
                links = np.zeros(len(known), np.int64)
                np.add.at(links, place[q - a], copies[m])
                np.add.at(links, place[m - a][back], copies[q][back])
                root = roots(len(known), place[q - a], place[m - a])
                some = np.unique(np.concatenate([place[q - a], place[m - a]]))
                for column, values in zip(out, (known[some], known[root[some]], links[some])):
                    column.append(values)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["id", "root", "links"])

    return run


def _cells(placed: DataFrame) -> DataFrame:
    """cell, list, side (0 member, 1 probing), id, copies, own, vector."""
    base = placed.select("id", "copies", "own", "vector")
    seeking = placed.select("id", "copies", "own", "vector", F.explode("probes").alias("list"))
    sizes = (
        seeking.groupBy("list")
        .agg(F.count("*").alias("seekers"), F.sum((F.col("own") == F.col("list")).cast("bigint")).alias("members"))
        .select(
            "list",
            F.greatest(F.lit(1), F.ceil(F.col("members") / MEMBER_BLOCK)).alias("member_blocks"),
            F.ceil(F.col("seekers") / PROBE_BLOCK).alias("probe_blocks"),
        )
    )

    def side(rows: DataFrame, number: int, blocks: str, others: str) -> DataFrame:
        block = F.pmod(F.xxhash64("id", F.lit("block")), F.col(blocks))
        other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(others) - 1))
        cut = rows.join(sizes, "list").withColumn("block", block).withColumn("other", other)
        pair = ("block", "other") if number == 0 else ("other", "block")
        return cut.select(
            F.xxhash64("list", *pair).alias("cell"), "list", F.lit(number).alias("side"),
            "id", "copies", "own", "vector",
        )

    members = side(base.withColumn("list", F.col("own")), 0, "member_blocks", "probe_blocks")
    return members.unionByName(side(seeking, 1, "probe_blocks", "member_blocks"))


def similar_vectors(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD
) -> DataFrame:
    """vec_id, n_links, component_id, kept; see the module's text."""
    require(df, id_col, vector_col)
    own = df.select(ref(id_col).cast("bigint").alias("id"), ref(vector_col).alias("vector")).where("id is not null")
    width = -(-max(dimension(own, "vector"), 1) // SUBSPACES) * SUBSPACES
    usable = own.where(valid("vector") & F.exists("vector", lambda x: x != 0))
    # Single-precision input stays so on its way; all arithmetic is in double precision.
    kind = "<f4" if isinstance(own.schema["vector"].dataType.elementType, FloatType) else "<f8"
    scaled = usable.mapInArrow(_scaled(width, kind), "id bigint, digest binary, vector binary")
    least = F.min(F.struct("digest", "vector")).alias("s")
    known = written(scaled.groupBy("id").agg(least).select("id", "s.*"))
    classes = written(known.groupBy("digest").agg(F.min("id").alias("rep_id"), F.count("*").alias("copies")))
    reps = written(
        known.join(classes.select(F.col("rep_id").alias("id"), "copies"), "id").select("id", "vector", "copies")
    )
    total = reps.count()
    ids = own.select("id").distinct()
    if not total:
        return ids.select(
            F.col("id").alias("vec_id"), F.lit(0).cast("bigint").alias("n_links"),
            F.col("id").alias("component_id"), F.lit(True).alias("kept"),
        )
    chosen = hash_sample(reps.select("id", "vector"), "id", SAMPLE, total).collect()
    sample = np.frombuffer(b"".join(v for _, v in sorted((r.id, bytes(r.vector)) for r in chosen)), kind)
    index = train(_unit(sample.reshape(-1, width).astype(np.float64)), total, threshold)
    schema = "id bigint, vector binary, copies bigint, own bigint, probes array<bigint>"
    placed = written(reps.mapInArrow(_placed(index, kind), schema))
    ordered = _cells(placed).repartition("cell").sortWithinPartitions("cell", "side")
    decided = written(ordered.mapInArrow(_scan(index, kind, threshold), "id bigint, root bigint, links bigint"))
    linked = decided.groupBy("id").agg(F.sum("links").alias("links"))
    joined = components(decided.select(F.col("id").alias("a"), F.col("root").alias("b")))
    found = joined.withColumnRenamed("node", "id").join(linked, "id", "left")
    by_class = classes.join(found, classes.rep_id == found.id, "left").select(
        "digest", F.coalesce("component", "rep_id").alias("component_id"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    by_id = known.select("id", "digest").join(by_class, "digest").select("id", "component_id", "n_links")
    result = ids.join(by_id, "id", "left")
    component = F.coalesce("component_id", "id")
    return result.select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"), (F.col("id") == component).alias("kept"),
    )
