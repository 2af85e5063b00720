"""Concordant pairs by distributed counting over digits of the rank.

A pair of cells is concordant when the one with the larger x has the larger y.  The place of y among the distinct values is
read as digits of ``DIGIT_BITS`` bits: two ranks first differ at exactly one digit, so at each level the pairs are
those of equal higher digits and a rising digit, in the order of x.  All levels (three for 2**36 distinct values) are
rows of one table, sorted once by level, higher digits and x.

A task counts the pairs among its own rows and says how often each digit occurs in its first and last group.
Groups that reach over several tasks are then the same problem again, with the task in place of x and those totals in
place of the cells, a hundredth of the rows; it ends when no group reaches over tasks.  Rows of equal x stand in
falling order of the digit, where no pair rises, so ties need no care and a hot value may be cut anywhere.
"""

from __future__ import annotations

import sys
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import numbered
from .scratch import written

# Executors need no copy of the package to run the kernel.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIGIT_BITS = 12
# Rows a task sorts and counts; well above 2 * 2**DIGIT_BITS, so that every round is much smaller than the last.
TASK_ROWS = 250_000
_GROUP_BITS, _LEVEL_BITS = 44, 3
_ROWS = "key bigint, digit int, n double"


def rising_pairs(run: np.ndarray, digit: np.ndarray, weight: np.ndarray, bits: int = DIGIT_BITS) -> np.ndarray:
    """For each row the weight of the earlier rows of its run that have a smaller digit.

    ``run`` must not fall.  Each pair of digits is counted at the highest bit in which they differ.
    """
    found = np.zeros(len(run))
    for bit in range(bits):
        same = (run << (bits - bit - 1)) | (digit >> (bit + 1))
        order = np.argsort(same, kind="stable")
        same, one, own = same[order], ((digit[order] >> bit) & 1).astype(bool), weight[order]
        low = np.where(one, 0.0, own)
        until = np.cumsum(low)
        fresh = np.ones(len(same), bool)
        fresh[1:] = same[1:] != same[:-1]
        before = np.maximum.accumulate(np.where(fresh, until - low, 0.0))
        found[order] += np.where(one, until - before, 0.0)
    return found


def _count(bits: int):
    """Rows (key, digit, n): digit -1 has the pairs of a key's level, others the totals of the outer groups."""
    width = 1 << bits

    def edge(key: int, seen: np.ndarray) -> pa.RecordBatch:
        some = np.flatnonzero(seen)
        return _batch(np.full(len(some), key), some, seen[some])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = current = seen = None
        pairs: dict[int, float] = defaultdict(float)
        for batch in batches:
            if not batch.num_rows:
                continue
            key, digit, weight = (batch.column(k).to_numpy() for k in range(3))
            digit = digit.astype(np.int64)
            bounds = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
            found = rising_pairs(np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)), digit, weight, bits)
            if key[0] == current:
                head = slice(0, bounds[1])
                found[head] += (np.cumsum(seen) - seen)[digit[head]]
            level = key >> _GROUP_BITS
            for k in np.unique(level):
                pairs[int(k)] += float((found * weight)[level == k].sum())
            for a, b in zip(bounds[:-1], bounds[1:]) if len(bounds) == 2 else ((0, bounds[1]), (bounds[-2], len(key))):
                if key[a] != current:
                    if current is not None and current == first:
                        yield edge(first, seen)
                    first = int(key[a]) if first is None else first
                    current, seen = int(key[a]), np.zeros(width)
                seen += np.bincount(digit[a:b], weight[a:b], width)
        if current is not None:
            yield edge(current, seen)
            yield _batch(np.array([k << _GROUP_BITS for k in pairs]), np.full(len(pairs), -1), np.array([*pairs.values()]))

    return run


def _batch(key: np.ndarray, digit: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(key.astype(np.int64)), pa.array(digit.astype(np.int32)), pa.array(n.astype(float))], ["key", "digit", "n"]
    )


def concordant(
    cells: DataFrame, distinct: int, *, tasks: int | None = None, bits: int = DIGIT_BITS
) -> DataFrame:
    """``pair, concordant`` from distinct cells ``pair`` (a small number), ``x``, ``rank`` (of y, below ``distinct``), ``n``.

    ``tasks`` fixes how many tasks the first round has.
    """
    levels = max(-(-max(distinct - 1, 1).bit_length() // bits), 1)
    if levels >= 1 << _LEVEL_BITS or distinct >= 1 << _GROUP_BITS:
        raise ValueError("Too many distinct values for the levels")
    level = F.explode(F.sequence(F.lit(0), F.lit(levels - 1)))
    each = cells.select("pair", "x", F.col("rank").cast("bigint").alias("rank"), F.col("n").cast("double").alias("n"), level.alias("level"))
    shifted = F.expr(f"shiftright(rank, level * {bits})")
    own = F.shiftleft(F.col("pair").cast("bigint"), _LEVEL_BITS).bitwiseOR(F.col("level").cast("bigint"))
    rows = each.select(
        F.shiftleft(own, _GROUP_BITS).bitwiseOR(F.shiftright(shifted, bits)).alias("key"),
        shifted.bitwiseAND(F.lit((1 << bits) - 1).cast("bigint")).cast("int").alias("digit"),
        "n",
        "x",
    )
    found, size = [], cells.count() * levels
    while size:
        wanted = tasks if tasks and not found else -(-size // TASK_ROWS)
        order = [F.col("key"), F.col("x"), F.col("digit").desc()]
        dealt = rows.repartitionByRange(wanted, *order) if wanted > 1 else rows.repartition(1)
        counted = dealt.sortWithinPartitions(*order).select("key", "digit", "n").mapInArrow(_count(bits), _ROWS)
        stored = written(counted.withColumn("task", F.spark_partition_id()))
        found.append(stored.where("digit < 0"))
        edges = stored.where("digit >= 0")
        across = edges.groupBy("key").agg(F.min("task").alias("a"), F.max("task").alias("b")).where("a < b")
        rows = edges.join(across.select("key"), "key", "left_semi").select("key", "digit", "n", F.col("task").alias("x"))
        size = rows.count()
    if not found:
        return cells.sparkSession.createDataFrame([], "pair int, concordant double")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    pair = F.shiftright("key", _GROUP_BITS + _LEVEL_BITS).cast("int")
    return every.groupBy(pair.alias("pair")).agg(F.sum("n").alias("concordant"))


def value_places(values: DataFrame) -> DataFrame:
    """``pair, value, rank``: whole numbers in the order of the values of each pair, below the number of rows."""
    return numbered(values.select("pair", "value").distinct(), ["pair", "value"], "rank")
