"""Global row numbers and running totals without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import attach, ref, require
from .scratch import written

# monotonically_increasing_id keeps the partition above this bit.
_PARTITION_BIT = 33


def _spread(df: DataFrame) -> Column:
    """A hash of the row, so that rows that tie in an order still go to many ranges."""
    return F.xxhash64(*[ref(f.name) for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))])


def numbered(df: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    """Add the 0-based position of each row in the total order of ``order_by``.

    The rows are range-partitioned and sorted once and written together with their place
    in the partition.  The partition sizes (one number per partition) then become an
    array of offsets inside the plan, so reading positions is a projection.  ``order_by``
    should identify rows: rows that tie in it are put in the order of a hash of their values.
    """
    require(df, order_by)
    slot = f"{name}__slot"
    stored = written(dealt_in_order(df, order_by, slot))
    return with_positions(stored, stored, slot, name).drop(slot)


def dealt_in_order(df: DataFrame, order_by: Sequence[str], slot: str) -> DataFrame:
    """The rows range-partitioned and sorted, with their partition and place in it in one number."""
    keys = [*[ref(c) for c in order_by], _spread(df)]
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(slot, F.monotonically_increasing_id())


def with_positions(df: DataFrame, stored: DataFrame, slot: str, name: str) -> DataFrame:
    """Places in the whole order from slots; ``stored`` is the written table that all slots are in."""
    part = F.shiftright(slot, _PARTITION_BIT).cast("int")
    sizes = dict(stored.groupBy(part.alias("part")).count().collect())
    offsets, total = [], 0
    for p in range(max(sizes, default=-1) + 1):
        offsets.append(total)
        total += sizes.get(p, 0)
    # One string literal that Spark folds into an array of numbers.
    table = F.split(F.lit(",".join(map(str, offsets))), ",").cast("array<bigint>")
    within = F.col(slot).bitwiseAND(F.lit((1 << _PARTITION_BIT) - 1))
    start = F.get(table, part) if offsets else F.lit(0)
    return df.withColumn(name, start + within)


def running_total(
    df: DataFrame,
    order_by: Sequence[str],
    weight: str,
    name: str,
    partition_by: Sequence[str] = (),
    native_rows: int | None = None,
) -> DataFrame:
    """Add the running total of ``weight`` per key in the given order, up to and including the row.

    The table is range-partitioned by key and order, so that a hot key spreads over many
    partitions; what a key adds up to in its earlier partitions is the offset of each
    later one.  A caller that knows its table to be short may pass ``native_rows``: up to so
    many a plain window does.
    """
    keys, times = [ref(c) for c in partition_by], [*[ref(c) for c in order_by], _spread(df)]
    until = (Window.unboundedPreceding, Window.currentRow)
    if native_rows is not None:
        df = written(df)
        if df.count() <= native_rows:
            plain = Window.partitionBy(*keys).orderBy(*times).rowsBetween(*until)
            return df.withColumn(name, F.sum(weight).over(plain))
    part = f"{name}__part"
    # Written once, so that the partition of a row is the same in both uses below.
    stored = written(df.repartitionByRange(*keys, *times).withColumn(part, F.spark_partition_id()))
    totals = stored.groupBy(part, *keys).agg(F.sum(weight).alias("__total"))
    earlier = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(part, *keys, F.coalesce(F.sum("__total").over(earlier), F.lit(0)).alias("__offset"))
    within = F.sum(weight).over(Window.partitionBy(part, *keys).orderBy(*times).rowsBetween(*until))
    joined = attach(stored.withColumn("__within", within), offsets, [part, *partition_by])
    return joined.withColumn(name, F.col("__offset") + F.col("__within")).drop(part, "__offset", "__within")
