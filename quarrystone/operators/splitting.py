"""Exact, reproducible train/test splits and cross-validation folds."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import as_list, attach, canonicalize, ref, require
from ..plans.ordering import numbered
from ..plans.scratch import written

# Rows of the one hash bucket that is ranked; the number of buckets follows from it.
BUCKET_ROWS = 100_000
# Copies of a row that one generator call emits.
CHUNK = 100_000


@dataclass(frozen=True)
class FeaturesTarget:
    """Feature columns and target of one table; they are never stored apart."""

    table: DataFrame
    features: list[str]
    target: str

    @property
    def X(self) -> DataFrame:
        return self.table.select(*[ref(c) for c in self.features])

    @property
    def y(self) -> DataFrame:
        return self.table.select(ref(self.target))


def split_features_target(df: DataFrame, target: str, *, drop: Sequence[str] | None = None) -> FeaturesTarget:
    """All columns but the target and the dropped ones, and the target."""
    gone = {target, *require(df, drop)}
    require(df, target)
    return FeaturesTarget(df, [c for c in df.columns if c not in gone], target)


def split_sizes(df: DataFrame, test_size: float, stratify: str | None) -> DataFrame:
    """Rows ``n`` and test rows ``take``, in total or per class.

    The total is ``ceil(n * test_size)``; classes get their proportional share, rounded
    down, and the largest remainders one row more until the total is reached.
    """
    keys = as_list(stratify)
    sizes = df.groupBy(*[ref(k) for k in keys]).agg(F.count("*").alias("n"))
    wanted = F.ceil(F.bround(F.col("n") * F.lit(float(test_size)), 9))
    if not keys:
        return sizes.select("n", wanted.alias("take"))
    whole = sizes.agg(F.sum("n").alias("n")).select(F.struct("n", wanted.alias("take"))).scalar()
    quota = F.col("n") * whole["take"] / whole["n"]
    parts = sizes.withColumns({"base": F.floor(quota), "rest": F.bround(quota - F.floor(quota), 9)})
    # One row per class.
    by_rest = Window.orderBy(F.desc("rest"), ref(keys[0]))
    extra = whole["take"] - F.sum("base").over(Window.partitionBy())
    return parts.select(
        ref(keys[0]),
        "n",
        (F.col("base") + F.when(F.row_number().over(by_rest) <= extra, 1).otherwise(0)).alias("take"),
    )


def train_test(
    df: DataFrame,
    *,
    test_size: float = 0.2,
    random_state: int = 42,
    stratify: str | None = None,
    key: str | Sequence[str] | None = None,
    order_hash: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Split into ``(train, test)`` of exact sizes, in total or per class of ``stratify``.

    Rows go by a seeded hash, so the split depends on content, not on partitioning.
    ``key`` names columns that identify a row: then only bucket counts are shuffled and
    the split is a filter on the row.  Without a key whole rows are hashed and identical
    rows are counted first, since copies cannot be told apart.
    """
    if not 0 < test_size < 1:
        raise ValueError("test_size must be between 0 and 1")
    classes = require(df, stratify)
    if classes:
        smallest = df.groupBy(ref(stratify)).count().agg(F.min("count")).first()[0]
        if smallest is not None and smallest < 2:
            raise ValueError("Every class needs at least two rows")
    takes = split_sizes(df, test_size, stratify)
    if key is not None:
        names = require(df, key)
        seeded = F.xxhash64(*[ref(c) for c in names], F.lit(random_state)) if order_hash is None else order_hash
        placed = _placed(df, F.lit(1), names, seeded, takes, classes)
        columns = [ref(c) for c in df.columns]
        return placed.where("__chosen = 0").select(*columns), placed.where("__chosen = 1").select(*columns)

    # Copies cannot be told apart, so identical rows are counted and written once.
    columns = [ref(c) for c in df.columns]
    distinct = canonicalize(df).groupBy(*columns).agg(F.count("*").alias("__n"))
    distinct = written(distinct.withColumn("__hash", F.xxhash64(*columns, F.lit(random_state))))
    placed = _placed(distinct, F.col("__n"), df.columns, F.col("__hash"), takes, classes)
    if distinct.agg(F.max("__n")).first()[0] == 1:
        return placed.where("__chosen = 0").select(*columns), placed.where("__chosen = 1").select(*columns)
    return _copies(placed, df.columns, F.col("__n") - F.col("__chosen")), _copies(placed, df.columns, F.col("__chosen"))


def _placed(df: DataFrame, weight: Column, names, seeded: Column, takes: DataFrame, classes) -> DataFrame:
    """Add ``__chosen``: how much of each row's weight, in the order of (hash, names), is test.

    Bucket totals locate the bucket in which a class reaches its test size; only the
    rows of that bucket are put in order, which gives the last (hash, names) that still
    belongs to the test part.  Everything else is a comparison with it.
    """
    seeded = seeded.cast("long")
    size = df.agg(F.count("*").alias("n"), F.min(seeded).alias("a"), F.max(seeded).alias("b")).first()
    if not size["n"]:
        return df.withColumn("__chosen", F.lit(0).cast("long"))
    bits = min(max(math.ceil(math.log2(max(size["n"] / BUCKET_ROWS, 1))), 0), 20)
    step = max((size["b"] - size["a"]) // (1 << bits), 1)
    # The hashes span more than a signed 64-bit difference holds.  As doubles they are rounded, but never change
    # places, and buckets need no more than that.
    above = seeded.cast("double") - F.lit(float(size["a"]))
    bucket = F.floor(above / F.lit(float(step))) if bits else F.lit(0)
    groups = [ref(c) for c in classes]
    totals = df.groupBy(*groups, bucket.alias("__bucket")).agg(F.sum(weight).alias("__w"))
    # At most 2**20 bucket totals per class.
    until = Window.partitionBy(*groups).orderBy("__bucket")
    reached = attach(totals.withColumn("__upto", F.sum("__w").over(until)), takes.drop("n"), classes)
    edges = reached.where((F.col("__upto") >= F.col("take")) & (F.col("__upto") - F.col("__w") < F.col("take")))
    edges = edges.select(*groups, "__bucket", (F.col("take") - F.col("__upto") + F.col("__w")).alias("__want"))
    identity = F.struct(seeded.alias("h"), *[ref(c).alias(f"k{i}") for i, c in enumerate(names)])
    rows = df.select(*groups, bucket.alias("__bucket"), identity.alias("__id"), weight.alias("__w"))
    ordered = Window.partitionBy(*groups).orderBy("__id").rowsBetween(Window.unboundedPreceding, 0)
    same = Window.partitionBy(*groups, "__id")
    edge_rows = attach(rows, written(edges), [*classes, "__bucket"]).withColumns(
        {"__upto": F.sum("__w").over(ordered), "__same": F.count("*").over(same)}
    )
    lasts = edge_rows.where(
        (F.col("__upto") >= F.col("__want")) & (F.col("__upto") - F.col("__w") < F.col("__want"))
    ).select(
        *groups, F.col("__id").alias("__last"), (F.col("__want") - F.col("__upto") + F.col("__w")).alias("__part"), "__same"
    )
    lasts = written(lasts)  # one row per class
    if not lasts.where("__same > 1").isEmpty():
        raise ValueError("Several rows have the key at the edge of the test part; the key must identify rows")
    lasts = lasts.drop("__same")
    marked = df.withColumn("__id", identity)
    if classes:
        marked = attach(marked, lasts, classes, "left")
        last, part = F.col("__last"), F.col("__part")
    else:
        edge = lasts.select(F.struct("__last", "__part")).scalar()
        last, part = edge["__last"], edge["__part"]
    mine = F.col("__id")
    chosen = F.when(mine < last, weight).when(mine == last, part).otherwise(0).cast("long")
    return marked.withColumn("__chosen", chosen)


def _copies(placed: DataFrame, columns: Sequence[str], count: Column) -> DataFrame:
    """Each row ``count`` times, from two generators so that no array outgrows a chunk."""
    some = placed.withColumn("__count", count).where("__count > 0")
    chunks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("__count") - 1) / CHUNK))
    some = some.withColumn("__chunk", F.explode(chunks))
    size = F.least(F.col("__count") - F.col("__chunk") * CHUNK, F.lit(CHUNK))
    some = some.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), size)))
    return some.select(*[ref(c) for c in columns])


def assign_folds(
    df: DataFrame, *, cv: int = 5, order_by: str | Sequence[str], label: str | None = None
) -> DataFrame:
    """Add ``fold`` (0 to cv-1): contiguous, unshuffled folds in the given order.

    With ``label`` every class is cut into contiguous folds of its own, with sizes that
    rotate so that the folds as a whole stay even.
    """
    if cv < 2:
        raise ValueError("cv must be at least 2")
    classes, order = require(df, label), require(df, order_by)
    placed = numbered(df, [*classes, *order], "__position")
    if not classes:
        base, longer = divmod(placed.count(), cv)
        head = longer * (base + 1)
        position = F.col("__position")
        fold = F.when(position < head, F.floor(position / (base + 1))).otherwise(
            longer + F.floor((position - head) / max(base, 1))
        )
        return placed.withColumn("fold", fold.cast("int")).drop("__position")
    sizes = placed.groupBy(ref(label)).agg(F.count("*").alias("__n"), F.min("__position").alias("__start"))
    marked = attach(placed, written(sizes), classes)
    # Of the class's n positions in label order, fold i gets those equal to i modulo cv.
    base, longer = F.floor(F.col("__n") / cv), F.col("__n") % cv
    at = F.col("__position") - F.col("__start")
    fold, ends = F.lit(0), F.lit(0)
    for i in range(cv - 1):
        ends = ends + base + F.when(F.pmod(F.lit(i) - F.col("__start"), F.lit(cv)) < longer, 1).otherwise(0)
        fold = fold + F.when(at >= ends, 1).otherwise(0)
    return marked.withColumn("fold", fold.cast("int")).select(*[ref(c) for c in df.columns], "fold")
