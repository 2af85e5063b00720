"""Exact interpolated quantiles that never gather a large group in one task.

Spark's ``percentile`` keeps every distinct value of a group in one hash map.
That is the right plan for groups of a checked size or with few distinct values and
is used for those.  A
larger group is narrowed instead: a bounded sketch gives cut points, the two cuts
around each wanted rank become its bracket, and the next pass sketches only the
bracket.  The last pass counts below the bracket and sorts the little inside it,
so the answer is exact; each pass is one partial aggregation over the scan.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import attach, number, ref, require
from .scratch import written

# A whole column, and a group, of up to this many values goes to the built-in percentile.
NATIVE_ROWS = 200_000
NATIVE_GROUP_ROWS = 250_000
# So does a longer one of up to about this many distinct values, by a sketch.
NATIVE_VALUES = 50_000
# Cut points a sketch yields, and its rank error as a fraction 1/accuracy.
CUTS = 1000
ACCURACY = 10_000


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    group_by: Sequence[str] = (),
    native_rows: int | None = None,
    along: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per group: the keys and, per column, an array of its quantiles.

    Linear interpolation between order statistics; missing values are left out
    and a group without values gives an array of NULLs (or NULL).  ``along`` names
    further aggregates of the table, taken in the same pass where there is one.
    """
    keys = require(df, group_by)
    limit = native_rows if native_rows is not None else NATIVE_GROUP_ROWS if keys else NATIVE_ROWS
    names = require(df, columns)
    groups = [ref(k) for k in keys]
    others = [c.alias(name) for name, c in (along or {}).items()]
    # Rows bound values, and without keys their count needs no column to be read.
    sizes = df.groupBy(*groups).agg(F.count("*").alias("__most"))
    largest = sizes.agg(F.max("__most")).first()[0] or 0
    long: list[str] = []
    if largest > limit:
        # What percentile holds in memory is distinct values, so a long column of few
        # values is still its case.
        seen = df.groupBy(*groups).agg(*[F.approx_count_distinct(number(df, c)).alias(f"__d{i}") for i, c in enumerate(names)])
        widest = seen.agg(*[F.max(f"__d{i}") for i in range(len(names))]).first()
        long = [c for c, width in zip(names, widest) if (width or 0) > min(NATIVE_VALUES, limit)]
    short = [_percentile(number(df, c), probabilities).alias(c) for c in names if c not in long]
    direct = df.groupBy(*groups).agg(*short, *others) if short or others or not long else None
    if not long:
        return direct

    typed = df.select(*groups, *[number(df, c).alias(f"__q{i}") for i, c in enumerate(long)])
    slots = [f"__q{i}" for i in range(len(long))]
    if not keys:
        whole = _whole(typed, slots, probabilities, largest, limit)
        narrowed = df.sparkSession.range(1).select(
            *[F.array(*[F.lit(v).cast("double") for v in whole[s]]).alias(c) for s, c in zip(slots, long)]
        )
    else:
        hot = written(sizes.where(F.col("__most") > limit).select(*groups))
        small = attach(typed, hot, keys, "left_anti")
        large = attach(typed, hot, keys, "left_semi")
        both = _native(small, keys, slots, probabilities).unionByName(
            _narrowed(large, keys, slots, probabilities, largest, limit)
        )
        narrowed = both.select(*groups, *[F.col(s).alias(c) for s, c in zip(slots, long)])
    if keys:
        # From the groups outwards: one without any value is not among the narrowed.
        result = attach(sizes.select(*groups) if direct is None else direct, narrowed, keys, "left")
    else:
        result = narrowed if direct is None else attach(narrowed, direct, keys)
    return result.select(*groups, *[ref(c) for c in names], *[ref(name) for name in along or {}])


def _percentile(column: Column, probabilities) -> Column:
    return F.percentile(column, F.array(*[F.lit(float(p)) for p in probabilities]))


def _native(typed: DataFrame, keys, slots, probabilities) -> DataFrame:
    return typed.groupBy(*[ref(k) for k in keys]).agg(*[_percentile(F.col(s), probabilities).alias(s) for s in slots])


@dataclass
class _Target:
    """A wanted quantile of one column and the bracket its order statistics lie in."""

    slot: str
    place: float
    low: float | None = None
    high: float | None = None
    below: int = 0

    def inside(self) -> Column:
        v = F.col(self.slot)
        held = v.isNotNull()
        if self.low is not None:
            held = held & (v >= F.lit(self.low))
        if self.high is not None:
            held = held & (v <= F.lit(self.high))
        return held

    def under(self) -> Column:
        return F.count_if(F.col(self.slot) < F.lit(self.low)) if self.low is not None else F.lit(0).cast("long")

    def tighten(self, cuts: Sequence[float], below: int, held: int) -> None:
        """Take the cuts one step outside the two wanted ranks; see ``_tighten``."""
        left = math.floor((math.floor(self.place) - below) * CUTS / held) - 1
        right = math.ceil((math.ceil(self.place) - below + 1) * CUTS / held) + 1
        if left > 0:
            self.low = cuts[left]
        if right < CUTS:
            self.high = cuts[right]


def _whole(typed: DataFrame, slots, probabilities, largest: int, limit: int) -> dict[str, list[float | None]]:
    """Quantiles of whole columns.  The brackets are a few numbers, so they are literals
    in plain aggregations: no join, no row is multiplied."""
    grid = F.array(*[F.lit(i / CUTS) for i in range(CUTS + 1)])

    def sketch(column: Column) -> Column:
        return F.approx_percentile(column, grid, ACCURACY)

    first = typed.agg(*[f.alias(f"{s}{k}") for s in slots for k, f in (("n", F.count(s)), ("g", sketch(F.col(s))))]).first()
    targets = []
    for s in slots:
        n = first[f"{s}n"]
        for p in probabilities if n else ():
            target = _Target(s, (n - 1) * p)
            target.tighten(first[f"{s}g"], 0, n)
            targets.append(target)
    remaining = largest * 4 / CUTS
    while remaining > limit:
        parts = [
            f.alias(f"{i}{k}")
            for i, t in enumerate(targets)
            for k, f in (("b", t.under()), ("m", F.count_if(t.inside())), ("g", sketch(F.when(t.inside(), F.col(t.slot)))))
        ]
        seen = typed.agg(*parts).first()
        for i, t in enumerate(targets):
            t.tighten(seen[f"{i}g"], seen[f"{i}b"], seen[f"{i}m"])
        remaining = remaining * 4 / CUTS

    counts = typed.agg(
        F.count("*"),
        *[f.alias(f"{k}{i}") for i, t in enumerate(targets) for k, f in (("b", t.under()), ("m", F.count_if(t.inside())))],
    ).first()
    quantiles: dict[str, list[float | None]] = {s: [] for s in slots}
    open_targets = []
    for i, t in enumerate(targets):
        t.below = counts[f"b{i}"]
        if not t.below <= math.floor(t.place) <= math.ceil(t.place) < t.below + counts[f"m{i}"]:
            raise RuntimeError("quantile bracket missed its rank")
        if t.low is None or t.low != t.high:
            open_targets.append(i)
    found = _picked(typed, {i: targets[i] for i in open_targets}) if open_targets else {}
    for i, t in enumerate(targets):
        low, high = found.get(i, (t.low, t.high))  # a bracket of one value needs no look inside
        weight = t.place - math.floor(t.place)
        quantiles[t.slot].append(low * (1 - weight) + high * weight)
    return {s: q or [None] * len(probabilities) for s, q in quantiles.items()}


def _picked(typed: DataFrame, targets: dict[int, _Target]) -> dict[int, tuple[float, float]]:
    """The two order statistics of each target, from a histogram of its bracket."""
    held = [F.when(t.inside(), F.struct(F.lit(i).alias("t"), F.col(t.slot).alias("x"))) for i, t in targets.items()]
    # Most rows lie in no bracket and leave before the array of candidates is built.
    some = typed.where(reduce(Column.__or__, [t.inside() for t in targets.values()]))
    near = some.select(F.explode(F.array(*held)).alias("e")).where("e is not null")
    histogram = near.groupBy("e.t", "e.x").agg(F.count("*").alias("c"))
    upto = F.sum("c").over(Window.partitionBy("t").orderBy("x"))
    places = F.map_from_arrays(
        F.array(*[F.lit(i) for i in targets]), F.array(*[F.lit(t.place - t.below) for t in targets.values()])
    )
    place = F.element_at(places, F.col("t"))
    picked = (
        histogram.withColumn("upto", upto)
        .groupBy("t")
        .agg(
            F.min(F.when(F.col("upto") > F.floor(place), F.col("x"))).alias("low"),
            F.min(F.when(F.col("upto") > F.ceil(place), F.col("x"))).alias("high"),
        )
    )
    return {r["t"]: (r["low"], r["high"]) for r in picked.collect()}  # one row per target


def _narrowed(typed: DataFrame, keys, slots, probabilities, largest: int, limit: int) -> DataFrame:
    long = typed.select(
        *[ref(k) for k in keys],
        F.explode(
            F.array(*[F.struct(F.lit(i).alias("s"), F.col(s).alias("v")) for i, s in enumerate(slots)])
        ).alias("__e"),
    ).select(*[ref(k) for k in keys], F.col("__e.s").alias("__s"), F.col("__e.v").alias("__v"))
    long = long.where(F.col("__v").isNotNull())
    series = [*keys, "__s"]

    grid = F.array(*[F.lit(i / CUTS) for i in range(CUTS + 1)])

    def sketch(column):
        return F.approx_percentile(column, grid, ACCURACY)

    # First pass: one sketch per series serves all of its wanted ranks.
    counted = long.groupBy(*[ref(k) for k in series]).agg(
        F.count("*").alias("__n"), sketch(F.col("__v")).alias("__grid")
    )
    targets = F.array(
        *[F.struct(F.lit(i).alias("t"), F.lit(float(p)).alias("p")) for i, p in enumerate(probabilities)]
    )
    place = (F.col("__n") - 1) * F.col("__t.p")
    state = counted.withColumn("__t", F.explode(targets)).select(
        *[ref(k) for k in series],
        F.col("__t.t").alias("__t"),
        place.alias("__place"),
        F.floor(place).alias("__k0"),
        F.ceil(place).alias("__k1"),
        F.lit(0).cast("long").alias("__below"),
        F.col("__n").alias("__m"),
        F.lit(None).cast("double").alias("__lo"),
        F.lit(None).cast("double").alias("__hi"),
        "__grid",
    )
    # Written, so that the planner knows how small the brackets are.
    state = written(_tighten(state))

    remaining = largest * 4 / CUTS
    while remaining > limit:
        seen = attach(long, state, series)
        inside = (F.col("__lo").isNull() | (F.col("__v") >= F.col("__lo"))) & (
            F.col("__hi").isNull() | (F.col("__v") <= F.col("__hi"))
        )
        narrowed = seen.groupBy(*[ref(k) for k in series], "__t", "__place", "__k0", "__k1", "__lo", "__hi").agg(
            F.count_if(F.col("__v") < F.col("__lo")).alias("__below"),
            F.count_if(inside).alias("__m"),
            sketch(F.when(inside, F.col("__v"))).alias("__grid"),
        )
        state = written(_tighten(narrowed))
        remaining = remaining * 4 / CUTS

    # Last pass: everything below the bracket is one count, the inside a histogram.
    seen = attach(long, state, series).where(F.col("__hi").isNull() | (F.col("__v") <= F.col("__hi")))
    held = F.when(F.col("__lo").isNull() | (F.col("__v") >= F.col("__lo")), F.col("__v"))
    target = [*series, "__t", "__place", "__k0", "__k1"]
    histogram = seen.groupBy(*[ref(k) for k in target], held.alias("__x")).agg(F.count("*").alias("__c"))
    up_to = Window.partitionBy(*[ref(k) for k in target]).orderBy(F.col("__x").asc_nulls_first())
    cumulative = histogram.withColumn("__cum", F.sum("__c").over(up_to))
    picked = cumulative.groupBy(*[ref(k) for k in target]).agg(
        F.min(F.when(F.col("__cum") > F.col("__k0"), F.col("__x"))).alias("__low"),
        F.min(F.when(F.col("__cum") > F.col("__k1"), F.col("__x"))).alias("__high"),
        F.max(F.when(F.col("__x").isNull(), F.col("__cum"))).alias("__under"),
    )
    weight = F.col("__place") - F.col("__k0")
    answer = F.when(
        F.col("__low").isNotNull()
        & F.col("__high").isNotNull()
        & (F.coalesce(F.col("__under"), F.lit(0)) <= F.col("__k0")),
        F.col("__low") * (1 - weight) + F.col("__high") * weight,
    ).otherwise(F.raise_error(F.lit("quantile bracket missed its rank")).cast("double"))
    wide = picked.select(*[ref(k) for k in series], "__t", answer.alias("__a"))
    return wide.groupBy(*[ref(k) for k in keys]).agg(
        *[
            F.array(
                *[
                    F.max(F.when((F.col("__s") == i) & (F.col("__t") == t), F.col("__a")))
                    for t in range(len(probabilities))
                ]
            ).alias(slot)
            for i, slot in enumerate(slots)
        ]
    )


def _tighten(state: DataFrame) -> DataFrame:
    """Replace each bracket by the cut points one step outside its wanted ranks."""
    # Rank error is a tenth of a step, so one spare step on either side is safe.
    share = F.lit(float(CUTS)) / F.col("__m")
    left = F.floor((F.col("__k0") - F.col("__below")) * share) - 1
    right = F.ceil((F.col("__k1") - F.col("__below") + 1) * share) + 1
    lo = F.when(left > 0, F.get("__grid", left.cast("int"))).otherwise(F.col("__lo"))
    hi = F.when(right < CUTS, F.get("__grid", right.cast("int"))).otherwise(F.col("__hi"))
    return state.withColumns({"__lo": lo, "__hi": hi}).drop("__grid", "__m", "__below")
