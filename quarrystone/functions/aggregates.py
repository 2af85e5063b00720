"""Aggregates by name: the vocabulary of ``aggregate``, ``trend_over_time`` and ``pivot_summary``."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.partial import UserAggregate, two_phase
from ..plans.quantiles import exact_quantiles
from .columns import attach, exact_sum, number, ref, require, require_numeric, value
from .moments import skew

Aggregate = str | Callable[[Column], Column] | UserAggregate


def _at_end(df: DataFrame, name: str, order_by: Sequence[str], pick) -> Column:
    if not order_by:
        raise ValueError("'first' and 'last' need order_by: Spark rows have no order")
    present = value(df, name).isNotNull()
    return pick(value(df, name), F.when(present, F.struct(*[ref(c) for c in require(df, order_by)])))


# name -> (table, column, order) -> aggregate expression
NAMED = {
    "sum": lambda df, c, o: exact_sum(df, c),
    "mean": lambda df, c, o: F.avg(number(df, c)),
    "min": lambda df, c, o: F.min(value(df, c)),
    "max": lambda df, c, o: F.max(value(df, c)),
    "count": lambda df, c, o: F.count(value(df, c)),
    "size": lambda df, c, o: F.count("*"),
    "nunique": lambda df, c, o: F.count_distinct(value(df, c)),
    "std": lambda df, c, o: F.stddev_samp(number(df, c)),
    "var": lambda df, c, o: F.var_samp(number(df, c)),
    "sem": lambda df, c, o: F.try_divide(F.stddev_samp(number(df, c)), F.sqrt(F.count(number(df, c)).cast("double"))),
    "skew": lambda df, c, o: skew(number(df, c)),
    "prod": lambda df, c, o: F.coalesce(F.product(number(df, c)), F.lit(1.0)),
    "first": lambda df, c, o: _at_end(df, c, o, F.min_by),
    "last": lambda df, c, o: _at_end(df, c, o, F.max_by),
}
# What an empty group gives; every other aggregate of nothing is missing.
EMPTY = {"sum": 0, "count": 0, "size": 0, "nunique": 0, "prod": 1}


def aggregate_name(how: Aggregate) -> str:
    if isinstance(how, UserAggregate):
        return how.name
    return how if isinstance(how, str) else getattr(how, "__name__", "custom").strip("<>")


def grouped(
    df: DataFrame,
    keys: Sequence[str],
    outputs: Sequence[tuple[str, Aggregate, str]],
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Group by ``keys`` (missing is a group) and compute ``(column, aggregate, alias)`` triples.

    An aggregate is a name, a :class:`UserAggregate` (Python code in two phases, for groups of any size), or a function
    from a Column to an aggregate Column, so grouped-aggregate pandas UDFs work too, which take each group into one
    task.  Medians take the exact-quantile plan, with the other aggregates in the same pass; without a median or
    a user aggregate it is one aggregation.
    """
    require(df, [*keys, *[c for c, _, _ in outputs]])
    own = [o for o in outputs if isinstance(o[1], UserAggregate)]
    if own:
        found, rest = two_phase(df, keys, own), [o for o in outputs if not isinstance(o[1], UserAggregate)]
        if not rest:
            return found
        both = attach(grouped(df, keys, rest, order_by), found, keys)
        return both.select(*[ref(k) for k in keys], *[ref(alias) for _, _, alias in outputs])
    medians = {}
    expressions = {}
    for column, how, alias in outputs:
        if how == "median":
            medians[alias] = require_numeric(df, column)
        elif callable(how):
            expressions[alias] = how(value(df, column))
        elif how in NAMED:
            expressions[alias] = NAMED[how](df, column, order_by)
        else:
            raise ValueError(f"Unknown aggregate {how!r}; choose one of {[*NAMED, 'median']} or a function")
    groups = [ref(k) for k in keys]
    if not medians:
        result = df.groupBy(*groups).agg(*[c.alias(alias) for alias, c in expressions.items()])
        return result.select(*groups, *[ref(alias) for _, _, alias in outputs])
    # Distinct names for the medians, which may share theirs with a key or an output.
    slots = {c: f"__median{i}" for i, c in enumerate(dict.fromkeys(medians.values()))}
    table = df.withColumns({slot: number(df, c) for c, slot in slots.items()})
    result = exact_quantiles(table, list(slots.values()), [0.5], keys, along=expressions)
    return result.select(
        *groups,
        *[
            F.get(slots[medians[alias]], F.lit(0)).alias(alias) if alias in medians else ref(alias)
            for _, _, alias in outputs
        ],
    )
