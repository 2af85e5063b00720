"""Column classes, the missing-value rule and rounding.

A value is missing when it is NULL or a floating-point NaN.  Spark orders NaN
above every number and lets it poison sums, so operators read a column through
:func:`value` or :func:`number`, which turn NaN into NULL.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ref(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_list(names: str | Iterable[str] | None) -> list[str]:
    if names is None:
        return []
    return [names] if isinstance(names, str) else list(names)


def require(df: DataFrame, names: str | Iterable[str]) -> list[str]:
    """The names as a list; ``ValueError`` when the table lacks one of them."""
    wanted = as_list(names)
    absent = [n for n in wanted if n not in df.columns]
    if absent:
        raise ValueError(f"Unknown column(s) {absent}; the table has {df.columns}")
    return wanted


def unused_name(df: DataFrame, stem: str) -> str:
    name = stem
    while name in df.columns:
        name += "_"
    return name


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def boolean_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]


def datetime_columns(df: DataFrame) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
    ]


def require_numeric(df: DataFrame, name: str) -> str:
    require(df, name)
    if name not in numeric_columns(df):
        raise ValueError(f"Column {name!r} must be numeric")
    return name


def is_float(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType))


def value(df: DataFrame, name: str) -> Column:
    """The column with NaN read as missing."""
    column = ref(name)
    return F.when(~F.isnan(column), column) if is_float(df, name) else column


def number(df: DataFrame, name: str) -> Column:
    """A numeric column as double, NaN read as missing."""
    return value(df, name).cast("double")


def is_missing(df: DataFrame, name: str) -> Column:
    column = ref(name)
    return (column.isNull() | F.isnan(column)) if is_float(df, name) else column.isNull()


def canonicalize(df: DataFrame) -> DataFrame:
    """The whole table with NaN turned into NULL."""
    return df.select(*[value(df, n).alias(n) if is_float(df, n) else ref(n) for n in df.columns])


def exact_sum(df: DataFrame, name: str) -> Column:
    """Group sum; a group with nothing to add up gives 0, like the sum of an empty list."""
    total = F.sum(value(df, name))
    return F.coalesce(total, F.lit(0).cast("double") if is_float(df, name) else F.lit(0))


def rounded(column: Column, digits: int) -> Column:
    """Half-even rounding, the rule of the numeric Python stack."""
    return F.bround(column, digits)


def percent(part: Column, whole: Column) -> Column:
    """Share in percent at two digits; 0 when there is nothing to share."""
    share = F.try_divide(part.cast("double"), whole.cast("double")) * 100
    return F.when(whole == 0, F.lit(0.0)).otherwise(rounded(share, 2))


def same_keys(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Join condition in which missing equals missing."""
    condition = F.lit(True)
    for a, b in zip(left, right):
        condition = condition & a.eqNullSafe(b)
    return condition


def attach(df: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join two tables on equally named keys; missing keys match each other.

    Without keys the side is a single row.  Otherwise there is no broadcast hint: a
    caller writes the side first where it should be small, so that the planner knows
    its real size, broadcasts it below the session's threshold and shuffles both sides
    (splitting skewed partitions) beyond it.
    """
    if not keys:
        return df.crossJoin(F.broadcast(side))
    renamed = side.withColumnsRenamed({k: f"__side_{k}" for k in keys})
    joined = df.join(
        renamed, same_keys([ref(k) for k in keys], [ref(f"__side_{k}") for k in keys]), how
    )
    return joined.drop(*[f"__side_{k}" for k in keys])
