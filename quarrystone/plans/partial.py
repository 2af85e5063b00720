"""Aggregates written in Python that run in two phases, so that no task needs a whole group.

Every task folds its own rows into one state a key; states of a key are merged in two steps, first within
``MERGE_SLOTS`` slots by task, then across the slots.  A key with half of all rows costs each task one state, and the
last step merges at most ``MERGE_SLOTS`` states.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import number, ref, require_numeric

# Executors need no copy of the package to fold and merge.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MERGE_SLOTS = 64
# Keys whose states a task holds before it sends them on.
HELD_KEYS = 50_000


@dataclass(frozen=True)
class UserAggregate:
    """An aggregate of a numeric column, in four functions.

    ``zero()`` is the state of no rows; ``update(state, values)`` takes in an array of values, missing ones left out,
    in any order; ``merge(a, b)`` joins two states; ``finish(state)`` gives the result as a number, or None.
    """

    name: str
    zero: Callable[[], Any]
    update: Callable[[Any, np.ndarray], Any]
    merge: Callable[[Any, Any], Any]
    finish: Callable[[Any], float | None]


def _fold(aggregates: Sequence[UserAggregate]):
    """Rows (key, values...) to rows (key, slot, state)."""
    count = len(aggregates)

    def sent(held: dict, slot: int) -> pa.RecordBatch:
        states = [pickle.dumps(s) for s in held.values()]
        return pa.RecordBatch.from_arrays(
            [pa.array([*held], pa.binary()), pa.array([slot] * len(held), pa.int32()), pa.array(states, pa.binary())],
            ["key", "slot", "state"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, held = TaskContext.get().partitionId() % MERGE_SLOTS, {}
        for batch in batches:
            keys = batch.column(0).dictionary_encode()
            code = keys.indices.to_numpy()
            order = np.argsort(code, kind="stable")
            edges = np.flatnonzero(np.r_[True, np.diff(code[order]) != 0, True]) if len(code) else [0]
            columns = [batch.column(k + 1).to_numpy(zero_copy_only=False)[order] for k in range(count)]
            for a, b in zip(edges[:-1], edges[1:]):
                key = keys.dictionary[int(code[order[a]])].as_py()
                states = held.get(key) or [g.zero() for g in aggregates]
                for k, g in enumerate(aggregates):
                    own = columns[k][a:b]
                    own = own[~np.isnan(own)]
                    states[k] = g.update(states[k], own) if len(own) else states[k]
                held[key] = states
                if len(held) >= HELD_KEYS:
                    yield sent(held, slot)
                    held = {}
        if held:
            yield sent(held, slot)

    return run


def _merged(states: pd.Series, aggregates: Sequence[UserAggregate]) -> list:
    total = None
    for packed in states:
        some = pickle.loads(packed)
        total = some if total is None else [g.merge(a, b) for g, a, b in zip(aggregates, total, some)]
    return total


def two_phase(
    df: DataFrame, keys: Sequence[str], outputs: Sequence[tuple[str, UserAggregate, str]]
) -> DataFrame:
    """One row per group of ``keys`` (missing is a group) with each (column, aggregate, alias)."""
    aggregates = [g for _, g, _ in outputs]
    values = [number(df, require_numeric(df, c)).alias(f"v{k}") for k, (c, _, _) in enumerate(outputs)]
    group = F.struct(*[ref(k).alias(f"k{i}") for i, k in enumerate(keys)])
    # Groups travel as bytes; what they were comes from one row a group.
    code = F.to_json(group, {"ignoreNullFields": "false"}).cast("binary") if keys else F.lit(b"")
    coded = df.select(code.alias("key"), *values)
    folded = coded.mapInArrow(_fold(aggregates), "key binary, slot int, state binary")

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        return part.iloc[:1][["key", "slot"]].assign(state=[pickle.dumps(_merged(part["state"], aggregates))])

    def finish(part: pd.DataFrame) -> pd.DataFrame:
        states = _merged(part["state"], aggregates)
        out = part.iloc[:1][["key"]]
        return out.assign(**{f"r{k}": [g.finish(s)] for k, (g, s) in enumerate(zip(aggregates, states))})

    slots = folded.groupBy("key", "slot").applyInPandas(merge, "key binary, slot int, state binary")
    results = ", ".join(f"r{k} double" for k in range(len(outputs)))
    done = slots.groupBy("key").applyInPandas(finish, f"key binary, {results}")
    named = [F.col(f"r{k}").alias(alias) for k, (_, _, alias) in enumerate(outputs)]
    if not keys:
        return done.select(*named)
    groups = df.select(code.alias("key"), group.alias("group")).groupBy("key").agg(F.first("group").alias("group"))
    own = [F.col(f"group.k{i}").alias(k) for i, k in enumerate(keys)]
    return groups.join(done, "key").select(*own, *named)
