"""What the operators of this subpackage share: reading tables, Arrow slices, sampling by hash."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Text one step of a task works on; longer batches are cut between rows.
SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ref(name: str) -> Column:
    """A column by its literal name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def require(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"Missing columns: {missing}")


def id_remainder(id_col: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo the divisor."""
    return F.crc32(ref(id_col).cast("string")) % divisor


def hash_sample(df: DataFrame, key: str, rows: int, total: int) -> DataFrame:
    """About ``rows`` rows, chosen by a hash of the key: the same ones in every run and layout."""
    if total <= rows:
        return df
    share = F.pmod(F.xxhash64(ref(key), F.lit("sample")), F.lit(1 << 40))
    return df.where(share < int((1 << 40) * rows / total))


def slices(batch: pa.RecordBatch, column: int, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch cut between rows, so that the text of a slice stays below ``max_bytes`` or is one row."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    first = 0
    while first < len(ends):
        before = ends[first - 1] if first else 0
        last = max(int(np.searchsorted(ends, before + max_bytes, side="right")), first + 1)
        yield batch.slice(first, last - first)
        first = last


def give_back() -> None:
    """Return memory that is free in this process: a worker that waits for its next task is next to others that work."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim is not None:
        trim(0)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts end to end and the offsets of each; null counts as empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... for counts[0] places, then the same for the next span."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - counts), counts) + np.arange(total)


def crc(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())


def whole_groups(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[pa.Table]:
    """The rows of a partition sorted by a bigint key, cut between groups; holds one batch and one group."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows = pa.Table.from_batches(held)
        keys = rows.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            yield rows.slice(0, cut).combine_chunks()
            held = rows.slice(cut).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def group_starts(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins, and the number of keys at the end."""
    new = np.ones(len(keys) + 1, bool)
    new[1:-1] = keys[1:] != keys[:-1]
    return np.flatnonzero(new)


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n places the smallest place connected to it by the pairs (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def dealt_join(rows: DataFrame, side: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join rows with a table of one row a key (bigint or binary) so that hot keys can be split.

    After an aggregation over the same keys the plan would keep its partitions for the join, where adaptive execution
    can't split a hot one.  Turned keys make the join deal both sides anew.
    """
    kinds, turned = dict(side.dtypes), {k: f"{k}__turned" for k in keys}

    def turn(name: str, key: str) -> Column:
        return F.concat(ref(name), F.lit(b"\0")) if kinds[key] == "binary" else ref(name).bitwiseXOR(0x5DEECE66D1234567)

    dealt = side.select(*[turn(k, k).alias(turned[k]) for k in keys], *[ref(c) for c in side.columns if c not in keys])
    same = F.lit(True)
    for k in keys:
        same = same & (turn(k, k) == ref(turned[k]))
    return rows.join(dealt, same, how).drop(*turned.values())
