"""Micro-batches of exact size, bounded snapshots and running totals."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import as_list, ref, require
from ..plans.ordering import numbered
from ..plans.scratch import scratch_folder, written

Handler = Callable[[DataFrame], None]


def _check(batch_size: int, max_batches: int | None) -> None:
    if batch_size < 1 or (max_batches is not None and max_batches < 1):
        raise ValueError("batch_size and max_batches must be at least 1")


def assign_batches(
    df: DataFrame, *, order_by: Sequence[str], batch_size: int = 100, max_batches: int | None = None
) -> DataFrame:
    """Batch form of the micro-batch bridge: add ``batch_id``, ``batch_size`` rows each in
    the given order, the last one smaller; with ``max_batches`` later rows are left out."""
    _check(batch_size, max_batches)
    placed = numbered(df, require(df, order_by), "__position")
    batches = placed.withColumn("batch_id", F.floor(F.col("__position") / batch_size)).drop("__position")
    return batches if max_batches is None else batches.where(F.col("batch_id") < max_batches)


def _finish(query: StreamingQuery, done: Callable[[], bool] = lambda: False) -> None:
    """Wait for a query to end, stopping it once ``done``; its failure is raised here."""
    try:
        while not query.awaitTermination(1):
            if done():
                break
    finally:
        query.stop()


def consume(
    stream: DataFrame,
    handler: Handler,
    *,
    order_by: Sequence[str],
    batch_size: int = 100,
    max_batches: int | None = None,
    available_now: bool = True,
    checkpoint: str | None = None,
) -> int:
    """Call ``handler`` with one batch of exactly ``batch_size`` rows after another; return the rows handled.

    Each call is at least one job.  For many batches, or a handler that works on them alike, see
    :func:`consume_together`, which also says how order, failures and a ``checkpoint`` are dealt with.
    """

    def one_by_one(batches: DataFrame, numbers: range) -> None:
        for number in numbers:
            handler(batches.where(F.col("batch_id") == number).drop("batch_id"))

    return _consume(stream, one_by_one, order_by, batch_size, max_batches, available_now, checkpoint)


def consume_together(
    stream: DataFrame,
    handler: Handler,
    *,
    order_by: Sequence[str],
    batch_size: int = 100,
    max_batches: int | None = None,
    available_now: bool = True,
    checkpoint: str | None = None,
) -> int:
    """Call ``handler`` once an epoch with all its whole batches; return the rows handled.

    The table that is handed over has the rows' ``batch_id``; batches have exactly ``batch_size`` rows and are
    numbered from 0 through the whole stream, so the number of jobs does not depend on how many there are.  An epoch
    rarely holds a multiple of ``batch_size``: what is left is written down and comes in front of the next epoch; the last
    remainder is handed over when the stream ends.  ``order_by`` orders rows within an epoch (an offset or an event
    id), by a distributed sort.  With ``max_batches`` the query is stopped after that many.

    The state after each epoch is how many batches were handed over and the remainder.  A later call with the same
    ``checkpoint`` folder carries on there.  An epoch that was cut short is replayed with the same batch ids and
    rows, so a handler that writes by batch id, as :func:`write_batches` does, keeps each batch once.
    """
    clash = {"batch_id", "__position"} & set(stream.columns)
    if clash:
        raise ValueError(f"The stream has columns of its own named {sorted(clash)}")
    return _consume(stream, lambda rows, _: handler(rows), order_by, batch_size, max_batches, available_now, checkpoint)


def write_batches(batches: DataFrame, path: str) -> None:
    """Write batches to a folder for each ``batch_id``; a batch that is handed over again replaces itself."""
    writer = batches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("batch_id").parquet(path)


def each_batch(function: Callable, schema: str) -> Callable[[DataFrame], DataFrame]:
    """A function from one batch to one batch, both pandas frames, applied to all batches in the executors."""
    return lambda batches: batches.groupBy("batch_id").applyInPandas(function, schema)


def _consume(stream, deliver, order_by, batch_size, max_batches, available_now, checkpoint) -> int:
    _check(batch_size, max_batches)
    spark, order = stream.sparkSession, require(stream, order_by)
    folder = checkpoint.rstrip("/") if checkpoint is not None else scratch_folder(spark)
    kept = T.StructType([*stream.schema.fields, T.StructField("__position", T.LongType())])
    done = {"rows": 0, "stop": False, "most": None}

    def state(before: int | None = None) -> tuple[int | None, int, int]:
        """The last whole epoch, the batches handed over until then and the rows left over."""
        number = _latest(spark, f"{folder}/left", before, "_STATE")
        if number is None:
            return None, 0, 0
        batches, rest = _noted(spark, f"{folder}/left/{number}/_STATE").split()
        return number, int(batches), int(rest)

    def hand_over(placed: DataFrame, batches: int, rows: int, number: int, whole_only: bool) -> None:
        """Deliver batches, then write the remainder and, last of all, the state."""
        several = rows // batch_size if whole_only else -(-rows // batch_size)
        if done["most"] is not None:
            several = min(several, done["most"] - batches)
        end = min(several * batch_size, rows)
        if several > 0:
            at = F.floor(F.col("__position") / batch_size).cast("bigint") + batches
            inside = placed.where(F.col("__position") < end).withColumn("batch_id", at)
            deliver(inside.drop("__position"), range(batches, batches + several))
            done["rows"] += end
        done["stop"] = done["most"] is not None and batches + several >= done["most"]
        rest = placed.where(F.col("__position") >= end).withColumn("__position", F.col("__position") - end)
        rest.write.mode("overwrite").parquet(f"{folder}/left/{number}")
        _note(spark, f"{folder}/left/{number}/_STATE", f"{batches + several} {rows - end}")

    def epoch(batch: DataFrame, epoch_id: int) -> None:
        last, batches, rest = state(epoch_id)
        fresh = numbered(batch, order, "__position")
        placed = fresh.withColumn("__position", F.col("__position") + rest).select(*kept.names)
        rows = rest + fresh.count()
        if rest:
            placed = spark.read.schema(kept).parquet(f"{folder}/left/{last}").unionByName(placed)
        hand_over(placed, batches, rows, epoch_id, True)

    if max_batches is not None:  # counted from where the checkpoint stands
        done["most"] = state()[1] + max_batches
    writer = stream.writeStream.foreachBatch(epoch).option("checkpointLocation", f"{folder}/offsets")
    if available_now:
        writer = writer.trigger(availableNow=True)
    _finish(writer.start(), lambda: done["stop"])
    last, batches, rest = state()
    if rest and not done["stop"]:
        left = written(spark.read.schema(kept).parquet(f"{folder}/left/{last}"))
        hand_over(left, batches, rest, last, False)
    return done["rows"]


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _note(spark: SparkSession, path: str, text: str) -> None:
    where, files = _files(spark, path)
    out = files.create(where, True)
    out.writeUTF(text)
    out.close()


def _noted(spark: SparkSession, path: str) -> str:
    where, files = _files(spark, path)
    source = files.open(where)
    text = source.readUTF()
    source.close()
    return text


def _latest(spark: SparkSession, folder: str, before: int | None = None, mark: str = "_SUCCESS") -> int | None:
    """The largest epoch number (below ``before``) that something complete is written for."""
    pattern, files = _files(spark, f"{folder}/*/{mark}")
    found = files.globStatus(pattern) or []
    numbers = [int(f.getPath().getParent().getName()) for f in found]
    return max([n for n in numbers if before is None or n < before], default=None)


def stream_to_dataframe(stream: DataFrame, *, limit: int, available_now: bool = True) -> DataFrame:
    """The first ``limit`` messages of a stream as a table; empty if none arrive."""
    if limit < 0:
        raise ValueError("limit must not be negative")
    spark = stream.sparkSession
    target = scratch_folder(spark)
    stored: dict[int, int] = {}

    def epoch(batch: DataFrame, epoch_id: int) -> None:
        path = f"{target}/{epoch_id}"
        batch.write.mode("overwrite").parquet(path)
        stored[epoch_id] = spark.read.schema(batch.schema).parquet(path).count()

    writer = stream.limit(limit).writeStream.foreachBatch(epoch)
    writer = writer.option("checkpointLocation", scratch_folder(spark))
    if available_now:
        writer = writer.trigger(availableNow=True)
    _finish(writer.start(), lambda: sum(stored.values()) >= limit)
    if not stored:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(*[f"{target}/{e}" for e in sorted(stored)])


def running_totals(
    stream: DataFrame,
    *,
    group_by: str | Sequence[str],
    value: str | Column,
    name: str = "total",
    event_time: str | None = None,
    late_by: str | None = None,
) -> DataFrame:
    """Unbounded sum per key.  ``event_time`` with ``late_by`` sets a watermark, to be
    grouped by as well, so that the state of a long-running query stays bounded."""
    keys = as_list(group_by)
    if event_time is not None and late_by is not None:
        # A watermark is defined on instants, not on local timestamps.
        stream = stream.withColumn(event_time, ref(event_time).cast("timestamp"))
        stream = stream.withWatermark(event_time, late_by)
    amount = ref(value) if isinstance(value, str) else value
    return stream.groupBy(*[ref(k) for k in keys]).agg(F.sum(amount).alias(name))


def final_state(aggregate: DataFrame, *, checkpoint: str | None = None) -> DataFrame:
    """Run a streaming aggregate over all available input and return its final result.

    In complete mode every epoch replaces the table, each under its own path so that a
    replay overwrites only itself.  With a ``checkpoint`` folder a later call reads only
    what has come since and adds it to the state kept there.
    """
    spark = aggregate.sparkSession
    folder = checkpoint.rstrip("/") if checkpoint is not None else scratch_folder(spark)

    def epoch(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/state/{epoch_id}")

    query = (
        aggregate.writeStream.outputMode("complete")
        .foreachBatch(epoch)
        .option("checkpointLocation", f"{folder}/offsets")
        .trigger(availableNow=True)
        .start()
    )
    _finish(query)
    last = _latest(spark, f"{folder}/state")
    if last is None:
        return spark.createDataFrame([], aggregate.schema)
    return spark.read.schema(aggregate.schema).parquet(f"{folder}/state/{last}")
