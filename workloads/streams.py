"""Streaming queries: each runs its stream over all available input and returns the sink."""

from pyspark.sql import functions as F

from quarrystone.operators.cleansing import strip_whitespace
from quarrystone.operators.prescriptive import recommend_by_rules
from quarrystone.plans.scratch import scratch_folder
from quarrystone.streaming import batches

from .registry import query, rounded, table


def events_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    # A glob, since the stream source wants a pattern or a folder rather than one file.
    return spark.readStream.schema(schema).parquet(f"{sf}/events[.]parquet")


@query(
    "micro_batches",
    "SELECT event_id, CAST((row_number() OVER (ORDER BY event_id) - 1) // 100 AS BIGINT) AS batch_id FROM events",
)
def micro_batches(spark, sf):
    placed = batches.assign_batches(table(spark, sf, "events"), order_by=["event_id"], batch_size=100)
    return placed.select("event_id", "batch_id")


@query(
    "micro_batches_bounded",
    """SELECT event_id, batch_id FROM (
         SELECT event_id, CAST((row_number() OVER (ORDER BY ts, event_id) - 1) // 250 AS BIGINT) AS batch_id FROM events)
       WHERE batch_id < 3""",
)
def micro_batches_bounded(spark, sf):
    placed = batches.assign_batches(
        table(spark, sf, "events"), order_by=["ts", "event_id"], batch_size=250, max_batches=3
    )
    return placed.select("event_id", "batch_id")


@query(
    "stream_consume",
    """SELECT CAST((p - 1) // 2500 AS BIGINT) AS batch_id, count(*) AS n, min(event_id) AS first_id,
              max(event_id) AS last_id
       FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) AS p FROM events) GROUP BY 1""",
)
def stream_consume(spark, sf):
    target = scratch_folder(spark)

    def keep(rows):
        sizes = rows.groupBy("batch_id").agg(
            F.count("*").alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id")
        )
        batches.write_batches(sizes, target)

    batches.consume_together(events_stream(spark, sf), keep, order_by=["event_id"], batch_size=2500)
    kept = spark.read.option("basePath", target).parquet(target)
    return kept.select(F.col("batch_id").cast("long").alias("batch_id"), "n", "first_id", "last_id")


@query("stream_snapshot", "SELECT CAST(least(count(*), 1000) AS BIGINT) AS n FROM events")
def stream_snapshot(spark, sf):
    snapshot = batches.stream_to_dataframe(events_stream(spark, sf), limit=1000)
    return snapshot.agg(F.count_distinct("event_id").alias("n"))


@query("stream_snapshot_rows", "SELECT event_id, user_id, event_type, round_even(value, 6) AS value FROM events")
def stream_snapshot_rows(spark, sf):
    """A limit beyond the stream's end: every message, compared row by row."""
    snapshot = batches.stream_to_dataframe(events_stream(spark, sf), limit=10**9)
    return rounded(snapshot.select("event_id", "user_id", "event_type", "value"), ["value"], 6)


@query(
    "stream_totals",
    "SELECT event_type, round_even(sum(value), 2) AS total FROM events GROUP BY event_type",
)
def stream_totals(spark, sf):
    totals = batches.running_totals(events_stream(spark, sf), group_by="event_type", value="value")
    return rounded(batches.final_state(totals), ["total"], 2)


@query(
    "stream_cleaned",
    """SELECT event_id, event_type, CASE WHEN value > 150 THEN 'large' WHEN value > 50 THEN 'medium' ELSE 'small' END
              AS size FROM events""",
)
def stream_cleaned(spark, sf):
    raw = events_stream(spark, sf).select(
        "event_id", F.concat(F.lit("  "), "event_type", F.lit(" ")).alias("event_type"), "value"
    )
    sized = recommend_by_rules(
        strip_whitespace(raw),
        [("value > 150", "large"), ("value > 50", "medium")],
        default_action="small",
        action_column="size",
    ).drop("value")
    target = scratch_folder(spark)
    run = (
        sized.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", scratch_folder(spark))
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return spark.read.schema(sized.schema).parquet(target)
