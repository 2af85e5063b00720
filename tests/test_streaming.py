import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from quarrystone.operators import cleansing
from quarrystone.streaming import batches, readers

EVENT = (
    "event_id bigint, event_time string, region string, product_category string, channel string, "
    "units_sold int, unit_price double, sales double"
)


def drop_files(folder, sizes):
    """JSON event files, one per size, with consecutive ids."""
    folder.mkdir(exist_ok=True)
    at = 0
    for i, size in enumerate(sizes):
        lines = []
        for _ in range(size):
            lines.append(json.dumps({
                "event_id": at, "event_time": f"2024-01-01T00:{at // 60 % 60:02d}:{at % 60:02d}+00:00",
                "region": ["North", "South"][at % 2], "product_category": "c", "channel": " Online ",
                "units_sold": 1, "unit_price": 2.5, "sales": float(at),
            }))
            at += 1
        (folder / f"part{i}.json").write_text("\n".join(lines))
    return str(folder)


@pytest.fixture
def zone(tmp_path):
    return lambda *sizes, per=None: readers.LandingZoneReader(drop_files(tmp_path / "zone", sizes), EVENT, per)


def collected(stream, **options):
    sizes, ids = [], []

    def handler(batch):
        rows = [r["event_id"] for r in batch.collect()]
        sizes.append(len(rows))
        ids.extend(sorted(rows))

    total = batches.consume(stream, handler, order_by=["event_id"], **options)
    return total, sizes, ids


def test_batches_of_exact_size(spark, zone):
    total, sizes, ids = collected(zone(250).load(spark), batch_size=100)
    assert (total, sizes, ids) == (250, [100, 100, 50], list(range(250)))


def test_batches_cross_epochs(spark, zone):
    stream = zone(30, 5, 45, 40, per=1).load(spark)
    total, sizes, ids = collected(stream, batch_size=50)
    assert total == 120 and sizes == [50, 50, 20] and sorted(ids) == list(range(120))


def test_max_batches(spark, zone):
    total, sizes, _ = collected(zone(55).load(spark), batch_size=10, max_batches=3)
    assert (total, sizes) == (30, [10, 10, 10])
    with pytest.raises(ValueError):
        collected(zone(5).load(spark), batch_size=0)


def test_max_batches_ends_an_endless_stream(spark):
    stream = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 25).load()
    sizes = []
    total = batches.consume(
        stream, lambda b: sizes.append(b.count()), order_by=["value"], batch_size=10, max_batches=3, available_now=False
    )
    assert (total, sizes) == (30, [10, 10, 10])


def test_all_batches_of_an_epoch_in_one_call(spark, zone, tmp_path):
    calls, target = [], str(tmp_path / "kept")

    def handler(rows):
        calls.append(1)
        batches.write_batches(rows.select("batch_id", "event_id"), target)

    total = batches.consume_together(zone(230, 45, per=1).load(spark), handler, order_by=["event_id"], batch_size=50)
    kept = spark.read.parquet(target).groupBy("batch_id").agg(F.count("*"), F.min("event_id"), F.max("event_id"))
    assert total == 275 and len(calls) == 3  # two epochs and the last remainder
    assert sorted(map(tuple, kept.collect())) == [
        (0, 50, 0, 49), (1, 50, 50, 99), (2, 50, 100, 149), (3, 50, 150, 199), (4, 50, 200, 249), (5, 25, 250, 274)
    ]
    with pytest.raises(ValueError, match="batch_id"):
        batches.consume_together(zone(1).load(spark).withColumn("batch_id", F.lit(1)), handler, order_by=["event_id"])


def test_jobs_do_not_grow_with_the_batches(spark, zone):
    group, jobs = spark.sparkContext.statusTracker(), []
    stream = zone(240).load(spark)
    for size in (120, 2):
        seen = set()

        def handler(rows, seen=seen):
            rows.groupBy("batch_id").count().collect()
            seen.add(spark.sparkContext.getLocalProperty("spark.jobGroup.id"))

        batches.consume_together(stream, handler, order_by=["event_id"], batch_size=size)
        jobs.append(sum(len(group.getJobIdsForGroup(g)) for g in seen))
    assert jobs[0] > 0 and jobs[1] <= jobs[0] + 1


def test_a_killed_stream_keeps_each_batch_once(spark, zone, tmp_path):
    target, state, calls = str(tmp_path / "kept"), str(tmp_path / "state"), []

    def handler(rows):
        batches.write_batches(rows.select("batch_id", "event_id"), target)
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("killed after its batches were written")

    options = dict(order_by=["event_id"], batch_size=20, checkpoint=state)
    stream = zone(50, 45, 30, per=1).load(spark)
    with pytest.raises(Exception, match="killed"):
        batches.consume_together(stream, handler, **options)
    batches.consume_together(stream, handler, **options)
    kept = spark.read.parquet(target)
    assert sorted(r.event_id for r in kept.collect()) == list(range(125))
    assert {r.batch_id: r["count"] for r in kept.groupBy("batch_id").count().collect()} == {
        **{k: 20 for k in range(6)}, 6: 5
    }
    assert batches.consume_together(stream, handler, **options) == 0


def test_each_batch_runs_in_the_executors(spark, zone):
    found = []
    spread = batches.each_batch(
        lambda pdf: pdf.groupby("batch_id", as_index=False).agg(total=("sales", "sum")), "batch_id bigint, total double"
    )
    batches.consume_together(
        zone(25).load(spark), lambda rows: found.extend(map(tuple, spread(rows).collect())), order_by=["event_id"], batch_size=10
    )
    assert sorted(found) == [(0, 45.0), (1, 145.0), (2, 110.0)]


def test_handler_failures_surface(spark, zone):
    def broken(batch):
        raise RuntimeError("no room")

    with pytest.raises(Exception, match="no room"):
        batches.consume(zone(5).load(spark), broken, order_by=["event_id"])


def test_batch_form(spark):
    out = batches.assign_batches(spark.range(250), order_by=["id"], batch_size=100)
    sizes = {r["batch_id"]: r["count"] for r in out.groupBy("batch_id").count().collect()}
    assert sizes == {0: 100, 1: 100, 2: 50}
    assert batches.assign_batches(spark.range(250), order_by=["id"], max_batches=2).count() == 200


def test_snapshot(spark, zone, tmp_path):
    assert batches.stream_to_dataframe(zone(25).load(spark), limit=10).count() == 10
    assert batches.stream_to_dataframe(zone(25).load(spark), limit=100).count() == 25
    (tmp_path / "none").mkdir()
    empty = readers.LandingZoneReader(str(tmp_path / "none"), EVENT).load(spark)
    snapshot = batches.stream_to_dataframe(empty, limit=5)
    assert snapshot.count() == 0 and snapshot.columns[0] == "event_id"


def test_running_totals_converge_to_the_batch_answer(spark, zone):
    stream = zone(30, 20, 40, per=1).load(spark)
    totals = batches.final_state(batches.running_totals(stream, group_by="region", value="sales"))
    expected = {"North": float(sum(range(0, 90, 2))), "South": float(sum(range(1, 90, 2)))}
    assert {r["region"]: r["total"] for r in totals.collect()} == expected


def test_totals_with_a_watermark(spark, zone):
    stream = zone(90).load(spark).withColumn("event_time", F.to_timestamp("event_time").cast("timestamp_ntz"))
    totals = batches.running_totals(
        stream, group_by=["event_time"], value="sales", event_time="event_time", late_by="10 minutes"
    )
    assert batches.final_state(totals).count() == 90


def test_operators_run_on_streams_and_in_batches(spark, zone):
    stream = cleansing.standardize_column_names(cleansing.strip_whitespace(zone(12).load(spark)))
    seen = []
    batches.consume(
        stream,
        lambda b: seen.extend(r["channel"] for r in cleansing.drop_duplicates(b, subset=["channel"], order_by=["event_id"]).collect()),
        order_by=["event_id"],
        batch_size=6,
    )
    assert seen == ["Online", "Online"]


def test_kafka_messages_are_decoded(spark):
    raw = spark.createDataFrame([(None, bytearray(b'{"region": "N", "sales": 2.5}'))], "key binary, value binary")
    assert tuple(readers.decode_json(raw, "region string, sales double").first()) == ("N", 2.5)
    bad = spark.createDataFrame([(bytearray(b"{oops"),)], "value binary")
    with pytest.raises(Exception, match="MALFORMED"):
        readers.decode_json(bad, "region string").collect()


def test_kafka_settings():
    reader = readers.KafkaReader("t", "a int", ["h1:9092", "h2:9092"], group_id="g", max_offsets_per_trigger=100)
    assert reader.settings() == {
        "kafka.bootstrap.servers": "h1:9092,h2:9092", "subscribe": "t", "startingOffsets": "earliest",
        "kafka.group.id": "g", "maxOffsetsPerTrigger": "100",
    }
    with pytest.raises(ValueError):
        readers.KafkaReader("t", "a int", auto_offset_reset="middle").settings()


def test_user_defined_sources(spark):
    class CountingSource(DataSource):
        """A user-defined stream of 20 numbers over two partitions per epoch."""

        @classmethod
        def name(cls):
            return "counting"

        def schema(self):
            return "event_id bigint"

        def streamReader(self, schema):
            class Reader(DataSourceStreamReader):
                def initialOffset(self):
                    return {"at": 0}

                def latestOffset(self):
                    return {"at": 20}

                def partitions(self, start, end):
                    middle = (start["at"] + end["at"]) // 2
                    return [InputPartition((start["at"], middle)), InputPartition((middle, end["at"]))]

                def read(self, partition):
                    for i in range(*partition.value):
                        yield (i,)

            return Reader()

    stream = readers.CustomReader(CountingSource).load(spark)
    snapshot = batches.stream_to_dataframe(stream, limit=20)
    assert sorted(r["event_id"] for r in snapshot.collect()) == list(range(20))


def test_queries_stop_on_leaving_the_block(spark):
    stream = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load()
    with readers.running(stream.writeStream.format("noop").start()) as query:
        assert query.isActive
    assert not query.isActive
