"""Streaming sources: Kafka topics, JSON landing zones and user-defined formats."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

Schema = T.StructType | str


class StreamReader(Protocol):
    """Anything that opens an unbounded table."""

    def load(self, spark: SparkSession) -> DataFrame: ...


def decode_json(raw: DataFrame, schema: Schema, *, value: str = "value") -> DataFrame:
    """Messages of UTF-8 JSON under a declared schema; unreadable messages raise.

    ``raw`` is what Kafka delivers (``key, value, timestamp``) or any table with such a
    ``value``, batch or streaming.
    """
    text = F.col(value).cast("string")
    return raw.select(F.from_json(text, schema, {"mode": "FAILFAST"}).alias("message")).select("message.*")


@dataclass(frozen=True)
class KafkaReader:
    """A topic of JSON messages.  Needs Spark's Kafka connector on the class path.

    ``group_id`` names the consumer group; where to resume is kept in the checkpoint of
    the query.  ``auto_offset_reset`` (``earliest`` or ``latest``) is where a new query
    starts.  A bounded run uses the ``availableNow`` trigger in place of an idle timeout.
    """

    topic: str
    schema: Schema
    bootstrap_servers: str | list[str] = "localhost:9092"
    group_id: str | None = None
    auto_offset_reset: str = "earliest"
    max_offsets_per_trigger: int | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    def settings(self) -> dict[str, str]:
        if self.auto_offset_reset not in ("earliest", "latest"):
            raise ValueError("auto_offset_reset must be 'earliest' or 'latest'")
        servers = self.bootstrap_servers
        chosen = {
            "kafka.bootstrap.servers": servers if isinstance(servers, str) else ",".join(servers),
            "subscribe": self.topic,
            "startingOffsets": self.auto_offset_reset,
        }
        if self.group_id is not None:
            chosen["kafka.group.id"] = self.group_id
        if self.max_offsets_per_trigger is not None:
            chosen["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        return chosen | dict(self.options)

    def load(self, spark: SparkSession) -> DataFrame:
        raw = spark.readStream.format("kafka").options(**self.settings()).load()
        return decode_json(raw, self.schema)


@dataclass(frozen=True)
class LandingZoneReader:
    """JSON messages that arrive as files in a folder: the replayable form of a queue feed."""

    path: str
    schema: Schema
    max_files_per_trigger: int | None = None

    def load(self, spark: SparkSession) -> DataFrame:
        reader = spark.readStream.schema(self.schema)
        if self.max_files_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", self.max_files_per_trigger)
        return reader.json(self.path)


@dataclass(frozen=True)
class CustomReader:
    """A source written with Spark's Python data source API (a ``DataSource`` subclass)."""

    source: type
    options: Mapping[str, str] = field(default_factory=dict)

    def load(self, spark: SparkSession) -> DataFrame:
        spark.dataSource.register(self.source)
        return spark.readStream.format(self.source.name()).options(**dict(self.options)).load()


@contextmanager
def running(query: StreamingQuery) -> Iterator[StreamingQuery]:
    """Use a query in a ``with`` block; it is stopped on the way out."""
    try:
        yield query
    finally:
        query.stop()
