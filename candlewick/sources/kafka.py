"""Kafka topics as batch and streaming frames, over Spark's Kafka connector (package ``spark-sql-kafka-0-10``)."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql.streaming import DataStreamReader, DataStreamWriter

RECORD_COLUMNS = ("key", "value", "topic", "partition", "offset", "timestamp")


@dataclass(frozen=True)
class KafkaConfig:
    servers: str = "localhost:9092"
    username: str | None = None
    password: str = field(default="", repr=False)

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> KafkaConfig:
        return cls(env.get("KAFKA_BOOTSTRAP_SERVERS", "localhost:9092"), env.get("KAFKA_USERNAME"),
                   env.get("KAFKA_PASSWORD", ""))

    def options(self) -> dict[str, str]:
        """Connection options; with a user name, SASL/PLAIN."""
        options = {"kafka.bootstrap.servers": self.servers}
        if self.username is not None:
            user, password = (text.replace("\\", "\\\\").replace('"', '\\"') for text in (self.username, self.password))
            options |= {
                "kafka.security.protocol": "SASL_PLAINTEXT",
                "kafka.sasl.mechanism": "PLAIN",
                "kafka.sasl.jaas.config": "org.apache.kafka.common.security.plain.PlainLoginModule required "
                                          f'username="{user}" password="{password}";',
            }
        return options


def _source(reader: DataFrameReader | DataStreamReader, config: KafkaConfig, options: Mapping[str, object]):
    return reader.format("kafka").options(**config.options()).options(**options)


def read_stream(spark: SparkSession, config: KafkaConfig, *topics: str, starting_offsets: str = "latest",
                max_offsets_per_trigger: int | None = None, min_partitions: int | None = None,
                options: Mapping[str, object] | None = None) -> DataFrame:
    """Endless frame over one or more topics; ``min_partitions`` splits busy topic partitions over more tasks.

    ``options``: any others of the Kafka source.
    """
    return _source(spark.readStream, config, {**stream_options(topics, starting_offsets, max_offsets_per_trigger,
                                                               min_partitions), **(options or {})}).load()


def stream_options(topics, starting_offsets="latest", max_offsets_per_trigger=None, min_partitions=None) -> dict:
    options = {"subscribe": ",".join(topics), "startingOffsets": starting_offsets}
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = max_offsets_per_trigger
    if min_partitions is not None:
        options["minPartitions"] = min_partitions
    return options


def partition_options(topic: str, partition: int, start: int | str = "earliest", end: int | str = "latest") -> dict:
    """Options for one partition of a topic between two offsets."""
    def offsets(value: int | str) -> str:
        return value if isinstance(value, str) else json.dumps({topic: {str(partition): value}})

    return {"assign": json.dumps({topic: [partition]}), "startingOffsets": offsets(start),
            "endingOffsets": offsets(end)}


def read_partition(spark: SparkSession, config: KafkaConfig, topic: str, partition: int = 0,
                   start: int | str = "earliest", end: int | str = "latest") -> DataFrame:
    """Bounded read of one partition: key and value as text, offset and timestamp."""
    records = _source(spark.read, config, partition_options(topic, partition, start, end)).load()
    return record_preview(records)


def record_preview(records: DataFrame) -> DataFrame:
    return records.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value", "offset", "timestamp")


def write_batch(df: DataFrame, config: KafkaConfig, topic: str) -> None:
    """Send the rows' ``key`` and ``value``."""
    df.select("key", "value").write.format("kafka").options(**config.options()).option("topic", topic).save()


def stream_writer(df: DataFrame, config: KafkaConfig, topic: str, checkpoint: str,
                  output_mode: str = "append") -> DataStreamWriter:
    """Writer for ``key`` and ``value``; each query needs a checkpoint folder of its own."""
    writer = df.writeStream.format("kafka").outputMode(output_mode).options(**config.options())
    return writer.option("topic", topic).option("checkpointLocation", checkpoint)
