"""Telemetry topics. The connector is not part of Spark's own jars: submit with the matching
``spark-sql-kafka`` package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(
    bootstrap: str,
    topic: str,
    starting: str = "earliest",
    group_id: str | None = None,
    min_partitions: int | None = None,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Read a topic from its start. A topic has few partitions, each maybe a third of all rows:
    ``min_partitions`` splits them into more read tasks, ``max_offsets_per_trigger`` bounds a micro-batch."""
    options = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting,
        "kafka.group.id": group_id,
        "minPartitions": min_partitions,
        "maxOffsetsPerTrigger": max_offsets_per_trigger,
    }
    return {name: str(value) for name, value in options.items() if value is not None}


def kafka_messages(spark: SparkSession, options: dict[str, str], stream: bool = True) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    return reader.format("kafka").options(**options).load()
