"""Result tables in a relational store. The driver jar is not part of Spark: submit with it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sunledger.operators.keys import new_rows
from sunledger.schemas import SINK_SCHEMA, TableSpec
from sunledger.sinks.tables import TimeRange, touched_ranges

DRIVER = "org.postgresql.Driver"


def jdbc_options(
    url: str, table: str, user: str, password: str, schema: str = SINK_SCHEMA, driver: str = DRIVER, **more: str
) -> dict[str, str]:
    """Connection options with the table name quoted as ``"schema"."table"``. ``more`` takes any further JDBC
    option, ``numPartitions`` above all: it bounds the connections a wide job may open."""
    return {
        "url": url,
        "dbtable": f'"{schema}"."{table}"',
        "user": user,
        "password": password,
        "driver": driver,
        **more,
    }


def append_rows(rows: DataFrame, spec: TableSpec, options: dict[str, str]) -> None:
    rows.select(*spec.column_names).write.format("jdbc").options(**options).mode("append").save()


def range_predicates(column: str, ranges: list[TimeRange]) -> list[str]:
    """Each range of time as one SQL predicate: one query of its own to the database."""
    return [f"\"{column}\" >= timestamp '{a}' AND \"{column}\" < timestamp '{b}'" for a, b in ranges]


def stored_keys(spark: SparkSession, spec: TableSpec, options: dict[str, str], ranges: list[TimeRange]) -> DataFrame:
    """Keys of some ranges of time, read in parallel. The ranges and the column list run in the database."""
    properties = {k: v for k, v in options.items() if k not in ("url", "dbtable", "numPartitions")}
    properties["preferTimestampNTZ"] = "true"
    predicates = range_predicates(spec.time_column, ranges)
    table = spark.read.jdbc(options["url"], options["dbtable"], predicates=predicates, properties=properties)
    return table.select(*spec.key)


def append_new_rows(batch: DataFrame, spec: TableSpec, options: dict[str, str]) -> None:
    """Append the rows whose key is not stored yet; only the hours that the batch has rows of are looked up. A batch that
    failed half-way can simply run again, and a replay from the earliest message does not trip over the primary key. A
    row without a time stops the append."""
    batch = batch.persist()
    try:
        ranges = touched_ranges(batch, spec)
        if not ranges:
            return
        stored = stored_keys(batch.sparkSession, spec, options, ranges)
        append_rows(new_rows(batch, stored, spec), spec, options)
    finally:
        batch.unpersist()


def reset_table(spark: SparkSession, spec: TableSpec, options: dict[str, str]) -> None:
    """TRUNCATE: the table keeps its key, its partitioning and its grants."""
    empty = spark.createDataFrame([], spec.schema)
    empty.write.format("jdbc").options(**options).option("truncate", True).mode("overwrite").save()
