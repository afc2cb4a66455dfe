"""The four result streams and how to run them.

Each result is its own query with its own checkpoint: one can fail, restart or lag without the others. Each
decodes only the message fields it needs. The checkpoint holds the read position and the open windows, so a
restart goes on where the last committed micro-batch ended.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from sunledger.operators.results import result_tables
from sunledger.schemas import (
    DAILY_YIELD,
    EVENT_TIME,
    GENERATOR_METRICS,
    HOURLY_YIELD,
    PLANT,
    SOURCE,
    TABLES,
    WEATHER_METRICS,
    TableSpec,
    generator_schema,
    weather_schema,
)
from sunledger.session import configure_streams, path_exists
from sunledger.sinks.tables import PARTITION, STREAM_LOG, append_new_rows, create_table, dated
from sunledger.sources.decode import decode_with_rejects
from sunledger.streaming.progress import watch
from sunledger.streaming.sources import generator_stream, weather_stream

YIELD_FIELDS = [EVENT_TIME, "DAILY_YIELD", PLANT, SOURCE]
PARTITIONS = "spark.sql.shuffle.partitions"
READINGS = (GENERATOR_METRICS.name, WEATHER_METRICS.name)
#: Batches that the ledger of a keyed append remembers; Spark itself repeats the last one at most.
LEDGER = 100
FILES_PER_DAY = {DAILY_YIELD.name: 8, HOURLY_YIELD.name: 8}
READING_FIELDS = [EVENT_TIME, "DC_POWER", "AC_POWER", "DAILY_YIELD", PLANT, SOURCE]


def result_streams(generator: DataFrame, weather: DataFrame, mode: str = "FAILFAST") -> dict[str, DataFrame]:
    """Result table name to streaming DataFrame, from the two message streams."""
    return result_tables(
        generator_stream(generator, mode, READING_FIELDS),
        weather_stream(weather, mode),
        generator_stream(generator, mode, YIELD_FIELDS),
    )


def _writer(stream: DataFrame, checkpoint: str, available_now: bool, every: str) -> DataStreamWriter:
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)


def _start(spark: SparkSession, writer: DataStreamWriter, path: str | None = None) -> StreamingQuery:
    """Start with the state split as the session says, but in a local session over its cores at most: every
    state partition costs files per micro-batch. The query keeps the number for good, in its checkpoint."""
    configure_streams(spark)
    watch(spark)
    context = spark.sparkContext
    partitions = int(spark.conf.get(PARTITIONS))
    if not context.master.startswith("local") or partitions <= context.defaultParallelism:
        return writer.start(path)
    spark.conf.set(PARTITIONS, str(context.defaultParallelism))
    try:
        return writer.start(path)
    finally:
        spark.conf.set(PARTITIONS, str(partitions))


def start_table(
    stream: DataFrame,
    spec: TableSpec,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    every: str = "1 minute",
    files_per_day: int | None = None,
) -> StreamingQuery:
    """To date-partitioned Parquet. The file sink's commit log makes each micro-batch appear exactly once, and
    is all that readers of the folder go by: a table that holds rows written in batch cannot be gone on with
    here, but can with :func:`start_keyed`.

    Window sums leave their aggregation spread over all shuffle tasks, so each task would write a small file
    for each day of the batch. ``files_per_day`` brings a day's rows together in that many tasks; more of them
    split a day that holds most of a batch. Pass-through rows arrive by time as it is and need none.
    """
    spark = stream.sparkSession
    if path_exists(spark, f"{path}/{PARTITION}=*") and not path_exists(spark, f"{path}/{STREAM_LOG}"):
        raise ValueError(f"{path} holds rows written in batch, which the stream's file sink would hide")
    rows = dated(stream, spec)
    if files_per_day is not None:
        share = F.pmod(F.xxhash64(*spec.key), F.lit(files_per_day))
        rows = rows.repartition(PARTITION, share)
    writer = _writer(rows, checkpoint, available_now, every)
    writer = writer.queryName(spec.name).partitionBy(PARTITION).format("parquet")
    return _start(spark, writer, path)


def start_files(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """To plain Parquet, for results that are none of the four tables."""
    writer = _writer(stream, checkpoint, available_now, "1 minute").format("parquet")
    return _start(stream.sparkSession, writer, path)


def start_keyed(
    stream: DataFrame,
    append: Callable[[DataFrame], None],
    checkpoint: str,
    available_now: bool = False,
    every: str = "1 minute",
) -> StreamingQuery:
    """To a keyed store: ``append`` gets each micro-batch and must not mind getting one twice, as
    ``append_new_rows`` of either table sink does not.

    The checkpoint holds a ledger of the batches whose append ended. A batch that runs again because the job stopped between
    its append and Spark's commit is known by its number and left out, without a look at the store's keys; one that stopped
    half-way is not in the ledger, and its keys tell what it had written. A new checkpoint has a ledger of its own.
    """
    spark, ledger = stream.sparkSession, f"{checkpoint}/appended"

    def write(batch: DataFrame, number: int) -> None:
        if path_exists(spark, f"{ledger}/{number}"):
            return
        append(batch)
        mark(spark, f"{ledger}/{number}", f"{ledger}/{number - LEDGER}")

    return start_batches(stream, write, checkpoint, available_now, every)


def mark(spark: SparkSession, path: str, old: str) -> None:
    """An empty file, and away with an old one."""
    new, gone = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, old))
    fs = new.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.create(new, True).close()
    fs.delete(gone, False)


def start_batches(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    available_now: bool = False,
    every: str = "1 minute",
) -> StreamingQuery:
    """Each micro-batch and its number to ``write``, which must replace what it wrote under the same number before."""
    return _start(stream.sparkSession, _writer(stream, checkpoint, available_now, every).foreachBatch(write))


def start_print(
    stream: DataFrame, path: str, checkpoint: str, available_now: bool = False, every: str = "1 minute"
) -> StreamingQuery:
    """Every row, whole, as one line of JSON in text files that the tasks write."""
    lines = stream.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("line"))
    return _start(stream.sparkSession, _writer(lines, checkpoint, available_now, every).format("text"), path)


def start_preview(stream: DataFrame, checkpoint: str, rows: int = 20, available_now: bool = False) -> StreamingQuery:
    """The first few rows of each micro-batch, on the driver's screen."""
    writer = _writer(stream, checkpoint, available_now, "1 minute").format("console")
    return _start(stream.sparkSession, writer.option("numRows", rows).option("truncate", False))


def start_all(
    generator: DataFrame,
    weather: DataFrame,
    root: str,
    checkpoints: str,
    available_now: bool = False,
    mode: str = "FAILFAST",
    targets: Mapping[str, Callable[[DataFrame], None]] | None = None,
) -> dict[str, StreamingQuery]:
    """Fan the two message streams out to the four result tables under ``root``.

    The yield tables have one row per key as they are. The tables of single readings are keyed stores: a reading that
    comes again, in a replay or by another checkpoint, adds nothing. ``targets`` sends a table elsewhere, by name: a
    function that appends a micro-batch and does not mind getting one twice, such as ``append_new_rows`` of
    ``sinks.jdbc``.

    In FAILFAST mode a message that is no reading stops its query. Otherwise such messages go, with the reason, to the
    tables ``generator_rejects`` and ``weather_rejects`` under ``root``.
    """
    targets = dict(targets or {})
    queries = {}
    for name, stream in result_streams(generator, weather, mode).items():
        spec, path, checkpoint = TABLES[name], f"{root}/{name}", f"{checkpoints}/{name}"
        if name in READINGS and name not in targets:
            targets[name] = _keyed_table(stream.sparkSession, spec, path)
        if name in targets:
            queries[name] = start_keyed(stream, targets[name], checkpoint, available_now)
        else:
            files = FILES_PER_DAY.get(name)
            queries[name] = start_table(stream, spec, path, checkpoint, available_now, files_per_day=files)
    if mode != "FAILFAST":
        for name, messages, schema in (
            ("generator_rejects", generator, generator_schema()),
            ("weather_rejects", weather, weather_schema()),
        ):
            _, rejects = decode_with_rejects(messages, schema)
            queries[name] = start_files(rejects, f"{root}/{name}", f"{checkpoints}/{name}", available_now)
    return queries


def _keyed_table(spark: SparkSession, spec: TableSpec, path: str) -> Callable[[DataFrame], None]:
    if path_exists(spark, f"{path}/{STREAM_LOG}"):
        raise ValueError(f"{path} belongs to a stream's file sink: readers would not see rows appended by others")
    if not path_exists(spark, path):
        create_table(spark, spec, path)
    return lambda batch: append_new_rows(batch, spec, path)


def print_raw(
    generator: DataFrame, weather: DataFrame, root: str, checkpoints: str, available_now: bool = False
) -> list[StreamingQuery]:
    """Both raw streams as text under ``root``, each by itself."""
    streams = {"generator": generator, "weather": weather}
    return [
        start_print(stream, f"{root}/{name}", f"{checkpoints}/print_{name}", available_now)
        for name, stream in streams.items()
    ]


def read_results(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What a stream has committed so far. The schema is named, so an empty result reads as well."""
    return spark.read.schema(schema).parquet(path)
