"""Every operator as a query over the events table: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sunledger import schemas as S
from sunledger.functions import wall_clock_literal
from sunledger.operators import energy, enrich, episodes, keys, metrics, project, slots, yields
from sunledger.plans import views
from sunledger.session import configure, configure_streams, new_run_dir
from sunledger.sinks import tables, topics, versions
from sunledger.sources import csv_readings, csv_with_rejects, decode_json, decode_with_rejects, message_files
from sunledger.streaming.jobs import FILES_PER_DAY, read_results, start_all, start_files, start_print, start_table
from sunledger.streaming.late import read_late, start_late
from sunledger.streaming.replay import replay_in_order
from sunledger.streaming.sources import generator_stream as message_stream
from sunledger.streaming.sources import raw_generator_rows
from sunledger.streaming.sources import watermarked

Query = Callable[[SparkSession, str], DataFrame]

# Capacity of the three test plants, in kW, and the efficiency under which an hour raises an alert.
CAPACITY = [(0, 100), (1, 150), (2, 200)]
EFFICIENCY_ALERT_PCT = 95.0
EFFICIENCY_CLEAR_PCT = 97.0
SLICE = (datetime(2024, 1, 10), datetime(2024, 1, 13))
# Window starts from the half hour on: the first hour that counts is the next.
HOURS = (datetime(2024, 1, 10, 5, 30), datetime(2024, 1, 11, 2))
HALF = datetime(2024, 1, 16)
PLANTS = (0, 1, 2)
#: A replayed run of slots: each is one micro-batch. A published slice, and the files of one trigger over them.
RUN = "3 days"
SLICE_WIDTH = "30 minutes"
FILES_PER_TRIGGER = "200"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return configure(spark).read.schema(views.EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def generator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.generator_readings(events(spark, sf_dir))


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.weather_readings(events(spark, sf_dir))


def capacity(spark: SparkSession) -> DataFrame:
    """As inline VALUES the optimizer knows its size and can choose the broadcast by itself."""
    rows = ", ".join(f"({plant}, {kw})" for plant, kw in CAPACITY)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS capacity(plant_id, capacity_kw)")


def _of_generator(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(generator(spark, sf_dir))


def _of_weather(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(weather(spark, sf_dir))


def _of_both(operator: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(generator(spark, sf_dir), weather(spark, sf_dir))


# --- batch ---


def hourly_production_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.hourly_production_density(generator(spark, sf_dir), capacity(spark))


def dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.dashboard(generator(spark, sf_dir), weather(spark, sf_dir), capacity(spark))


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    efficiency = metrics.conversion_efficiency(generator(spark, sf_dir))
    return metrics.alerts(efficiency, "efficiency_pct", below=EFFICIENCY_ALERT_PCT)


def alert_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raised under 95 %, cleared at 97."""
    efficiency = metrics.conversion_efficiency(generator(spark, sf_dir))
    return episodes.alert_episodes(efficiency, "efficiency_pct", below=EFFICIENCY_ALERT_PCT, clear=EFFICIENCY_CLEAR_PCT)


def pk_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.duplicate_keys(project.generator_metrics(generator(spark, sf_dir)), S.GENERATOR_METRICS.key)


def slot_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = generator(spark, sf_dir)
    first = slots.first_slot(readings)
    if first is None:
        return readings
    second = views.events_between(events(spark, sf_dir), first, first + timedelta(seconds=1))
    return slots.slot_lookup(views.generator_readings(second), first)


def daily_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = views.events_between(events(spark, sf_dir), *SLICE)
    return yields.daily_yield(views.generator_readings(days))


# --- messages and files ---


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_json(project.messages(generator(spark, sf_dir)), S.generator_schema())


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_json(project.messages(generator(spark, sf_dir)), S.generator_schema(T.StringType()))


def json_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and value, decoded again: engines print numbers differently."""
    return decoded_messages(project.messages(generator(spark, sf_dir)))


def decoded_messages(messages: DataFrame) -> DataFrame:
    value_fields = S.generator_schema(T.StringType())
    decoded = messages.select(
        F.from_json("key", "plant_id int, source_key string", {"mode": "FAILFAST"}).alias("k"),
        F.from_json("value", value_fields, {"mode": "FAILFAST"}).alias("v"),
    )
    return decoded.select(
        F.col("k.plant_id").alias("key_plant_id"), F.col("k.source_key").alias("key_source_key"), "v.*"
    )


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings written as CSV files and scanned back."""
    path = new_run_dir(spark, "csv")
    readings = generator(spark, sf_dir)
    readings.withColumn(S.EVENT_TIME, F.date_format(S.EVENT_TIME, "yyyy-MM-dd HH:mm:ss")).write.csv(path, header=True)
    return csv_readings(spark, path, S.generator_schema())


def spoiled(messages: DataFrame) -> DataFrame:
    """Messages of some seconds cut off, without their time, or without a value."""
    second = F.substring("value", 32, 2)
    without_time = F.concat(F.lit("{"), F.expr("substring(value, 36)"))
    value = F.when(second == "07", F.substring("value", 1, 40)).when(second == "11", without_time)
    return messages.select(value.when(second != "13", F.col("value")).alias("value"))


def message_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many messages became readings, and how many were rejected for what."""
    good, rejects = decode_with_rejects(spoiled(project.messages(generator(spark, sf_dir))), S.generator_schema())
    outcomes = good.select(F.lit("reading").alias("outcome")).union(rejects.select("reject_reason"))
    return outcomes.groupBy("outcome").agg(F.count("*").alias("n_rows"))


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for CSV rows: some times in no known form, some left out, some in a further known form."""
    path = new_run_dir(spark, "csv")
    text = F.date_format(S.EVENT_TIME, "yyyy-MM-dd HH:mm:ss")
    when = F.when(F.second(S.EVENT_TIME) == 7, "soon").when(F.second(S.EVENT_TIME) == 11, F.lit(None))
    when = when.when(F.second(S.EVENT_TIME) == 13, F.replace(text, F.lit(" "), F.lit("T"))).otherwise(text)
    generator(spark, sf_dir).withColumn(S.EVENT_TIME, when).write.csv(path, header=True)
    good, rejects = csv_with_rejects(spark, path, S.generator_schema())
    outcomes = good.select(F.lit("reading").alias("outcome")).union(rejects.select("reject_reason"))
    return outcomes.groupBy("outcome").agg(F.count("*").alias("n_rows"))


def weather_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_json(project.messages(weather(spark, sf_dir)), S.weather_schema())


def dry_run_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a dry run wrote, taken apart again."""
    path = new_run_dir(spark, "dry_run")
    topics.dry_run(generator(spark, sf_dir), path)
    parts = F.split("value", "\t", 2)
    return decoded_messages(spark.read.text(path).select(parts[0].alias("key"), parts[1].alias("value")))


# --- stored tables ---


def stored_daily_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """daily_slice, read from the partitioned daily_yield table."""
    path = new_run_dir(spark, "daily_yield")
    tables.write_table(yields.daily_yield(generator(spark, sf_dir)), S.DAILY_YIELD, path)
    return tables.read_slice(spark, S.DAILY_YIELD, path, *SLICE)


def keyed_generator_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """generator_metrics written twice over into a keyed table: each key is there once."""
    path = new_run_dir(spark, "generator_metrics")
    spec = S.GENERATOR_METRICS
    tables.create_table(spark, spec, path)
    for _ in range(2):
        tables.append_new_rows(project.generator_metrics(generator(spark, sf_dir)), spec, path)
    return tables.read_table(spark, spec, path).select(*spec.column_names)


def stored_hourly_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """hourly_yield of some hours, from the stored readings of just these hours."""
    path = new_run_dir(spark, "generator_metrics")
    spec = S.GENERATOR_METRICS
    tables.write_table(project.generator_metrics(generator(spark, sf_dir)), spec, path)
    hours = tables.read_windows(spark, spec, path, *HOURS, timedelta(hours=1))
    return yields.hourly_yield(project.generator_readings(hours))


def loaded_generator_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of single readings after a load of messages in which each comes twice."""
    root = new_run_dir(spark, "history")
    twice = project.messages(generator(spark, sf_dir)).select("value")
    tables.load_messages(twice.unionAll(twice), project.messages(weather(spark, sf_dir)), root)
    spec = S.GENERATOR_METRICS
    return tables.read_table(spark, spec, f"{root}/{spec.name}").select(*spec.column_names)


def _hourly_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored hourly sums before rounding."""
    path = new_run_dir(spark, "hourly_parts")
    tables.write_table(yields.hourly_parts(generator(spark, sf_dir)), S.HOURLY_PARTS, path)
    return tables.read_table(spark, S.HOURLY_PARTS, path)


def daily_yield_from_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """daily_yield from the stored hourly sums: the same bits as from the readings."""
    return yields.daily_from_parts(_hourly_parts(spark, sf_dir))


def daily_production_from_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return yields.production_from_parts(_hourly_parts(spark, sf_dir))


def reloaded_hourly_yield(spark: SparkSession, sf_dir: str) -> DataFrame:
    """hourly_yield behind the pointer, after a load of half of the time and one of all of it."""
    root = new_run_dir(spark, "versions")
    early = F.col(S.EVENT_TIME) < wall_clock_literal(HALF)
    versions.reload_history(generator(spark, sf_dir).filter(early), weather(spark, sf_dir).filter(early), root)
    versions.reload_history(generator(spark, sf_dir), weather(spark, sf_dir), root)
    return versions.read_current(spark, S.HOURLY_YIELD, root).select(*S.HOURLY_YIELD.column_names)


def compacted_generator_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """generator_metrics of many appends, after its closed days were compacted."""
    spec, root = S.GENERATOR_METRICS, new_run_dir(spark, "compacted")
    rows = project.generator_metrics(generator(spark, sf_dir))

    def appended(path: str) -> None:
        tables.create_tables(spark, path)
        for part in range(3):
            share = F.pmod(F.xxhash64("date_time"), F.lit(3)) == part
            tables.append_new_rows(rows.filter(share), spec, f"{path}/{spec.name}")

    versions.replace_all(spark, root, appended)
    versions.compact(spark, root, HALF.date())
    return versions.read_current(spark, spec, root).select(*spec.column_names)


# --- streams: the events table as a file stream, run until it is used up ---


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No limit per micro-batch: files need not be in event-time order for every row to count.

    A file stream wants a folder or a glob; this glob fits the one name, be it a file or a folder of files.
    """
    return configure_streams(spark).readStream.schema(views.EVENTS_SCHEMA).parquet(f"{sf_dir}/{{events}}.parquet")


def generator_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watermarked(views.generator_readings(event_stream(spark, sf_dir), "timestamp"))


def weather_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watermarked(views.weather_readings(event_stream(spark, sf_dir), "timestamp"))


def _run_table(spark: SparkSession, stream: DataFrame, spec: S.TableSpec) -> DataFrame:
    run = new_run_dir(spark, f"{spec.name}_stream")
    files = FILES_PER_DAY.get(spec.name)
    query = start_table(stream, spec, f"{run}/table", f"{run}/checkpoint", available_now=True, files_per_day=files)
    query.awaitTermination()
    return tables.read_table(spark, spec, f"{run}/table").select(*spec.column_names)


def _run_files(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    run = new_run_dir(spark, name)
    start_files(stream, f"{run}/rows", f"{run}/checkpoint").awaitTermination()
    return read_results(spark, f"{run}/rows", stream.schema)


def hourly_yield_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_table(spark, yields.hourly_yield(generator_stream(spark, sf_dir)), S.HOURLY_YIELD)


def daily_yield_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_table(spark, yields.daily_yield(generator_stream(spark, sf_dir)), S.DAILY_YIELD)


def generator_metrics_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_table(spark, project.generator_metrics(generator_stream(spark, sf_dir)), S.GENERATOR_METRICS)


def weather_metrics_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_table(spark, project.weather_metrics(weather_stream(spark, sf_dir)), S.WEATHER_METRICS)


def generator_weather_join_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = metrics.generator_weather_join(generator_stream(spark, sf_dir), weather_stream(spark, sf_dir))
    return _run_files(spark, joined, "generator_weather_join")


def enriched_readings_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = enrich.enrich_readings(generator_stream(spark, sf_dir), weather_stream(spark, sf_dir))
    return _run_files(spark, joined, "enriched_readings")


def dashboard_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = generator_stream(spark, sf_dir), weather_stream(spark, sf_dir)
    return _run_files(spark, metrics.dashboard(*readings, capacity(spark)), "dashboard")


def alerts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    efficiency = metrics.conversion_efficiency(generator_stream(spark, sf_dir))
    low = metrics.alerts(efficiency, "efficiency_pct", below=EFFICIENCY_ALERT_PCT)
    return _run_files(spark, low, "alerts")


# --- streams of message files ---


def generator_messages(spark: SparkSession, sf_dir: str, path: str, share: Column | None = None) -> None:
    """The readings, or those of a share, as message files."""
    readings = generator(spark, sf_dir)
    topics.write_messages(readings if share is None else readings.filter(share), path)


def _started(spark: SparkSession, sf_dir: str, copies: int = 1) -> str:
    """All result tables, filled through both message streams until these are used up."""
    configure_streams(spark)
    run = new_run_dir(spark, "fan_out")
    for _ in range(copies):
        generator_messages(spark, sf_dir, f"{run}/generator")
    topics.write_messages(weather(spark, sf_dir), f"{run}/weather")
    streams = [message_files(spark, f"{run}/{name}", stream=True) for name in ("generator", "weather")]
    for query in start_all(*streams, f"{run}/tables", f"{run}/checkpoints", available_now=True).values():
        query.awaitTermination()
    return f"{run}/tables"


def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each result table after the streams."""
    root = _started(spark, sf_dir)
    counts = [
        tables.read_table(spark, spec, f"{root}/{name}").agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows"))
        for name, spec in S.TABLES.items()
    ]
    return reduce(DataFrame.union, counts)


def streamed_generator_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of single readings after streams in which each message comes twice."""
    spec = S.GENERATOR_METRICS
    root = _started(spark, sf_dir, copies=2)
    return tables.read_table(spark, spec, f"{root}/{spec.name}").select(*spec.column_names)


def _hourly_from(spark: SparkSession, messages: str, run: str, **options: str) -> DataFrame:
    files = message_files(configure_streams(spark), messages, stream=True, **options)
    stream = yields.hourly_yield(message_stream(files))
    files = FILES_PER_DAY[S.HOURLY_YIELD.name]
    start_table(
        stream, S.HOURLY_YIELD, f"{run}/table", f"{run}/checkpoint", available_now=True, files_per_day=files
    ).awaitTermination()
    return tables.read_table(spark, S.HOURLY_YIELD, f"{run}/table").select(*S.HOURLY_YIELD.column_names)


def hourly_yield_from_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = new_run_dir(spark, "from_messages")
    generator_messages(spark, sf_dir, f"{run}/in")
    return _hourly_from(spark, f"{run}/in", run)


def restarted_hourly_yield(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the time, then a new start on the same checkpoint with the other half."""
    run = new_run_dir(spark, "restarted")
    early = F.col(S.EVENT_TIME) < wall_clock_literal(HALF)
    for share in (early, ~early):
        generator_messages(spark, sf_dir, f"{run}/in", share)
        rows = _hourly_from(spark, f"{run}/in", run)
    return rows


def replayed_hourly_yield(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files, replayed in event-time order to one stream, a run of slots in each micro-batch."""
    run = new_run_dir(spark, "replayed")
    files = FILES_PER_DAY[S.HOURLY_YIELD.name]

    def start(path: str) -> StreamingQuery:
        stream = yields.hourly_yield(message_stream(message_files(configure_streams(spark), path, stream=True)))
        return start_table(stream, S.HOURLY_YIELD, f"{run}/table", f"{run}/checkpoint", available_now=True, files_per_day=files)

    for _ in replay_in_order(csv_scan(spark, sf_dir), f"{run}/staged", f"{run}/in", start, RUN):
        pass
    return tables.read_table(spark, S.HOURLY_YIELD, f"{run}/table").select(*S.HOURLY_YIELD.column_names)


def published_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings that come plant by plant, published by time; a stream that takes the files in a bounded number at a
    time closes every hour with all its readings."""
    run = new_run_dir(spark, "published")
    readings = generator(spark, sf_dir)
    by_plant = reduce(DataFrame.unionAll, [readings.filter(F.col(S.PLANT) == plant) for plant in PLANTS])
    topics.stage_slices(by_plant, f"{run}/staged", SLICE_WIDTH)
    topics.publish_files(spark, f"{run}/staged", f"{run}/in")
    return _hourly_from(spark, f"{run}/in", run, maxFilesPerTrigger=FILES_PER_TRIGGER)


def late_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One plant after the other on one stream: what the plants before have closed, the next is late for."""
    run = new_run_dir(spark, "late")
    schema = S.generator_schema(T.TimestampType())
    for plant in PLANTS:
        generator_messages(spark, sf_dir, f"{run}/in", F.col(S.PLANT) == plant)
        stream = decode_json(message_files(configure_streams(spark), f"{run}/in", stream=True), schema)
        start_late(stream, f"{run}/out", f"{run}/checkpoint", available_now=True).awaitTermination()
    return read_late(spark, f"{run}/out", schema)


def printed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows of a stream from its earliest message on, printed as lines and read back."""
    run = new_run_dir(spark, "printed")
    generator_messages(spark, sf_dir, f"{run}/in")
    stream = raw_generator_rows(message_files(configure_streams(spark), f"{run}/in", stream=True))
    start_print(stream, f"{run}/lines", f"{run}/checkpoint", available_now=True).awaitTermination()
    lines = spark.read.text(f"{run}/lines")
    fields = S.generator_schema(T.StringType())
    return lines.select(F.from_json("value", fields, {"mode": "FAILFAST"}).alias("row")).select("row.*")


def asof_enriched_readings_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = enrich.asof_enriched(generator_stream(spark, sf_dir), weather_stream(spark, sf_dir))
    return _run_files(spark, joined, "asof_enriched_readings")


def alert_episodes_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = metrics.generator_by_window(generator_stream(spark, sf_dir))
    low = episodes.alert_episodes_stream(hours, "efficiency_pct", below=EFFICIENCY_ALERT_PCT)
    return _run_files(spark, low, "alert_episodes")


QUERIES: dict[str, Query] = {
    "generator_metrics": _of_generator(project.generator_metrics),
    "weather_metrics": _of_weather(project.weather_metrics),
    "daily_yield": _of_generator(yields.daily_yield),
    "hourly_yield": _of_generator(yields.hourly_yield),
    "hourly_production_density": hourly_production_density,
    "hourly_avg_irradiation": _of_weather(metrics.hourly_avg_irradiation),
    "avg_dc_power": _of_generator(metrics.avg_dc_power),
    "avg_ac_power": _of_generator(metrics.avg_ac_power),
    "temperature_delta": _of_weather(metrics.temperature_delta),
    "conversion_efficiency": _of_generator(metrics.conversion_efficiency),
    "daily_production": _of_generator(metrics.daily_production),
    "generator_weather_join": _of_both(metrics.generator_weather_join),
    "enriched_readings": _of_both(enrich.enrich_readings),
    "dashboard": dashboard,
    "alerts": alerts,
    "pk_duplicates": pk_duplicates,
    "slot_gaps": _of_generator(slots.slot_gaps),
    "slot_bounds": _of_generator(slots.slot_bounds),
    "rows_per_slot": _of_generator(slots.rows_per_slot),
    "slot_lookup": slot_lookup,
    "daily_slice": daily_slice,
    "stored_daily_slice": stored_daily_slice,
    "keyed_generator_metrics": keyed_generator_metrics,
    "json_roundtrip": json_roundtrip,
    "raw_rows": raw_rows,
    "json_messages": json_messages,
    "csv_scan": csv_scan,
    "message_rejects": message_rejects,
    "csv_rejects": csv_rejects,
    "weather_json_roundtrip": weather_json_roundtrip,
    "dry_run_messages": dry_run_messages,
    "stored_hourly_slice": stored_hourly_slice,
    "loaded_generator_metrics": loaded_generator_metrics,
    "fan_out": fan_out,
    "streamed_generator_metrics": streamed_generator_metrics,
    "hourly_yield_from_messages": hourly_yield_from_messages,
    "restarted_hourly_yield": restarted_hourly_yield,
    "replayed_hourly_yield": replayed_hourly_yield,
    "hourly_yield_stream": hourly_yield_stream,
    "daily_yield_stream": daily_yield_stream,
    "generator_metrics_stream": generator_metrics_stream,
    "weather_metrics_stream": weather_metrics_stream,
    "generator_weather_join_stream": generator_weather_join_stream,
    "enriched_readings_stream": enriched_readings_stream,
    "dashboard_stream": dashboard_stream,
    "alerts_stream": alerts_stream,
    "daily_yield_from_hours": daily_yield_from_hours,
    "daily_production_from_hours": daily_production_from_hours,
    "reloaded_hourly_yield": reloaded_hourly_yield,
    "compacted_generator_metrics": compacted_generator_metrics,
    "published_in_order": published_in_order,
    "late_readings": late_readings,
    "printed_messages": printed_messages,
    "asof_enriched_readings": _of_both(enrich.asof_enriched),
    "asof_enriched_readings_stream": asof_enriched_readings_stream,
    "hourly_energy": _of_generator(energy.hourly_energy),
    "alert_episodes": alert_episodes,
    "alert_episodes_stream": alert_episodes_stream,
}
