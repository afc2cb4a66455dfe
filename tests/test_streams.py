import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import ScriptedStream, at, generator, generator_row, message, rows
from sunledger import schemas as S
from sunledger.operators import keys, metrics, project, yields
from sunledger.session import ROCKSDB, configure_streams
from sunledger.sinks import tables
from sunledger.sources import csv_readings, decode_json, message_files
from sunledger.streaming import jobs
from sunledger.streaming.progress import progress_report
from sunledger.streaming.replay import replay
from sunledger.streaming.sources import (
    generator_stream,
    raw_generator_rows,
    raw_weather_rows,
    weather_stream,
    with_rejects,
)

L1 = """
00:00 1    00:45 2
01:30 4    00:15 8
00:30 16   01:15 32
03:00 64   03:00 64
"""
L2 = """
00:00 1
02:00 2
02:10 4
00:30 16   01:45 32
"""


@pytest.fixture
def scripted(spark, tmp_path):
    return ScriptedStream(spark, tmp_path / "in")


def run_hourly(scripted, tmp_path):
    stream = yields.hourly_yield(generator_stream(scripted.stream()))
    query = jobs.start_table(
        stream, S.HOURLY_YIELD, str(tmp_path / "out"), str(tmp_path / "checkpoint"), available_now=True
    )
    query.awaitTermination()
    return query


def hourly_rows(spark, tmp_path):
    table = tables.read_table(spark, S.HOURLY_YIELD, str(tmp_path / "out"))
    return sorted((r.window_start.strftime("%H:%M"), r.total_yield) for r in table.collect())


def test_rows_within_the_delay_all_count(spark, scripted, tmp_path):
    query = run_hourly(scripted.script(L1), tmp_path)
    assert hourly_rows(spark, tmp_path) == [("00:00", 27.0), ("01:00", 36.0)]
    report = progress_report(query)
    assert report["late_rows"] == 0
    assert report["input_rows"] == 8
    assert report["open_rows"] == 1


def test_rows_after_their_window_closed_are_left_out(spark, scripted, tmp_path):
    query = run_hourly(scripted.script(L2), tmp_path)
    assert hourly_rows(spark, tmp_path) == [("00:00", 1.0)]
    assert progress_report(query)["late_rows"] == 1


def test_restart_goes_on_where_it_ended(spark, scripted, tmp_path):
    run_hourly(scripted.script(L2), tmp_path)
    run_hourly(scripted, tmp_path)
    assert hourly_rows(spark, tmp_path) == [("00:00", 1.0)]
    scripted.add(message("05:00", 1))
    run_hourly(scripted, tmp_path)
    assert hourly_rows(spark, tmp_path) == [("00:00", 1.0), ("01:00", 32.0), ("02:00", 6.0)]


def test_the_small_state_store_gives_the_same(spark, scripted, tmp_path, monkeypatch):
    provider = "spark.sql.streaming.stateStore.providerClass"
    assert spark.conf.get(provider) == ROCKSDB
    monkeypatch.setattr(jobs, "configure_streams", lambda session: configure_streams(session, rocksdb=False))
    spark.conf.unset(provider)
    try:
        assert spark.conf.get(provider) != ROCKSDB
        run_hourly(scripted.script(L1), tmp_path)
    finally:
        spark.conf.set(provider, ROCKSDB)
    assert hourly_rows(spark, tmp_path) == [("00:00", 27.0), ("01:00", 36.0)]


def test_pass_through_never_drops(spark, scripted, tmp_path):
    stream = project.generator_metrics(generator_stream(scripted.script(L2).stream()))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    jobs.start_table(stream, S.GENERATOR_METRICS, out, checkpoint, available_now=True).awaitTermination()
    assert tables.read_table(spark, S.GENERATOR_METRICS, out).count() == 5


@pytest.mark.parametrize("spread", [1, 4])
def test_repeats_within_the_delay_are_dropped(spark, scripted, tmp_path, spread):
    stream = keys.first_readings(generator_stream(scripted.script(L1).stream()), spread=spread)
    jobs.start_files(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    assert jobs.read_results(spark, str(tmp_path / "out"), stream.schema).count() == 7


def test_stream_and_batch_do_not_share_a_file_sink(spark, scripted, tmp_path):
    spec = S.GENERATOR_METRICS
    stream = project.generator_metrics(generator_stream(scripted.script("00:00 1").stream()))
    batch = project.generator_metrics(generator(spark, [generator_row("00:00", 1)]))
    by_batch, by_stream = str(tmp_path / "by_batch"), str(tmp_path / "by_stream")
    tables.write_table(batch, spec, by_batch)
    with pytest.raises(ValueError, match="written in batch"):
        jobs.start_table(stream, spec, by_batch, str(tmp_path / "c0"), available_now=True)
    tables.create_table(spark, spec, by_stream)
    for _ in range(2):
        jobs.start_table(stream, spec, by_stream, str(tmp_path / "c1"), available_now=True).awaitTermination()
    with pytest.raises(ValueError, match="file sink"):
        tables.write_table(batch, spec, by_stream)
    assert tables.read_table(spark, spec, by_stream).count() == 1


def test_one_day_of_a_batch_is_one_file_per_share(spark, scripted, tmp_path):
    scripted.script("00:00 1 01:00 1 02:00 1 03:00 1 04:00 1 05:00 1 06:00 1 07:00 1\n23:00 1")
    stream = yields.hourly_yield(generator_stream(scripted.stream()))
    out = tmp_path / "out"
    jobs.start_table(
        stream, S.HOURLY_YIELD, str(out), str(tmp_path / "c"), available_now=True, files_per_day=2
    ).awaitTermination()
    assert len(hourly_rows(spark, tmp_path)) == 8
    # Two micro-batches close windows of that day, with two shares each.
    assert len(list((out / "event_date=2020-05-15").glob("*.parquet"))) <= 4


def test_rejects_of_a_stream(spark, scripted, tmp_path):
    scripted.add(message("00:00", 1), "{bad")
    scripted.add(message("03:00", 2))
    good, rejects = with_rejects(scripted.stream(), S.generator_schema(T.TimestampType()))
    for name, stream in (("good", yields.hourly_yield(good)), ("rejects", rejects)):
        jobs.start_files(stream, str(tmp_path / name), str(tmp_path / f"checkpoint_{name}")).awaitTermination()
    assert jobs.read_results(spark, str(tmp_path / "good"), S.HOURLY_YIELD.schema).count() == 1
    assert rows(jobs.read_results(spark, str(tmp_path / "rejects"), rejects.schema)) == [("{bad", "malformed")]


def weather_message(clock, ambient, module):
    return (
        f'{{"DATE_TIME":"2020-05-15 {clock}:00","AMBIENT_TEMPERATURE":{ambient},"MODULE_TEMPERATURE":{module},'
        f'"IRRADIATION":0.5,"PLANT_ID":1,"SOURCE_KEY":"sensor-a"}}'
    )


def test_fan_out_to_the_four_tables(spark, tmp_path):
    generator_files = ScriptedStream(spark, tmp_path / "generator").script("00:00 1  00:15 2\n23:45 3\n23:50 3")
    generator_files.add(message("12:00", 5), message("23:59", 1))
    weather_files = ScriptedStream(spark, tmp_path / "weather")
    weather_files.add(weather_message("00:00", 20, 25))
    root, checkpoints = str(tmp_path / "tables"), str(tmp_path / "checkpoints")
    queries = jobs.start_all(generator_files.stream(), weather_files.stream(), root, checkpoints, available_now=True)
    assert set(queries) == set(S.TABLES)
    for query in queries.values():
        query.awaitTermination()
    count = {name: tables.read_table(spark, spec, f"{root}/{name}").count() for name, spec in S.TABLES.items()}
    # The late 12:00 reading is passed on; its hour had closed. The day is still open.
    assert count == {"generator_metrics": 6, "weather_metrics": 1, "hourly_yield": 1, "daily_yield": 0}


def test_print_both_raw_streams(spark, tmp_path, capfd):
    generator_files = ScriptedStream(spark, tmp_path / "generator")
    generator_files.add(*(message("00:00", i) for i in range(50)))
    weather_files = ScriptedStream(spark, tmp_path / "weather")
    weather_files.add(weather_message("00:00", 20, 25))
    streams = raw_generator_rows(generator_files.stream()), raw_weather_rows(weather_files.stream())
    printed = jobs.print_raw(*streams, str(tmp_path / "out"), str(tmp_path / "checkpoints"), available_now=True)
    for query, n in zip(printed, (50, 1)):
        query.awaitTermination()
        assert progress_report(query)["input_rows"] == n
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out" / "generator")).collect()]
    assert sorted(line["DC_POWER"] for line in lines) == [float(i) for i in range(50)]
    jobs.start_preview(streams[1], str(tmp_path / "preview"), available_now=True).awaitTermination()


def test_progress_counts_more_than_spark_holds(spark, scripted, tmp_path):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        scripted.script("00:00 1\n01:00 2\n03:00 4\n05:00 16\n00:10 8\n06:00 32")
        query = run_hourly(scripted, tmp_path)
        assert len(query.recentProgress) <= 2
        report = progress_report(query)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert report["input_rows"] == 6 and report["late_rows"] == 1 and report["batches"] >= 6


def test_start_all_keeps_rejects_and_keys(spark, tmp_path):
    generator_files = ScriptedStream(spark, tmp_path / "generator")
    generator_files.add(message("00:00", 1), "{bad", '{"DC_POWER":1}')
    generator_files.add(message("00:00", 1), message("00:00", 2))
    weather_files = ScriptedStream(spark, tmp_path / "weather")
    weather_files.add(weather_message("00:00", 20, 25))
    root, taken = str(tmp_path / "tables"), []
    for attempt in range(2):  # a new checkpoint reads everything again
        queries = jobs.start_all(
            generator_files.stream(), weather_files.stream(), root, str(tmp_path / f"c{attempt}"), available_now=True,
            mode="PERMISSIVE", targets={"hourly_yield": lambda batch: taken.append(batch.count()),
                                        "daily_yield": lambda batch: taken.append(batch.count())},
        )
        for query in queries.values():
            query.awaitTermination()
        assert tables.read_table(spark, S.GENERATOR_METRICS, f"{root}/generator_metrics").count() == 1
        if attempt == 0:
            rejects = spark.read.parquet(f"{root}/generator_rejects").collect()
            assert sorted(r.reject_reason for r in rejects) == ["malformed", "no event time"]
            assert spark.read.parquet(f"{root}/weather_rejects").count() == 0
    assert taken and not (tmp_path / "tables" / "hourly_yield").exists()


def test_strict_streams_stop_on_a_message_without_a_time(spark, scripted, tmp_path):
    scripted.add('{"DC_POWER":1}')
    with pytest.raises(Exception, match="without an event time"):
        run_hourly(scripted, tmp_path)


def test_keyed_stream_survives_a_replay_from_the_start(spark, scripted, tmp_path):
    """A new checkpoint reads every message again; the keyed table stays as it is."""
    scripted.script(L1)
    spec, path = S.GENERATOR_METRICS, str(tmp_path / "table")
    tables.create_table(spark, spec, path)
    for attempt in range(2):
        stream = project.generator_metrics(generator_stream(scripted.stream()))
        jobs.start_keyed(
            stream,
            lambda batch: tables.append_new_rows(batch, spec, path),
            str(tmp_path / f"checkpoint{attempt}"),
            available_now=True,
        ).awaitTermination()
        stored = tables.read_table(spark, spec, path)
        assert stored.count() == 7
        assert keys.duplicate_keys(stored, spec.key).count() == 0


@pytest.mark.parametrize("written", ["nothing", "half", "all"])
def test_a_crash_between_append_and_commit(spark, scripted, tmp_path, written):
    """The job stops in a batch, with nothing, half or all of it in the table, and starts again: each reading once."""
    scripted.script(L1)
    spec, path, checkpoint = S.GENERATOR_METRICS, str(tmp_path / "table"), str(tmp_path / "checkpoint")
    tables.create_table(spark, spec, path)
    appended, looked_up = [], []

    def crashes(batch):
        appended.append(batch.count())
        if len(appended) == 3:
            part = {"nothing": batch.limit(0), "half": batch.orderBy("date_time").limit(1), "all": batch}[written]
            tables.append_new_rows(part, spec, path)
            raise RuntimeError("stopped")
        tables.append_new_rows(batch, spec, path)

    def whole(batch):
        looked_up.append(batch.count())
        tables.append_new_rows(batch, spec, path)

    stream = project.generator_metrics(generator_stream(scripted.stream()))
    with pytest.raises(Exception, match="stopped"):
        jobs.start_keyed(stream, crashes, checkpoint, available_now=True).awaitTermination()
    jobs.start_keyed(stream, whole, checkpoint, available_now=True).awaitTermination()
    assert looked_up == [2, 2]  # the batch that broke off, and the last
    stored = rows(tables.read_table(spark, spec, path).select("date_time", "dc_power"))
    assert len(stored) == 7 == len({when for when, _ in stored})


def test_a_batch_in_the_ledger_is_left_out(spark, scripted, tmp_path):
    """Appended whole, but stopped before Spark's commit: its number tells, without a look at the keys."""
    scripted.script(L1)
    checkpoint, seen = tmp_path / "checkpoint", []
    stream = project.generator_metrics(generator_stream(scripted.stream()))
    jobs.start_keyed(stream, lambda batch: seen.append(batch.count()), str(checkpoint), available_now=True).awaitTermination()
    assert seen == [2, 2, 2, 2]
    for commit in (checkpoint / "commits").glob("*3*"):
        commit.unlink()
    jobs.start_keyed(stream, lambda batch: seen.append(batch.count()), str(checkpoint), available_now=True).awaitTermination()
    assert seen == [2, 2, 2, 2]


def test_streaming_join_of_hours(spark, tmp_path):
    generator_files = ScriptedStream(spark, tmp_path / "g").script("00:00 1  00:30 3\n01:00 5\n02:00 7\n09:00 9\n10:00 1")
    weather_files = ScriptedStream(spark, tmp_path / "w")
    for clock, ambient, module in (("00:10", 20, 25), ("00:50", 20, 27), ("02:00", 10, 11), ("09:00", 1, 1), ("10:00", 1, 1)):
        weather_files.add(weather_message(clock, ambient, module))
    joined = metrics.generator_weather_join(
        generator_stream(generator_files.stream()), weather_stream(weather_files.stream())
    )
    jobs.start_files(joined, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    got = jobs.read_results(spark, str(tmp_path / "out"), joined.schema).collect()
    assert sorted((r.hour_start.hour, r.avg_dc_power, r.temperature_delta) for r in got) == [
        (0, 2.0, 6.0),
        (1, 5.0, None),
        (2, 7.0, 1.0),
    ]


def test_replay_in_event_time_order(spark, tmp_path):
    readings = generator(spark, _some_readings())
    source, path = str(tmp_path / "csv"), str(tmp_path / "in")
    readings.withColumn("DATE_TIME", F.date_format("DATE_TIME", "yyyy-MM-dd HH:mm:ss")).write.csv(source, header=True)
    stored = csv_readings(spark, source, S.generator_schema())
    first = list(replay(stored, path))
    assert [when for when, _ in first] == [at("00:00") + i * timedelta(minutes=15) for i in range(16)]
    assert all(spark.read.text(folder).count() == 4 for _, folder in first)
    mark = (tmp_path / "in" / "_SUCCESS").stat().st_mtime_ns
    assert list(replay(stored, path)) == first and (tmp_path / "in" / "_SUCCESS").stat().st_mtime_ns == mark

    stream = message_files(spark, f"{path}/*", stream=True)
    hourly = yields.hourly_yield(generator_stream(stream))
    query = jobs.start_files(hourly, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    query.awaitTermination()
    assert progress_report(query)["late_rows"] == 0
    closed = yields.hourly_yield(readings).filter("window_end <= timestamp_ntz'2020-05-15 03:15:00'")
    assert rows(jobs.read_results(spark, str(tmp_path / "out"), hourly.schema)) == rows(closed)


def test_replay_scans_its_source_once(spark, tmp_path):
    """One job that reads the source, whatever the number of slots."""
    readings = generator(spark, _some_readings())
    source = str(tmp_path / "csv")
    readings.withColumn("DATE_TIME", F.date_format("DATE_TIME", "yyyy-MM-dd HH:mm:ss")).write.csv(source, header=True)
    seen = spark.sparkContext.accumulator(0)
    stored = csv_readings(spark, source, S.generator_schema())
    counted = stored.mapInPandas(lambda frames: ((seen.add(len(f)), f)[1] for f in frames), stored.schema)
    assert len(list(replay(counted, str(tmp_path / "in")))) == 16
    assert seen.value == stored.count()


def _some_readings():
    return [
        generator_row(f"{m // 60:02d}:{m % 60:02d}", m + i, plant=i % 2, source=f"inv-{i}")
        for m in range(0, 240, 15)
        for i in range(4)
    ]


def test_dashboard_of_streams_is_the_batch_dashboard(spark, tmp_path):
    gen = ScriptedStream(spark, tmp_path / "g").script("00:00 1 00:30 3\n01:00 0\n02:00 7\n09:00 9\n10:00 1")
    sky = ScriptedStream(spark, tmp_path / "w")
    for clock, ambient, module in (("00:10", 20, 25), ("02:00", 10, 11), ("09:00", 1, 1), ("10:00", 1, 1)):
        sky.add(weather_message(clock, ambient, module))
    capacity = spark.sql("SELECT * FROM VALUES (1, 4) AS t(plant_id, capacity_kw)")
    board = metrics.dashboard(generator_stream(gen.stream()), weather_stream(sky.stream()), capacity)
    jobs.start_files(board, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()

    def batch(script, schema):
        return decode_json(message_files(spark, str(script.folder)), schema)

    expected = metrics.dashboard(batch(gen, S.generator_schema()), batch(sky, S.weather_schema()), capacity)
    closed = expected.filter("hour_start < timestamp_ntz'2020-05-15 09:00:00'")
    assert rows(jobs.read_results(spark, str(tmp_path / "out"), board.schema)) == rows(closed)
    assert closed.count() == 3
