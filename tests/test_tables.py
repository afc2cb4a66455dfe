import json
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import at, generator, generator_row, plan, rows, weather, weather_row
from sunledger import schemas as S
from sunledger.operators import keys, project, slots, yields
from sunledger.sinks import jdbc, tables, topics

DAYS = [f"2020-05-{d:02d}" for d in range(10, 20)]


@pytest.fixture
def readings(spark):
    return generator(
        spark,
        [generator_row(clock, i, source=f"inv-{i}", day=day) for day in DAYS for clock in ("00:00", "23:45") for i in range(3)],
    )


def test_slice_reads_its_days_only(spark, readings, tmp_path):
    path = str(tmp_path / "daily_yield")
    daily = yields.daily_yield(readings)
    tables.write_table(daily, S.DAILY_YIELD, path)
    assert sorted(p.name for p in (tmp_path / "daily_yield").glob("event_date=*")) == [f"event_date={d}" for d in DAYS]
    part = tables.read_slice(spark, S.DAILY_YIELD, path, datetime(2020, 5, 12), datetime(2020, 5, 14))
    assert rows(part) == rows(daily.filter("date_time >= '2020-05-12' and date_time < '2020-05-14'"))
    assert part.count() == 6
    text = plan(part)
    partition_filters = next(line for line in text.splitlines() if line.startswith("PartitionFilters"))
    pushed = next(line for line in text.splitlines() if line.startswith("PushedFilters"))
    assert "event_date" in partition_filters and "2020-05-13" in partition_filters
    assert "GreaterThanOrEqual(date_time" in pushed and "LessThan(date_time" in pushed


def test_the_drivers_own_zone_does_not_matter(spark, readings, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.write_table(project.generator_metrics(readings), S.GENERATOR_METRICS, path)
    monkeypatch.setenv("TZ", "America/Los_Angeles")
    time.tzset()
    try:
        part = tables.read_slice(spark, S.GENERATOR_METRICS, path, at("00:00"), at("23:45"))
        assert part.count() == 3
        assert slots.slot_lookup(readings, at("23:45")).count() == 3
        assert slots.first_slot(readings) == datetime(2020, 5, 10)
        tables.append_new_rows(project.generator_metrics(readings), S.GENERATOR_METRICS, path)
        assert tables.read_table(spark, S.GENERATOR_METRICS, path).count() == 60
    finally:
        monkeypatch.undo()
        time.tzset()


def test_a_slice_within_a_day(spark, readings, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(project.generator_metrics(readings), S.GENERATOR_METRICS, path)
    part = tables.read_slice(spark, S.GENERATOR_METRICS, path, at("00:00"), at("23:45"))
    assert part.count() == 3


def test_a_day_is_written_to_few_files(spark, readings, tmp_path):
    metrics = project.generator_metrics(readings.repartition(8))
    tables.write_table(metrics, S.GENERATOR_METRICS, str(tmp_path / "t"))
    assert max(len(list(day.glob("*.parquet"))) for day in (tmp_path / "t").glob("event_date=*")) == 1


def test_a_day_with_all_rows_is_split(spark, tmp_path):
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    spark.conf.set(advisory, "200KB")
    try:
        hot = spark.range(200_000).select(
            F.lit(1).alias("plant_id"),
            F.lit("inv-a").alias("source_key"),
            F.lit("2020-05-15 10:00:00").cast("timestamp_ntz").alias("date_time"),
            *(F.rand(i).alias(c) for i, c in enumerate(("dc_power", "ac_power", "yield"))),
        )
        tables.write_table(hot, S.GENERATOR_METRICS, str(tmp_path / "t"))
    finally:
        spark.conf.set(advisory, before)
    assert len(list((tmp_path / "t" / "event_date=2020-05-15").glob("*.parquet"))) > 4
    assert tables.read_table(spark, S.GENERATOR_METRICS, str(tmp_path / "t")).count() == 200_000


def test_load_history(spark, readings, tmp_path):
    sky = weather(spark, [weather_row("10:00", 20, 25, 1)])
    for _ in range(2):
        tables.load_history(readings, sky, str(tmp_path))
    count = {name: tables.read_table(spark, spec, f"{tmp_path}/{name}").count() for name, spec in S.TABLES.items()}
    assert count == {"daily_yield": 30, "hourly_yield": 60, "generator_metrics": 60, "weather_metrics": 1}


def test_create_and_reset(spark, readings, tmp_path):
    tables.create_tables(spark, str(tmp_path))
    for name, spec in S.TABLES.items():
        empty = tables.read_table(spark, spec, f"{tmp_path}/{name}")
        assert empty.count() == 0
        assert empty.schema.fieldNames() == [*spec.column_names, "event_date"]
    path = f"{tmp_path}/generator_metrics"
    tables.write_table(project.generator_metrics(readings), S.GENERATOR_METRICS, path)
    assert tables.read_table(spark, S.GENERATOR_METRICS, path).count() == 60
    tables.create_table(spark, S.GENERATOR_METRICS, path)
    assert tables.read_table(spark, S.GENERATOR_METRICS, path).count() == 0


def test_keyed_append(spark, tmp_path):
    spec, path = S.GENERATOR_METRICS, str(tmp_path / "t")
    tables.create_table(spark, spec, path)
    known, again, fresh = generator_row("00:00", 1), generator_row("00:00", 2), generator_row("00:15", 3)
    for batch in ([known], [again, known, fresh, fresh], []):
        tables.append_new_rows(project.generator_metrics(generator(spark, batch)), spec, path)
    stored = tables.read_table(spark, spec, path).select("date_time", "dc_power")
    assert rows(stored) == [(at("00:00"), 1.0), (at("00:15"), 3.0)]


def test_keyed_append_reads_the_days_of_the_batch(spark, readings, tmp_path, monkeypatch):
    spec, path = S.GENERATOR_METRICS, str(tmp_path / "t")
    tables.write_table(project.generator_metrics(readings), spec, path)
    batch = project.generator_metrics(generator(spark, [generator_row("08:00", 1)]))
    opened = []
    read = tables.read_ranges
    monkeypatch.setattr(tables, "read_ranges", lambda *args: opened.append(args[-1]) or read(*args))
    far = [generator_row("08:00", 1), generator_row("08:00", 1, day="1970-01-01")]
    batch = project.generator_metrics(generator(spark, far))
    hours = tables.touched_ranges(batch, spec)
    assert hours == [(at(a, day), at(b, day)) for a, b, day in (("08:00", "09:00", "1970-01-01"), ("08:00", "09:00", "2020-05-15"))]
    tables.append_new_rows(batch, spec, path)
    assert opened == [hours]
    text = plan(keys.new_rows(batch, read(spark, spec, path, hours), spec))
    partition_filters = next(line for line in text.splitlines() if line.startswith("PartitionFilters"))
    assert "1970-01-01" in partition_filters and "2020-05-15" in partition_filters and " OR " in partition_filters
    assert "SortAggregate" not in text


def opened_rows(frame) -> int:
    """Rows that the scans of a plan without exchanges gave, after a run."""
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_batch_of_one_hour_opens_the_row_groups_of_that_hour(spark, tmp_path):
    spec, path = S.GENERATOR_METRICS, str(tmp_path / "t")
    full = spark.range(240_000).select(
        F.lit(1).alias("plant_id"),
        F.concat(F.lit("inv-"), (F.col("id") % 10).cast("string")).alias("source_key"),
        F.expr("timestamp_ntz'2020-05-15' + make_interval(0, 0, 0, 0, 0, 0, pmod(id * 7919, 86400))").alias("date_time"),
        *(F.rand(i).alias(c) for i, c in enumerate(("dc_power", "ac_power", "yield"))),
    )
    tables.write_table(full, spec, path, row_group_bytes=1 << 18)
    batch = project.generator_metrics(generator(spark, [generator_row("08:10", 1), generator_row("08:50", 1)]))
    ranges = tables.touched_ranges(batch, spec)
    assert ranges == [(at("08:00"), at("09:00"))]
    stored = tables.read_ranges(spark, spec, path, ranges)
    assert len(stored.collect()) == 10_000
    assert 10_000 <= opened_rows(stored) < 40_000
    tables.append_new_rows(batch, spec, path)
    assert tables.read_table(spark, spec, path).count() in (240_001, 240_002)


def test_ranges_join_but_never_shrink():
    hour = timedelta(hours=1)
    starts = [at("00:00") + i * hour for i in (0, 1, 2, 5, 9, 10, 30)]
    ranges = [(s, s + hour) for s in starts]
    for most in range(1, 8):
        joined = tables.joined_ranges(ranges, most)
        assert len(joined) <= most and all(any(a <= s and s + hour <= b for a, b in joined) for s in starts)
    assert tables.joined_ranges(ranges) == [(starts[0], starts[2] + hour), *[(s, s + hour) for s in starts[3:4]],
                                            (starts[4], starts[5] + hour), (starts[6], starts[6] + hour)]
    assert tables.joined_ranges([]) == []


def test_a_load_reads_and_parses_its_input_once(spark, readings, tmp_path):
    messages, seen = project.messages(readings).select("value"), spark.sparkContext.accumulator(0)
    counted = messages.mapInPandas(lambda frames: ((seen.add(len(f)), f)[1] for f in frames), messages.schema)
    tables.load_messages(counted, project.messages(weather(spark, [weather_row("10:00", 20, 25, 1)])), str(tmp_path))
    assert seen.value == messages.count()
    parts = tables.read_table(spark, S.HOURLY_PARTS, f"{tmp_path}/hourly_parts")
    assert parts.agg(F.sum("n_rows")).first()[0] == messages.count()
    with pytest.raises(ValueError, match="without date_time"):
        lost = generator(spark, [generator_row("00:00", 1), (None, *generator_row("00:00", 1)[1:])])
        tables.load_history(lost, weather(spark, []), str(tmp_path / "lost"))


def test_rows_without_a_time_are_refused(spark, tmp_path):
    spec, path = S.GENERATOR_METRICS, str(tmp_path / "t")
    tables.create_table(spark, spec, path)
    batch = project.generator_metrics(generator(spark, [generator_row("00:00", 1), (None, *generator_row("00:00", 1)[1:])]))
    with pytest.raises(ValueError, match="without date_time"):
        tables.append_new_rows(batch, spec, path)
    with pytest.raises(Exception, match="without date_time"):
        tables.timed(batch, spec).collect()


def test_insert_goes_by_place(spark, tmp_path):
    spec, path = S.DAILY_YIELD, str(tmp_path / "t")
    select = spark.sql("SELECT 7L AS rolling_sum, 'inv-a' AS plant_id, timestamp_ntz'2020-05-15' AS source_key, 1.5D AS date_time")
    tables.insert_into(select, spec, path)
    assert rows(tables.read_table(spark, spec, path).select(*spec.column_names)) == [(7, "inv-a", at("00:00"), 1.5)]


def test_slice_of_windows(spark, readings, tmp_path):
    spec, path = S.GENERATOR_METRICS, str(tmp_path / "t")
    tables.write_table(project.generator_metrics(readings), spec, path)
    start, end = at("05:30", "2020-05-11"), at("03:00", "2020-05-13")
    stored = tables.read_windows(spark, spec, path, start, end, timedelta(hours=1))
    expected = yields.hourly_yield(readings).filter(f"window_start >= timestamp_ntz'{start}' and window_start < timestamp_ntz'{end}'")
    assert rows(yields.hourly_yield(project.generator_readings(stored))) == rows(expected)
    text = plan(stored)
    assert "event_date" in text.split("PartitionFilters: ")[1].splitlines()[0] and "GreaterThanOrEqual(date_time" in text


def test_messages_that_are_no_reading_are_kept_apart(spark, readings, tmp_path):
    good = project.messages(readings).select("value")
    bad = spark.createDataFrame([("{bad",), ('{"DC_POWER":1}',), (None,)], "value string")
    sky = project.messages(weather(spark, [weather_row("10:00", 20, 25, 1)]))
    tables.load_messages(good.union(bad).union(good), sky, str(tmp_path))
    assert tables.read_table(spark, S.GENERATOR_METRICS, f"{tmp_path}/generator_metrics").count() == 60
    rejects = spark.read.parquet(f"{tmp_path}/generator_rejects")
    assert sorted(r.reject_reason for r in rejects.collect()) == ["malformed", "no event time", "no value"]
    assert spark.read.parquet(f"{tmp_path}/weather_rejects").count() == 0


def test_a_key_without_a_source_is_kept_once_too(spark, tmp_path):
    spec, path = S.GENERATOR_METRICS, str(tmp_path / "t")
    tables.create_table(spark, spec, path)
    batch = project.generator_metrics(generator(spark, [generator_row("00:00", 1, source=None)] * 2))
    for _ in range(2):
        tables.append_new_rows(batch, spec, path)
    assert tables.read_table(spark, spec, path).count() == 1


def test_first_per_key_does_not_depend_on_order(spark):
    batch = [generator_row("00:00", v, ac=-v) for v in range(50)] + [generator_row("00:15", 1)]
    expected = [(1, "inv-a", at("00:00"), 0.0, 0.0, 0.0), (1, "inv-a", at("00:15"), 1.0, 1.0, 1.0)]
    for partitions in (1, 5):
        metrics = project.generator_metrics(generator(spark, batch).repartition(partitions))
        got = [tuple(v + 0.0 if isinstance(v, float) else v for v in r) for r in rows(keys.first_per_key(metrics, S.GENERATOR_METRICS))]
        assert got == expected


# --- the relational store: no driver or database here, so the calls are checked and the store is stood in for ---


def test_jdbc_options():
    options = jdbc.jdbc_options("jdbc:postgresql://db:5432/solar_data", "daily_yield", "u", "p", numPartitions="16")
    assert options == {
        "url": "jdbc:postgresql://db:5432/solar_data",
        "dbtable": '"solar"."daily_yield"',
        "user": "u",
        "password": "p",
        "driver": "org.postgresql.Driver",
        "numPartitions": "16",
    }


def test_jdbc_replay_adds_nothing(spark, tmp_path, monkeypatch):
    spec, path = S.GENERATOR_METRICS, str(tmp_path / "t")
    tables.create_table(spark, spec, path)

    def keys_between(session, wanted, options, ranges):
        return tables.read_ranges(session, wanted, path, ranges)

    monkeypatch.setattr(jdbc, "stored_keys", keys_between)
    monkeypatch.setattr(jdbc, "append_rows", lambda df, wanted, options: tables.write_table(df, wanted, path))
    known, fresh = generator_row("00:00", 1), generator_row("00:15", 3)
    for batch in ([known], [known, fresh, fresh], []):
        jdbc.append_new_rows(project.generator_metrics(generator(spark, batch)), spec, {})
    assert tables.read_table(spark, spec, path).count() == 2


class Calls:
    """Records a chain of writer calls."""

    def __init__(self):
        self.seen = {}

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.seen[name] = args or kwargs
            return self

        return call


def test_jdbc_writer_calls(spark, readings, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    calls = Calls()
    monkeypatch.setattr(DataFrame, "write", property(lambda self: calls))
    options = jdbc.jdbc_options("jdbc:x", "daily_yield", "u", "p")
    jdbc.append_rows(yields.daily_yield(readings), S.DAILY_YIELD, options)
    assert calls.seen == {"format": ("jdbc",), "options": options, "mode": ("append",), "save": {}}
    calls.seen = {}
    jdbc.reset_table(spark, S.DAILY_YIELD, options)
    assert calls.seen["option"] == ("truncate", True) and calls.seen["mode"] == ("overwrite",)


def test_publish_calls(spark, readings, tmp_path, monkeypatch):
    """One write a slice, in order of time; a publish that broke off goes on with the slice it was at."""
    from pyspark.sql.classic.dataframe import DataFrame

    staging, width = str(tmp_path / "staged"), "6 hours"
    topics.stage_slices(readings, staging, width, keyed=True)
    calls, sent = Calls(), []

    def write(frame):
        if len(sent) == 2:
            raise OSError("the broker is gone")
        rows_of = frame.collect()
        sent.append(sorted(json.loads(r.value)["DATE_TIME"] for r in rows_of))
        assert frame.columns == ["key", "value"] and all(json.loads(r.key)["plant_id"] is not None for r in rows_of)
        return calls

    monkeypatch.setattr(DataFrame, "write", property(write))
    with pytest.raises(OSError):
        topics.publish(readings, "kafka:29092", S.GENERATOR_TOPIC, staging, width)
    first, sent = sent, []
    monkeypatch.setattr(DataFrame, "write", property(lambda frame: write(frame) if len(sent) < 2 else sent.append(
        sorted(json.loads(r.value)["DATE_TIME"] for r in frame.collect())) or calls))
    topics.publish(readings, "kafka:29092", S.GENERATOR_TOPIC, staging, width)
    assert calls.seen["options"] == {"kafka.bootstrap.servers": "kafka:29092", "topic": "generator-topic"}
    slices = first + sent
    assert all(a[-1] < b[0] for a, b in zip(slices, slices[1:]))
    assert sum(map(len, slices)) == readings.count()


def test_dry_run_writes_every_message(spark, readings, tmp_path, capsys):
    topics.dry_run(readings, str(tmp_path / "dry"))
    lines = [r.value.split("\t") for r in spark.read.text(str(tmp_path / "dry")).collect()]
    assert sorted(lines) == sorted([r.key, r.value] for r in project.messages(readings).collect())
    topics.preview(readings, rows=1)
    printed = capsys.readouterr().out
    assert '{"plant_id":1,"source_key":"inv-0"}' in printed and '"DATE_TIME":"2020-05-10 00:00:00"' in printed


def test_kafka_options():
    from sunledger.sources import kafka_options

    assert kafka_options("kafka:29092", "weather-topic") == {
        "kafka.bootstrap.servers": "kafka:29092",
        "subscribe": "weather-topic",
        "startingOffsets": "earliest",
    }
    more = kafka_options("k", "t", group_id="g", min_partitions=64, max_offsets_per_trigger=10**6)
    assert (more["kafka.group.id"], more["minPartitions"], more["maxOffsetsPerTrigger"]) == ("g", "64", "1000000")
