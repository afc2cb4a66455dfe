"""As-of enrichment, energy from counters, alert episodes: small cases told by hand."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from helpers import at, generator, generator_row, plan, rows, weather, weather_row
from sunledger.operators import energy, enrich, episodes
from sunledger.streaming.jobs import start_files
from sunledger.streaming.sources import watermarked


def test_the_last_weather_within_the_tolerance(spark):
    sky = [weather_row("09:50", 1, 2, 0.1), weather_row("10:00", 3, 4, 0.2), weather_row("10:07", 5, 6, 0.3),
           weather_row("10:07", 7, 6, 0.3, source="sensor-b"), weather_row("10:00", 9, 9, 0.9, plant=2)]
    clocks = ["09:49", "09:50", "10:00", "10:06", "10:07", "10:22", "10:22:01", "10:40"]
    readings = [generator_row(c, i) for i, c in enumerate(clocks)] + [generator_row("10:05", 50, plant=2), generator_row("10:05", 60, plant=3)]
    got = enrich.asof_enriched(generator(spark, readings + readings[:1]), weather(spark, sky))
    found = {(r.plant_id, r.dc_power): (r.ambient_temp, r.irradiation) for r in got.collect()}
    assert got.count() == len(readings) + 1
    assert found == {(1, 0.0): (None, None), (1, 1.0): (1.0, 0.1), (1, 2.0): (3.0, 0.2), (1, 3.0): (3.0, 0.2), (1, 4.0): (6.0, 0.3),
                     (1, 5.0): (6.0, 0.3), (1, 6.0): (None, None), (1, 7.0): (None, None), (2, 50.0): (9.0, 0.9), (3, 60.0): (None, None)}


def test_no_task_has_a_plants_history(spark):
    text = plan(enrich.asof_enriched(generator(spark, [generator_row("10:00", 1)]), weather(spark, [weather_row("10:00", 1, 2, 0.1)])))
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "SortMergeJoin" not in text
    assert "hashpartitioning(PLANT_ID" in text and "bucket" in text.split("hashpartitioning(PLANT_ID")[1][:60]


def test_energy_is_how_far_the_counter_went(spark):
    clocks = {"00:10": 0.5, "00:50": 2.0, "01:20": 2.0, "01:40": 5.0, "02:10": 1.0, "02:30": 1.5, "03:00": None}
    readings = [generator_row(c, v) for c, v in clocks.items()]
    readings += [generator_row("00:50", 1.5), generator_row("00:50", 2.0), generator_row("00:10", 4, source="inv-b")]
    next_day = [generator_row("00:10", 0.25, day="2020-05-16")]
    got = {(r.window_start, r.source_key): r.energy for r in energy.hourly_energy(generator(spark, readings + next_day)).collect()}
    assert got == {(at("00:00"), "inv-a"): 2.0, (at("01:00"), "inv-a"): 3.0, (at("02:00"), "inv-a"): 1.5, (at("00:00"), "inv-b"): 4.0,
                   (at("00:00", "2020-05-16"), "inv-a"): 0.25}
    assert energy.hourly_energy(generator(spark, [])).count() == 0


HOURS = [90, 96, 97, 94, None, 96, 93, 98, 96, 94]


def test_an_episode_lasts_until_it_clears(spark):
    hours = [(at("00:00") + timedelta(hours=i), 1, None if v is None else float(v)) for i, v in enumerate(HOURS)]
    hours += [(at("05:00"), 2, 80.0), (at("07:00"), 2, 81.0), (at("08:00"), 3, 99.0)]
    frame = spark.createDataFrame(hours, "hour_start timestamp_ntz, plant_id int, pct double")
    got = rows(episodes.alert_episodes(frame, "pct", below=95, clear=97))
    assert got == [
        (1, at("00:00"), at("01:00"), 2, 90.0), (1, at("03:00"), at("03:00"), 1, 94.0), (1, at("06:00"), at("06:00"), 1, 93.0),
        (1, at("09:00"), at("09:00"), 1, 94.0), (2, at("05:00"), at("05:00"), 1, 80.0), (2, at("07:00"), at("07:00"), 1, 81.0),
    ]
    assert len(rows(episodes.alert_episodes(frame, "pct", below=95))) == 6
    with pytest.raises(ValueError, match="clears"):
        episodes.alert_episodes(frame, "pct", below=95, clear=90)
    assert episodes.alert_episodes(frame.filter(F.lit(False)), "pct", below=95).count() == 0


def test_in_a_stream_a_reading_meets_only_weather_near_it(spark, tmp_path):
    sky = [weather_row("09:50", 1, 2, 0.1), weather_row("10:00", 3, 4, 0.2), weather_row("10:07", 5, 6, 0.3),
           weather_row("10:07", 7, 6, 0.3, source="sensor-b"), weather_row("10:00", 9, 9, 0.9, plant=2), weather_row("12:00", 0, 0, 0)]
    clocks = ["09:49", "09:50", "10:00", "10:06", "10:07", "10:15", "10:22", "10:22:01", "10:40"]
    readings = [generator_row(c, i) for i, c in enumerate(clocks)] + [generator_row("10:05", 50, plant=2), generator_row("10:05", 60, plant=3)]
    readings, closing = readings + readings[2:3], generator_row("12:00", 99)

    def stream(frame, name):
        frame.withColumn("DATE_TIME", F.col("DATE_TIME").cast("timestamp")).write.parquet(f"{tmp_path}/{name}")
        read = spark.readStream.schema(spark.read.parquet(f"{tmp_path}/{name}").schema).parquet(f"{tmp_path}/{name}")
        return watermarked(read)

    joined = enrich.asof_enriched(stream(generator(spark, [*readings, closing]), "readings"), stream(weather(spark, sky), "sky"))
    join = next(part for part in plan(joined).split("\n\n") if "StreamingSymmetricHashJoin" in part and "Arguments" in part)
    assert "[PLANT_ID#" in join and "bucket#" in join.split("Arguments")[1].split("]")[0]
    start_files(joined, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    expected = enrich.asof_enriched(generator(spark, readings), weather(spark, sky))
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == rows(expected)


def test_in_a_stream_dense_weather_costs_no_more(spark, tmp_path):
    """A bucket's readings and its weather meet as one row each, however many there are, and over several micro-batches
    each reading is given once, when the watermark is the tolerance beyond it."""
    clocks = [f"{h:02}:{m:02}:{s:02}" for h in range(9, 13) for m in range(0, 60, 3) for s in (0, 30, 41)]
    readings = [generator_row(c, i % 7) for i, c in enumerate(clocks)]
    readings += readings[5:9] + [generator_row(c, 1, plant=2) for c in clocks[::9]]
    sky = [weather_row(c, i, i + 1, i / 100) for i, c in enumerate(clocks) if "11:0" not in c and "11:1" not in c]

    def stream(frame, name):
        frame = frame.withColumn("DATE_TIME", F.col("DATE_TIME").cast("timestamp")).cache()
        for hour in range(9, 13):
            frame.filter(F.hour("DATE_TIME") == hour).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
        return watermarked(spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{name}"))

    joined = enrich.asof_enriched(stream(generator(spark, readings), "readings"), stream(weather(spark, sky), "sky"))
    query = start_files(joined, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    query.awaitTermination()
    met = [o.numRowsUpdated for p in query.recentProgress for o in p.stateOperators if o.operatorName == "symmetricHashJoin"]
    assert len(met) > 4 and sum(met) <= 3 * 17
    due = enrich.asof_enriched(generator(spark, readings), weather(spark, sky)).filter(F.col("date_time") <= F.lit("2020-05-15 12:12:41").cast("timestamp_ntz"))
    got = rows(spark.read.parquet(f"{tmp_path}/out"))
    assert got == rows(due) and len(got) > 200
