"""Versions of the four tables behind one pointer, and compaction of closed days."""

from datetime import date, timedelta

import pytest

from helpers import at, generator, generator_row, rows, weather, weather_row
from sunledger import schemas as S
from sunledger.operators import project, yields
from sunledger.sinks import tables, versions


def some(spark, value):
    return generator(spark, [generator_row(f"{h:02d}:00", value + h) for h in range(5)]), weather(spark, [weather_row("01:00", 20, 25, 1)])


def counts(spark, root):
    return {name: versions.read_current(spark, spec, root).count() for name, spec in S.TABLES.items()}


def test_a_reload_is_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    assert versions.current_version(spark, root) is None
    with pytest.raises(ValueError, match="no current version"):
        versions.read_current(spark, S.HOURLY_YIELD, root)
    first = versions.reload_history(*some(spark, 1), root)
    before = rows(versions.read_current(spark, S.HOURLY_YIELD, root))
    held = versions.read_current(spark, S.DAILY_YIELD, root)

    write, written = tables.write_table, []

    def breaks(table, spec, *args, **kwargs):
        if len(written) == 3:
            raise OSError("half-way")
        written.append(spec.name)
        write(table, spec, *args, **kwargs)

    monkeypatch.setattr(tables, "write_table", breaks)
    with pytest.raises(OSError, match="half-way"):
        versions.reload_history(*some(spark, 50), root)
    monkeypatch.undo()
    assert written[0] == "hourly_parts" and versions.current_version(spark, root) == first
    assert rows(versions.read_current(spark, S.HOURLY_YIELD, root)) == before
    assert counts(spark, root) == {"daily_yield": 1, "hourly_yield": 5, "generator_metrics": 5, "weather_metrics": 1}

    second = versions.reload_history(*some(spark, 100), root)
    assert versions.current_version(spark, root) == second != first
    assert rows(versions.read_current(spark, S.HOURLY_YIELD, root)) == rows(
        versions.read_current(spark, S.HOURLY_YIELD, root).select("*")
    ) != before
    # A reader of the old version still has its files; then what no one names goes, the half-written one included.
    assert held.first().rolling_sum == sum(1 + h for h in range(5))
    assert len(versions.drop_unnamed(spark, root, keep=[first])) == 1
    assert versions.drop_unnamed(spark, root) == [first] and versions.current_version(spark, root) == second
    versions.reset_all(spark, root)
    assert set(counts(spark, root).values()) == {0}


def test_only_complete_versions_are_named(spark, tmp_path):
    with pytest.raises(ValueError, match="lacks"):
        versions.replace_all(spark, str(tmp_path), lambda path: tables.create_table(spark, S.DAILY_YIELD, f"{path}/daily_yield"))
    with pytest.raises(ValueError, match="has no"):
        versions.switch(spark, str(tmp_path), f"{tmp_path}/version=none")
    assert versions.current_version(spark, str(tmp_path)) is None


def test_closed_days_get_files_of_a_useful_size(spark, tmp_path):
    root, spec = str(tmp_path), S.GENERATOR_METRICS
    days = ["2020-05-14", "2020-05-15"]

    def small_files(path):
        tables.create_tables(spark, path)
        for day in days:
            for hour in range(8):
                row = project.generator_metrics(generator(spark, [generator_row(f"{hour:02d}:{m:02d}", m, day=day) for m in (0, 30)]))
                tables.append_new_rows(row, spec, f"{path}/{spec.name}")

    first = versions.replace_all(spark, root, small_files)
    before = rows(versions.read_current(spark, spec, root))
    assert {day: n for day, (n, _) in versions.days_with_files(spark, f"{first}/{spec.name}").items()} == {date(2020, 5, 14): 8, date(2020, 5, 15): 8}
    held = versions.read_current(spark, spec, root)
    second = versions.compact(spark, root, date(2020, 5, 15))
    files = versions.days_with_files(spark, f"{second}/{spec.name}")
    assert files[date(2020, 5, 14)][0] == 1 and files[date(2020, 5, 15)][0] >= 1
    assert rows(versions.read_current(spark, spec, root)) == rows(held) == before and len(before) == 32
    times = [r.date_time for r in spark.read.parquet(f"{second}/{spec.name}/event_date=2020-05-14").collect()]
    assert times == sorted(times)
    # Appends go on in the new version.
    more = project.generator_metrics(generator(spark, [generator_row("09:00", 1), generator_row("00:00", 1)]))
    tables.append_new_rows(more, spec, f"{second}/{spec.name}")
    assert versions.read_current(spark, spec, root).count() == 33


def test_stored_parts_give_the_bits_of_the_readings(spark, tmp_path):
    values = [0.1, 1e15, -1e15, 0.2, 3e-9, -7.7, None, 1e8 / 3]
    readings = generator(spark, [generator_row(f"{h:02d}:{m:02d}", values[(h + m) % 8], plant=h % 2, source=f"inv-{m % 3}") for h in range(24) for m in (0, 7, 20, 41)])
    path = str(tmp_path / "parts")
    tables.write_table(yields.hourly_parts(readings.repartition(5)), S.HOURLY_PARTS, path)
    parts = tables.read_table(spark, S.HOURLY_PARTS, path)
    assert rows(yields.hourly_from_parts(parts)) == rows(yields.hourly_yield(readings))
    assert rows(yields.daily_from_parts(parts)) == rows(yields.daily_yield(readings))
    six = rows(yields.production_from_parts(parts, "6 hours", "start"))
    assert len(six) == 8 and {r[0] for r in six} == {at("00:00") + timedelta(hours=h) for h in (0, 6, 12, 18)}
