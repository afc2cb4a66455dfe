"""Every registered query against its SQL twin, exact values, and the row counts known for each scale."""

import pytest

import __spark_entry__ as entry
from conftest import TESTDATA
from oracle_check import differences, duck
from sunledger.plans.oracle import ORACLE
from sunledger.plans.queries import QUERIES

# Rows at sf0.001 and sf0.01.
COUNTS = {
    "generator_metrics": (1000, 10000),
    "weather_metrics": (188, 1982),
    "daily_yield": (396, 450),
    "hourly_yield": (960, 6499),
    "hourly_yield_stream": (958, 6491),
    "daily_yield_stream": (381, 435),
    "hourly_production_density": (795, 2133),
    "hourly_avg_irradiation": (181, 1259),
    "avg_dc_power": (795, 2133),
    "avg_ac_power": (795, 2133),
    "temperature_delta": (181, 1259),
    "conversion_efficiency": (795, 2133),
    "daily_production": (90, 90),
    "generator_weather_join": (795, 2133),
    "alerts": (402, 1029),
    "pk_duplicates": (0, 2),
    "slot_gaps": (7665, 2724),
    "slot_bounds": (3, 3),
    "rows_per_slot": (999, 9980),
    "slot_lookup": (1, 1),
    "daily_slice": (43, 45),
    "stored_daily_slice": (43, 45),
    "json_roundtrip": (1000, 10000),
    "raw_rows": (1000, 10000),
    "json_messages": (1000, 10000),
    "csv_scan": (1000, 10000),
    "enriched_readings": (1000, 10000),
    "keyed_generator_metrics": (1000, 9998),
    "generator_metrics_stream": (1000, 10000),
    "weather_metrics_stream": (188, 1982),
    "weather_json_roundtrip": (188, 1982),
    "dry_run_messages": (1000, 10000),
    "loaded_generator_metrics": (1000, 9998),
    "streamed_generator_metrics": (1000, 9998),
    "hourly_yield_from_messages": (958, 6491),
    "restarted_hourly_yield": (958, 6491),
    "replayed_hourly_yield": (958, 6491),
    "fan_out": (4, 4),
    "message_rejects": (4, 4),
    "csv_rejects": (2, 2),
}
SCALES = ["0.001", "0.01"]


@pytest.fixture(scope="module")
def oracles():
    return {sf: duck(f"{TESTDATA}/sf{sf}") for sf in SCALES}


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("sf", SCALES)
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracles, name, sf):
    result = QUERIES[name](spark, f"{TESTDATA}/sf{sf}")
    assert differences(result, oracles[sf], ORACLE[name]) is None
    if name in COUNTS:
        assert result.count() == COUNTS[name][SCALES.index(sf)]


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["window_start", "window_end", "plant_id", "source_key", "total_yield"]
    assert result.count() == 960
