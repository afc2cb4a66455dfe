"""What the plans must look like to hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import TESTDATA
from helpers import generator, generator_row, plan, weather, weather_row
from sunledger import schemas as S
from sunledger.operators import enrich, keys, metrics, project
from sunledger.plans import queries as Q

SF = f"{TESTDATA}/sf0.001"
BATCH = sorted(n for n in Q.QUERIES if not n.endswith("_stream"))


def exchanges(text: str) -> int:
    return len(re.findall(r"^[ :*()\d+-]*Exchange \(\d+\)", text, re.M))


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    for forbidden in ("EvalPython", "PythonUDF", "MapInPandas", "CartesianProduct", "BroadcastNestedLoop"):
        assert forbidden not in text


@pytest.mark.parametrize("name", ["hourly_yield", "daily_yield", "avg_dc_power", "daily_production", "rows_per_slot", "pk_duplicates", "slot_bounds"])
def test_one_exchange_after_a_partial_aggregate(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert exchanges(text) == 1
    assert "partial_" in text and "SortAggregate" not in text


def test_scan_reads_only_what_is_used(spark):
    def read(name):
        return re.findall(r"ReadSchema: (.*)", plan(entry.queries()[name](spark, SF)))

    assert read("slot_bounds") == ["struct<ts:timestamp_ntz,user_id:bigint>"]
    assert read("hourly_yield") == ["struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>"]
    assert read("avg_dc_power") == ["struct<ts:timestamp_ntz,user_id:bigint,value:double>"]
    assert read("slot_gaps") == ["struct<ts:timestamp_ntz,user_id:bigint>"]


def test_slice_bounds_reach_the_scan(spark):
    pushed = re.findall(r"PushedFilters: (.*)", plan(entry.queries()["daily_slice"](spark, SF)))
    assert "GreaterThanOrEqual(ts," in pushed[0] and "LessThan(ts," in pushed[0]


def test_capacity_is_broadcast_only_by_its_size(spark):
    small = plan(entry.queries()["hourly_production_density"](spark, SF))
    assert "BroadcastHashJoin" in small
    readings = Q.generator(spark, SF)
    many = spark.range(5_000_000).select(F.col("id").cast("int").alias("plant_id"), F.lit(1).alias("capacity_kw"))
    assert "Broadcast" not in plan(metrics.hourly_production_density(readings, many))


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_hourly_join_reuses_the_aggregates_exchanges(spark, no_broadcast):
    text = plan(entry.queries()["generator_weather_join"](spark, SF))
    assert "SortMergeJoin" in text
    assert exchanges(text) == 2


def test_a_hot_plant_and_time_is_split(spark, no_broadcast):
    """All readings at one plant and time: AQE splits the join partition."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        hot = spark.range(40_000).select(
            F.lit("2020-05-15 10:00:00").cast("timestamp_ntz").alias("DATE_TIME"),
            *(F.col("id").cast("double").alias(c) for c in ("DC_POWER", "AC_POWER", "DAILY_YIELD", "TOTAL_YIELD")),
            F.when(F.col("id") < 0, 2).otherwise(1).alias("PLANT_ID"),
            F.lit("inv-a").alias("SOURCE_KEY"),
        )
        joined = enrich.enrich_readings(hot, weather(spark, [weather_row("10:00", 20, 30, 1)]))
        assert joined.filter("ambient_temp = 20").count() == 40_000
        joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_broken_master_has_no_local_folder(spark, monkeypatch):
    from sunledger import session

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_hot_source_reaches_the_shuffle_as_one_row_per_task(spark):
    """Partial sums come before the exchange, so copies of one key do not travel."""
    text = plan(Q.yields.hourly_yield(generator(spark, [generator_row("10:00", 1)])))
    assert text.index("HashAggregate") < text.index("Exchange") < text.rindex("HashAggregate")


def test_a_filter_on_enriched_readings_reaches_both_scans(spark, tmp_path):
    sky, readings = tmp_path / "w", tmp_path / "g"
    Q.generator(spark, SF).write.parquet(str(readings))
    Q.weather(spark, SF).write.parquet(str(sky))
    joined = enrich.enrich_readings(spark.read.parquet(str(readings)), spark.read.parquet(str(sky)))
    day = joined.filter("date_time >= timestamp_ntz'2024-01-10' and date_time < timestamp_ntz'2024-01-11'")
    pushed = re.findall(r"PushedFilters: (.*)", plan(day))
    assert len(pushed) == 2
    for filters in pushed:
        assert "GreaterThanOrEqual(DATE_TIME," in filters and "LessThan(DATE_TIME," in filters


def test_keyed_append_sorts_only_repeated_keys(spark):
    readings = project.generator_metrics(Q.generator(spark, SF))
    text = plan(keys.new_rows(readings, readings.limit(0), S.GENERATOR_METRICS))
    assert "SortAggregate" not in text and "WindowGroupLimit" in text
