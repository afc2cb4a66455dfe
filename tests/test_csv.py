from datetime import datetime

import pytest

from helpers import plan, rows
from sunledger import schemas as S
from sunledger.sources import csv_readings, csv_with_rejects

ISO = """DATE_TIME,PLANT_ID,SOURCE_KEY,AMBIENT_TEMPERATURE,MODULE_TEMPERATURE,IRRADIATION
2020-05-15 00:00:00,4135001,s,25.1,22.8,0
2020-05-15 00:15:00,4135001,s,,NaN,0.5
"""
DAY_FIRST = """DATE_TIME,PLANT_ID,SOURCE_KEY,AMBIENT_TEMPERATURE,MODULE_TEMPERATURE,IRRADIATION
15-05-2020 00:00,4136001,t,27,25,0
2020-05-15T00:15:00,4136001,t,27,25,0
"""
BAD = """DATE_TIME,PLANT_ID,SOURCE_KEY,AMBIENT_TEMPERATURE,MODULE_TEMPERATURE,IRRADIATION
2020-05-15 00:30:00,1,u,1,2,3
soon,1,u,1,2,3
,1,u,1,2,3
2020-05-15 00:45:00,1,u,warm,2,3
"""


def test_plants_with_two_time_notations(spark, tmp_path):
    for plant, text in ((4135001, ISO), (4136001, DAY_FIRST)):
        (tmp_path / S.WEATHER_CSV.format(plant_id=plant)).write_text(text)
    df = csv_readings(spark, str(tmp_path / S.WEATHER_CSV.format(plant_id="*")), S.weather_schema())
    assert df.schema.fieldNames() == S.weather_schema().fieldNames()
    assert rows(df) == sorted(
        [
            (datetime(2020, 5, 15), 25.1, 22.8, 0.0, 4135001, "s"),
            (datetime(2020, 5, 15, 0, 15), None, None, 0.5, 4135001, "s"),
            (datetime(2020, 5, 15), 27.0, 25.0, 0.0, 4136001, "t"),
            (datetime(2020, 5, 15, 0, 15), 27.0, 25.0, 0.0, 4136001, "t"),
        ],
        key=repr,
    )


@pytest.mark.parametrize("line", [2, 3, 4])
def test_a_bad_row_stops_the_job(spark, tmp_path, line):
    lines = BAD.splitlines()
    (tmp_path / "a.csv").write_text("\n".join([lines[0], lines[1], lines[line]]) + "\n")
    with pytest.raises(Exception, match="no time in a known form|MALFORMED|Malformed"):
        csv_readings(spark, str(tmp_path), S.weather_schema()).collect()


def test_bad_rows_are_kept_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text(BAD)
    (tmp_path / "b.csv").write_text(ISO)
    good, rejects = csv_with_rejects(spark, str(tmp_path), S.weather_schema())
    assert good.schema.fieldNames() == S.weather_schema().fieldNames()
    assert sorted(r.DATE_TIME.minute for r in good.collect()) == [0, 15, 30]
    assert rows(rejects) == sorted(
        [
            ("soon,1,u,1.0,2.0,3.0", "no time in a known form"),
            (",1,u,1.0,2.0,3.0", "no time in a known form"),
            ("2020-05-15 00:45:00,1,u,warm,2,3", "malformed"),
        ],
        key=repr,
    )


def test_a_file_with_another_header_stops_the_job(spark, tmp_path):
    (tmp_path / "a.csv").write_text(ISO)
    other = "PLANT_ID,DATE_TIME,SOURCE_KEY,AMBIENT_TEMPERATURE,MODULE_TEMPERATURE,IRRADIATION"
    (tmp_path / "b.csv").write_text(f"{other}\n1,2020-05-15 00:00:00,s,1,2,3\n")
    with pytest.raises(Exception, match="header|Header|HEADER"):
        csv_readings(spark, str(tmp_path), S.weather_schema()).collect()


def test_times_are_not_read_in_a_local_zone(spark, tmp_path):
    (tmp_path / "a.csv").write_text(ISO)
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        with pytest.raises(ValueError, match="UTC"):
            csv_readings(spark, str(tmp_path), S.weather_schema())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_only_the_columns_asked_for_are_parsed(spark, tmp_path):
    (tmp_path / "a.csv").write_text(ISO)
    df = csv_readings(spark, str(tmp_path), S.weather_schema()).select("PLANT_ID", "IRRADIATION")
    assert "ReadSchema: struct<PLANT_ID:int,IRRADIATION:double>" in plan(df)
