from datetime import datetime

import pytest
from pyspark.sql import types as T

from helpers import plan, rows
from sunledger import schemas as S
from sunledger.operators import project
from sunledger.sources import decode_json, decode_with_rejects, message_files
from sunledger.streaming.sources import raw_generator_rows, raw_weather_rows

SCHEMA = T.StructType([f for f in S.generator_schema() if f.name in ("DATE_TIME", "DC_POWER", "PLANT_ID", "SOURCE_KEY")])
MIDNIGHT = datetime(2020, 5, 15)
GOOD = '{"DATE_TIME":"2020-05-15 00:00:00","DC_POWER":1,"PLANT_ID":4135001,"SOURCE_KEY":"a"}'
MILLIS_NAN = '{"DATE_TIME":"2020-05-15 00:00:00.123","DC_POWER":NaN,"PLANT_ID":4135001,"SOURCE_KEY":"a"}'
ISO_TIME = '{"DATE_TIME":"2020-05-15T00:00:00","DC_POWER":1,"PLANT_ID":4135001,"SOURCE_KEY":"a"}'
NO_TIME_TEXT_ID = '{"DC_POWER":1,"PLANT_ID":"4135001","SOURCE_KEY":"a","MORE":1}'
NO_TIME = '{"DC_POWER":1,"PLANT_ID":4135001,"SOURCE_KEY":"a","MORE":1}'
BROKEN = "{bad"


def messages(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


@pytest.mark.parametrize("mode", ["FAILFAST", "PERMISSIVE"])
def test_good_messages(spark, mode):
    got = rows(decode_json(messages(spark, GOOD, MILLIS_NAN), SCHEMA, mode))
    assert got == [
        (MIDNIGHT, 1.0, 4135001, "a"),
        (MIDNIGHT.replace(microsecond=123000), None, 4135001, "a"),
    ]


@pytest.mark.parametrize("bad", [ISO_TIME, NO_TIME_TEXT_ID, BROKEN])
def test_failfast_stops(spark, bad):
    with pytest.raises(Exception, match="MALFORMED|PARSE|malformed"):
        decode_json(messages(spark, GOOD, bad), SCHEMA).collect()


@pytest.mark.parametrize("lost", [NO_TIME, None])
def test_failfast_stops_without_a_time(spark, lost):
    with pytest.raises(Exception, match="without an event time"):
        decode_json(messages(spark, GOOD, lost), SCHEMA).collect()
    assert decode_json(messages(spark, GOOD, lost), SCHEMA, "PERMISSIVE").count() == 1


def test_raw_rows_without_a_time_stay(spark):
    message = '{"DC_POWER":1,"AC_POWER":2,"DAILY_YIELD":3,"TOTAL_YIELD":4,"PLANT_ID":1,"SOURCE_KEY":"a"}'
    assert rows(raw_generator_rows(messages(spark, message))) == [(None, 1.0, 2.0, 3.0, 4.0, 1, "a")]


def test_permissive_keeps_what_has_a_time(spark):
    text_id = GOOD.replace("4135001", '"4135001"')
    got = rows(decode_json(messages(spark, ISO_TIME, NO_TIME_TEXT_ID, BROKEN, text_id), SCHEMA, "PERMISSIVE"))
    assert got == [(MIDNIGHT, 1.0, None, "a")]


def test_rejects(spark):
    inputs = [GOOD, MILLIS_NAN, ISO_TIME, NO_TIME_TEXT_ID, NO_TIME, BROKEN, None]
    good, rejects = decode_with_rejects(messages(spark, *inputs), SCHEMA)
    assert good.count() == 2
    assert {(r.value, r.reject_reason) for r in rejects.collect()} == {
        (ISO_TIME, "malformed"),
        (NO_TIME_TEXT_ID, "malformed"),
        (BROKEN, "malformed"),
        (NO_TIME, "no event time"),
        (None, "no value"),
    }


@pytest.mark.parametrize("number", ["Infinity", '"NaN"', "NaN", '"-Infinity"'])
def test_numbers_without_a_value(spark, number):
    text = GOOD.replace('"DC_POWER":1', f'"DC_POWER":{number}')
    assert rows(decode_json(messages(spark, text), SCHEMA)) == [(MIDNIGHT, None, 4135001, "a")]


def test_only_the_fields_asked_for(spark):
    df = decode_json(messages(spark, GOOD), SCHEMA, fields=["DATE_TIME", "SOURCE_KEY"])
    assert rows(df) == [(MIDNIGHT, "a")]


def test_each_message_is_parsed_once(spark):
    text = plan(decode_json(messages(spark, GOOD), SCHEMA).filter("DC_POWER > 0"))
    generate = [line for line in text.splitlines() if "from_json" in line]
    assert not any(line.startswith(("Condition", "Output")) for line in generate)


def test_raw_rows_keep_the_time_as_text(spark, tmp_path):
    generator = '{"DATE_TIME":"15/5/20 0h","DC_POWER":1,"AC_POWER":2,"DAILY_YIELD":3,"TOTAL_YIELD":4,"PLANT_ID":1,"SOURCE_KEY":"a"}'
    weather = '{"DATE_TIME":"x","AMBIENT_TEMPERATURE":1,"MODULE_TEMPERATURE":2,"IRRADIATION":3,"PLANT_ID":1,"SOURCE_KEY":"s"}'
    assert rows(raw_generator_rows(messages(spark, generator))) == [("15/5/20 0h", 1.0, 2.0, 3.0, 4.0, 1, "a")]
    assert rows(raw_weather_rows(messages(spark, weather))) == [("x", 1.0, 2.0, 3.0, 1, "s")]


def test_message_text(spark):
    row = (datetime(2020, 5, 15, 6, 15), 1000.5, 970.2, 250.0, None, 4135001, "inv-a")
    message = project.messages(spark.createDataFrame([row], S.generator_schema())).first()
    assert message.key == '{"plant_id":4135001,"source_key":"inv-a"}'
    assert message.value == (
        '{"DATE_TIME":"2020-05-15 06:15:00","DC_POWER":1000.5,"AC_POWER":970.2,"DAILY_YIELD":250.0,'
        '"TOTAL_YIELD":null,"PLANT_ID":4135001,"SOURCE_KEY":"inv-a"}'
    )


def test_message_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(GOOD + "\n")
    assert decode_json(message_files(spark, str(tmp_path)), SCHEMA).count() == 1
