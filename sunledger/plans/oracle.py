"""The same queries in plain SQL for another engine, written from the definitions and not from the operators.

Sums are exact: each double is scaled by 2^100, where it is a whole number, and summed as a 128-bit integer. Only the
sum is rounded to a double, part by part and smallest first.
"""

from __future__ import annotations

VIEWS = """
with g as (
  select cast(date_trunc('second', ts) as timestamp) as DATE_TIME, value as DC_POWER,
         value * (0.9e0 + cast(json_extract_string(props, '$.k') as int) / 1000e0) as AC_POWER,
         value as DAILY_YIELD, value as TOTAL_YIELD,
         cast(user_id % 3 as int) as PLANT_ID, event_type as SOURCE_KEY
  from events
), w as (
  select cast(date_trunc('second', ts) as timestamp) as DATE_TIME,
         20e0 + cast(json_extract_string(props, '$.k') as int) / 10e0 as AMBIENT_TEMPERATURE,
         20e0 + cast(json_extract_string(props, '$.k') as int) / 10e0 + value / 10e0 as MODULE_TEMPERATURE,
         value / 100e0 as IRRADIATION,
         cast(user_id % 3 as int) as PLANT_ID,
         concat('sensor-', cast(user_id % 3 as varchar(8))) as SOURCE_KEY
  from events where event_type = 'view'
), closed as (
  select max(DATE_TIME) - interval 30 minute as upto from g
), closed_w as (
  select max(DATE_TIME) - interval 30 minute as upto from w
), capacity as (
  select * from (values (0, 100e0), (1, 150e0), (2, 200e0)) as t(plant_id, capacity_kw)
)
"""

READING = "DATE_TIME, DC_POWER, AC_POWER, DAILY_YIELD, TOTAL_YIELD, PLANT_ID, SOURCE_KEY"


def xs(x: str) -> str:
    total = f"sum(cast(({x}) * {2.0**100!r} as hugeint))"
    digits = [f"cast((abs({total}) // {1 << (100 - 20 * place)}) % 1048576 as double)" for place in range(1, 6)]
    rest = "0e0"
    for digit in reversed(digits):
        rest = f"(({rest} + {digit}) / 1048576e0)"
    return f"(sign({total}) * (cast(abs({total}) // {1 << 100} as double) + {rest}))"


def xa(x: str) -> str:
    return f"{xs(x)} / count({x})"


def xv(x: str) -> str:
    return f"case when min({x}) = max({x}) then min({x}) else {xa(x)} end"


def by_window(unit: str, name: str, measure: str, alias: str, view: str = "g") -> str:
    return (
        f"select cast(date_trunc('{unit}', DATE_TIME) as timestamp) as {name}, PLANT_ID as plant_id, "
        f"{measure} as {alias} from {view} group by 1, 2"
    )


GENERATOR_METRICS = """select PLANT_ID as plant_id, SOURCE_KEY as source_key, DATE_TIME as date_time,
  DC_POWER as dc_power, AC_POWER as ac_power, DAILY_YIELD as yield from g"""
WEATHER_METRICS = """select PLANT_ID as plant_id, SOURCE_KEY as source_key, DATE_TIME as date_time,
  AMBIENT_TEMPERATURE as ambient_temp, MODULE_TEMPERATURE as module_temp, IRRADIATION as irradiation from w"""
DAILY_YIELD = f"""select PLANT_ID as plant_id, SOURCE_KEY as source_key,
  cast(date_trunc('day', DATE_TIME) as timestamp) as date_time, {xs("DAILY_YIELD")} as rolling_sum
  from g group by 1, 2, 3"""
HOURLY_YIELD = f"""select cast(date_trunc('hour', DATE_TIME) as timestamp) as window_start,
  cast(date_trunc('hour', DATE_TIME) as timestamp) + interval 1 hour as window_end,
  PLANT_ID as plant_id, SOURCE_KEY as source_key, {xs("DAILY_YIELD")} as total_yield
  from g group by 1, 2, 3, 4"""
AVG_DC = by_window("hour", "hour_start", xa("DC_POWER"), "avg_dc_power")
AVG_AC = by_window("hour", "hour_start", xa("AC_POWER"), "avg_ac_power")
IRRADIATION = by_window("hour", "hour_start", xa("IRRADIATION"), "avg_irradiation", "w")
DELTA = by_window(
    "hour", "hour_start", xa("(MODULE_TEMPERATURE - AMBIENT_TEMPERATURE)"), "temperature_delta", "w"
)
EFFICIENCY = by_window(
    "hour", "hour_start", f'100e0 * {xs("AC_POWER")} / nullif({xs("DC_POWER")}, 0)', "efficiency_pct"
)
PRODUCTION = by_window("hour", "hour_start", xs("DAILY_YIELD"), "production")
HOUR_CLOSED = "hour_start + interval 1 hour <= (select upto from closed)"
JOINED = f"""select a.hour_start, a.plant_id, avg_dc_power, temperature_delta
  from ({AVG_DC}) a left join ({DELTA}) d on a.hour_start = d.hour_start and a.plant_id = d.plant_id"""
DASHBOARD = f"""select hour_start, plant_id, production / capacity_kw as production_density,
  avg_irradiation, avg_dc_power, avg_ac_power, temperature_delta, efficiency_pct
  from (select * from ({PRODUCTION}) join ({AVG_DC}) using (hour_start, plant_id)
    join ({AVG_AC}) using (hour_start, plant_id) join ({EFFICIENCY}) using (hour_start, plant_id)) p
  full join (select * from ({IRRADIATION}) join ({DELTA}) using (hour_start, plant_id)) w using (hour_start, plant_id)
  left join capacity using (plant_id)"""
WEATHER_AT = f"""select DATE_TIME, PLANT_ID, {xv("AMBIENT_TEMPERATURE")} as ambient_temp,
  {xv("MODULE_TEMPERATURE")} as module_temp, {xv("IRRADIATION")} as irradiation from w group by 1, 2"""
ENRICHED = f"""select g.PLANT_ID as plant_id, g.SOURCE_KEY as source_key, g.DATE_TIME as date_time,
  DC_POWER as dc_power, AC_POWER as ac_power, DAILY_YIELD as yield, ambient_temp, module_temp, irradiation
  from g left join ({WEATHER_AT}) a on g.DATE_TIME = a.DATE_TIME and g.PLANT_ID = a.PLANT_ID"""
DAILY_SLICE = f"""select * from ({DAILY_YIELD})
  where date_time >= timestamp '2024-01-10' and date_time < timestamp '2024-01-13'"""
SLOT_GAPS = """, s as (
  select distinct PLANT_ID as plant_id, time_bucket(interval '15 minutes', DATE_TIME) as slot_start from g
), grid as (
  select plant_id, unnest(generate_series(min(slot_start), max(slot_start), interval '15 minutes')) as slot_start
  from s group by plant_id
) select plant_id, cast(slot_start as timestamp) as slot_start from grid
  where not exists (select 1 from s where s.plant_id = grid.plant_id and s.slot_start = grid.slot_start)"""

BODIES = {
    "generator_metrics": GENERATOR_METRICS,
    "weather_metrics": WEATHER_METRICS,
    "daily_yield": DAILY_YIELD,
    "hourly_yield": HOURLY_YIELD,
    "hourly_production_density": f"""select hour_start, p.plant_id, production / capacity_kw as production_density
      from ({PRODUCTION}) p left join capacity on p.plant_id = capacity.plant_id""",
    "hourly_avg_irradiation": IRRADIATION,
    "avg_dc_power": AVG_DC,
    "avg_ac_power": AVG_AC,
    "temperature_delta": DELTA,
    "conversion_efficiency": EFFICIENCY,
    "daily_production": by_window("day", "day_start", xs("DAILY_YIELD"), "production"),
    "generator_weather_join": JOINED,
    "enriched_readings": ENRICHED,
    "dashboard": DASHBOARD,
    "alerts": f"select * from ({EFFICIENCY}) where efficiency_pct < 95",
    "pk_duplicates": """select PLANT_ID as plant_id, SOURCE_KEY as source_key, DATE_TIME as date_time,
      count(*) as n_rows from g group by 1, 2, 3 having count(*) > 1""",
    "slot_gaps": SLOT_GAPS,
    "slot_bounds": """select PLANT_ID as plant_id, min(DATE_TIME) as first_slot, max(DATE_TIME) as last_slot
      from g group by 1""",
    "rows_per_slot": "select DATE_TIME as date_time, count(*) as n_rows from g group by 1",
    "slot_lookup": f"select {READING} from g where DATE_TIME = (select min(DATE_TIME) from g)",
    "daily_slice": DAILY_SLICE,
    "stored_daily_slice": DAILY_SLICE,
    "keyed_generator_metrics": f"""select plant_id, source_key, date_time, dc_power, ac_power, yield from (
      select *, row_number() over (partition by plant_id, source_key, date_time
                                   order by dc_power, ac_power, yield) as place
      from ({GENERATOR_METRICS})) where place = 1""",
    "json_roundtrip": f"select {READING} from g",
    "raw_rows": f"""select * replace (strftime(DATE_TIME, '%Y-%m-%d %H:%M:%S') as DATE_TIME)
      from (select {READING} from g)""",
    "json_messages": f"""select PLANT_ID as key_plant_id, SOURCE_KEY as key_source_key,
      * replace (strftime(DATE_TIME, '%Y-%m-%d %H:%M:%S') as DATE_TIME) from (select {READING} from g)""",
    "csv_scan": f"select {READING} from g",
    "hourly_yield_stream": f"select * from ({HOURLY_YIELD}) where window_end <= (select upto from closed)",
    "daily_yield_stream": f"""select * from ({DAILY_YIELD})
      where date_time + interval 1 day <= (select upto from closed)""",
    "generator_metrics_stream": GENERATOR_METRICS,
    "weather_metrics_stream": WEATHER_METRICS,
    # Two sources: the slower one holds the watermark back.
    "generator_weather_join_stream": f"""select * from ({JOINED})
      where hour_start + interval 1 hour <= (select least(closed.upto, closed_w.upto) from closed, closed_w)""",
    "enriched_readings_stream": f"""select * from ({ENRICHED})
      where date_time <= (select least(closed.upto, closed_w.upto) from closed, closed_w)""",
    "dashboard_stream": f"""select * from ({DASHBOARD})
      where hour_start + interval 1 hour <= (select least(closed.upto, closed_w.upto) from closed, closed_w)""",
    "alerts_stream": f"select * from ({EFFICIENCY}) where efficiency_pct < 95 and {HOUR_CLOSED}",
}

OUTCOMES = "select case {cases} else 'reading' end as outcome, count(*) as n_rows from g group by 1"
BODIES |= {
    "message_rejects": OUTCOMES.format(
        cases="""second(DATE_TIME) when 7 then 'malformed' when 11 then 'no event time' when 13 then 'no value'"""
    ),
    "csv_rejects": OUTCOMES.format(cases="when second(DATE_TIME) in (7, 11) then 'no time in a known form'"),
    "weather_json_roundtrip": "select * from w",
    "dry_run_messages": BODIES["json_messages"],
    "stored_hourly_slice": f"""select * from ({HOURLY_YIELD})
      where window_start >= timestamp '2024-01-10 05:30:00' and window_start < timestamp '2024-01-11 02:00:00'""",
    "loaded_generator_metrics": BODIES["keyed_generator_metrics"],
    "streamed_generator_metrics": BODIES["keyed_generator_metrics"],
    "hourly_yield_from_messages": BODIES["hourly_yield_stream"],
    "restarted_hourly_yield": BODIES["hourly_yield_stream"],
    "replayed_hourly_yield": BODIES["hourly_yield_stream"],
    "fan_out": f"""select 'daily_yield' as table_name, count(*) as n_rows from ({BODIES["daily_yield_stream"]})
      union all select 'hourly_yield', count(*) from ({BODIES["hourly_yield_stream"]})
      union all select 'generator_metrics', count(distinct (plant_id, source_key, date_time)) from ({GENERATOR_METRICS})
      union all select 'weather_metrics', count(distinct (plant_id, source_key, date_time)) from ({WEATHER_METRICS})""",
}

ASOF = f"""select g.PLANT_ID as plant_id, g.SOURCE_KEY as source_key, g.DATE_TIME as date_time,
  DC_POWER as dc_power, AC_POWER as ac_power, DAILY_YIELD as yield,
  case when near then ambient_temp end as ambient_temp, case when near then module_temp end as module_temp,
  case when near then irradiation end as irradiation
  from (select g.*, a.* exclude (DATE_TIME, PLANT_ID), g.DATE_TIME - a.DATE_TIME <= interval 15 minute as near
    from g asof left join ({WEATHER_AT}) a on g.PLANT_ID = a.PLANT_ID and g.DATE_TIME >= a.DATE_TIME) g"""
ENERGY = f"""select cast(date_trunc('hour', DATE_TIME) as timestamp) as window_start, PLANT_ID as plant_id,
  SOURCE_KEY as source_key, {xs("step")} as energy
  from (select *, case when before is null or c < before then c else c - before end as step
    from (select *, lag(c) over (partition by PLANT_ID, SOURCE_KEY, date_trunc('day', DATE_TIME) order by DATE_TIME) as before
      from (select PLANT_ID, SOURCE_KEY, DATE_TIME, max(DAILY_YIELD) as c from g group by 1, 2, 3)))
  group by 1, 2, 3"""
# A step is a difference of doubles and not a product of the scale: what lies under 2^-100 is cut by the cast alike.
# An episode begins with the first hour under 95 since the last that cleared or the last gap.
EPISODES = f"""select plant_id, min(hour_start) as first_hour, max(hour_start) as last_hour, count(*) as n_hours,
  min(efficiency_pct) as worst
  from (select *, min(efficiency_pct) over (partition by plant_id, run order by hour_start) as lowest
    from (select *, sum(case when starts then 1 else 0 end) over (partition by plant_id order by hour_start) as run
      from (select *, coalesce(lag(efficiency_pct >= {{clear}}) over w
          or hour_start - lag(hour_start) over w > interval 1 hour, true) as starts
        from ({EFFICIENCY}) where efficiency_pct is not null {{more}} window w as (partition by plant_id order by hour_start))
      where efficiency_pct < {{clear}}))
  where lowest < 95 group by plant_id, run"""
LATE = f"""select {READING}, DATE_TIME as t0, cast(date_trunc('hour', DATE_TIME) as timestamp) + interval 1 hour as window_end,
  cast(PLANT_ID as bigint) as batch
  from g where date_trunc('hour', DATE_TIME) + interval 1 hour
    <= (select max(o.DATE_TIME) from g o where o.PLANT_ID < g.PLANT_ID) - interval 30 minute"""
BODIES |= {
    "daily_yield_from_hours": DAILY_YIELD,
    "daily_production_from_hours": BODIES["daily_production"],
    "reloaded_hourly_yield": HOURLY_YIELD,
    "compacted_generator_metrics": BODIES["keyed_generator_metrics"],
    "published_in_order": BODIES["hourly_yield_stream"],
    "late_readings": f"select * exclude (t0) from ({LATE})",
    "printed_messages": BODIES["raw_rows"],
    "asof_enriched_readings": ASOF,
    # Spark keeps a reading until the slower watermark is the range of the join beyond it.
    "asof_enriched_readings_stream": f"""select * from ({ASOF})
      where date_time + interval 15 minute <= (select least(closed.upto, closed_w.upto) from closed, closed_w)""",
    "hourly_energy": ENERGY,
    "alert_episodes": EPISODES.format(clear="97", more=""),
    # An episode is closed when the watermark is a gap beyond its last hour.
    "alert_episodes_stream": f"""select * from ({EPISODES.format(clear="95", more=f"and {HOUR_CLOSED}")})
      where last_hour + interval 121 minute <= (select upto from closed)""",
}

ORACLE = {name: VIEWS.strip() + body for name, body in BODIES.items()}
