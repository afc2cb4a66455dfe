"""Each generator reading with the weather its plant had at that time, or last before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunledger.functions import same_or_mean, wall_clock
from sunledger.operators.project import key_columns
from sunledger.schemas import EVENT_TIME, PLANT, SOURCE, WEATHER_MEASURES

#: Join tasks that one plant and time is split over in a stream.
MOST_SPREAD = 16
_UNTIMED = ["DC_POWER", "AC_POWER", "DAILY_YIELD", PLANT, SOURCE]
READING = [EVENT_TIME, *_UNTIMED]


def weather_at(weather: DataFrame) -> DataFrame:
    """One row per plant and event time, so the join below is many-to-one whatever the input holds. A value that all
    rows agree on passes through as it is; where sensors differ it is their mean."""
    return weather.groupBy(EVENT_TIME, PLANT).agg(*(same_or_mean(name).alias(name) for name in WEATHER_MEASURES))


def enrich_readings(generator: DataFrame, weather: DataFrame, spread: int | None = None) -> DataFrame:
    """Left outer equi-join on plant and event time, batch or (both sides watermarked) stream.

    One plant and time may hold a large share of the generator rows. In batch AQE splits such join partitions, and a
    filter on the result reaches both scans. A stream is planned once: there ``spread`` (a quarter of the shuffle
    partitions, at most :data:`MOST_SPREAD`) splits each group over as many join tasks and repeats its single weather row
    for each, so the join's state grows by no more than that, however many partitions there are. The share is picked by row
    content and partition, not by chance, so a retried task picks the same one, and copies still spread.
    """
    join_key = [EVENT_TIME, PLANT]
    left, right = generator, weather_at(weather)
    if generator.isStreaming:
        if spread is None:
            spread = min(MOST_SPREAD, max(1, int(generator.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4))
        content = F.xxhash64(SOURCE, "DC_POWER", "AC_POWER", "DAILY_YIELD") + F.spark_partition_id()
        left = left.withColumn("share", F.pmod(content, F.lit(spread)).cast("int"))
        right = right.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
        join_key = [*join_key, "share"]
    return _enriched(left.join(right, join_key, "left"))


def _enriched(joined: DataFrame) -> DataFrame:
    return joined.select(
        *key_columns(),
        wall_clock(EVENT_TIME).alias("date_time"),
        F.col("DC_POWER").alias("dc_power"),
        F.col("AC_POWER").alias("ac_power"),
        F.col("DAILY_YIELD").alias("yield"),
        F.col("AMBIENT_TEMPERATURE").alias("ambient_temp"),
        F.col("MODULE_TEMPERATURE").alias("module_temp"),
        F.col("IRRADIATION").alias("irradiation"),
    )


def asof_enriched(generator: DataFrame, weather: DataFrame, tolerance: str = "15 minutes") -> DataFrame:
    """Each reading with the last weather its plant had at or up to ``tolerance`` before it; batch or (both sides
    watermarked) stream. Readings without such weather keep NULL."""
    if generator.isStreaming:
        return _asof_stream(generator, weather_at(weather), tolerance)
    return _asof_batch(generator, weather_at(weather), tolerance)


def _asof_batch(generator: DataFrame, weather: DataFrame, tolerance: str) -> DataFrame:
    """Both sides in buckets of time as wide as the tolerance, in order within them. What a reading may need from before
    its bucket is the last weather row of the bucket before, so each bucket is handed that one row: no bucket knows more
    than its own rows and one, and a plant's whole history is never in one task."""
    width = F.expr(f"interval {tolerance}")
    bucket = F.window(EVENT_TIME, tolerance)["start"]
    sky = weather.withColumn("bucket", bucket).withColumn("sky", F.struct(EVENT_TIME, *WEATHER_MEASURES))
    carried = sky.groupBy(PLANT, "bucket").agg(F.max_by("sky", EVENT_TIME).alias("sky"))
    carried = carried.withColumn("bucket", F.col("bucket") + width)
    skies = sky.select(PLANT, "bucket", "sky").unionByName(carried.select(PLANT, "bucket", "sky"))
    skies = skies.withColumn("at", F.col(f"sky.{EVENT_TIME}")).withColumn("reading", F.lit(None))
    rows = generator.select(PLANT, bucket.alias("bucket"), F.col(EVENT_TIME).alias("at"), F.struct(*READING).alias("reading"))
    # Weather comes before readings of the same time.
    order = Window.partitionBy(PLANT, "bucket").orderBy("at", F.col("reading").isNotNull())
    last = F.last("sky", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    every = skies.unionByName(rows, allowMissingColumns=True).withColumn("sky", last).filter("reading is not null")
    near = F.col("sky").getField(EVENT_TIME) >= F.col("at") - width
    return _enriched(every.select("reading.*", *(F.when(near, F.col("sky")[m]).alias(m) for m in WEATHER_MEASURES)))


#: Place of the last weather at or before a reading among its bucket's, by halving steps: -1 if there is none.
_LAST = "aggregate(g.steps, -1, (i, step) -> if(get(g.times, i + step) <= r.at, i + step, i))"
_STEPS = ", ".join(str(1 << bit) for bit in range(30, -1, -1))
#: Each reading of a bucket with that weather. The array of one struct keeps what is worked out for the bucket.
_WITH_LAST = f"""transform(
    array(struct(readings, skies, transform(skies, s -> s.at) as times, filter(array({_STEPS}), n -> n <= size(skies)) as steps)),
    g -> transform(g.readings, r -> struct(r as reading, get(g.skies, {_LAST}) as sky)))[0]"""


def _asof_stream(generator: DataFrame, weather: DataFrame, tolerance: str) -> DataFrame:
    """Times are in buckets as wide as the tolerance, and a weather row is in its own and the next. Each side gathers a
    plant's bucket until the watermark closes it; the join hands the readings of a bucket its weather in order, and each
    finds its own there by halving. State and work are one entry a reading and bucket, however many weather rows are near.

    A reading is given once the slower watermark is the tolerance beyond it. That is after its bucket has closed; equal
    readings wait as one. The bucket's end and that time carry the mark of the event time they are made from, which
    Spark goes by in keys."""
    marked = generator.schema[EVENT_TIME].metadata
    width = F.expr(f"interval {tolerance}")
    end = _bucket_end(EVENT_TIME, tolerance)
    at = F.unix_micros(F.col(EVENT_TIME).cast("timestamp")).alias("at")
    # No time of the fields may carry the mark beside the bucket's.
    readings = generator.select(PLANT, end.alias("bucket", metadata=marked), F.struct(at, *_UNTIMED).alias("reading"))
    readings = readings.groupBy(PLANT, "bucket").agg(F.collect_list("reading").alias("readings"))
    sky = weather.select(F.col(PLANT).alias("sky_plant"), F.explode(F.array(end, end + width)).alias("end"), F.struct(at, *WEATHER_MEASURES).alias("sky"))
    sky = sky.select("sky_plant", F.col("end").alias("sky_bucket", metadata=marked), "sky")
    sky = sky.groupBy("sky_plant", "sky_bucket").agg(F.sort_array(F.collect_list("sky")).alias("skies"))
    same = (F.col(PLANT) == F.col("sky_plant")) & (F.col("bucket") == F.col("sky_bucket"))
    joined = readings.join(sky, same, "left").withColumn("skies", F.coalesce("skies", F.array().cast(sky.schema["skies"].dataType)))
    rows = joined.select(F.col("bucket").alias("closed"), F.expr(f"inline({_WITH_LAST})"))
    time, sky_time = F.timestamp_micros("reading.at"), F.timestamp_micros("sky.at")
    near = sky_time >= time - width
    due = F.greatest(time + width, "closed").alias("due", metadata=marked)
    rows = rows.select("reading.*", due, *(F.when(near, F.col("sky")[m]).alias(m) for m in WEATHER_MEASURES))
    waiting = rows.groupBy("at", *_UNTIMED, "due").agg(F.count("*").alias("n_rows"), *(F.first(m).alias(m) for m in WEATHER_MEASURES))
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), "n_rows")).alias("copy")
    return _enriched(waiting.select(F.timestamp_micros("at").alias(EVENT_TIME), *_UNTIMED, *WEATHER_MEASURES, copies))


def _bucket_end(time: str, width: str) -> Column:
    at = f"unix_micros(cast({time} as timestamp))"
    size = f"greatest(unix_micros(timestamp_micros(0) + interval {width}), 1)"
    return F.expr(f"timestamp_micros({at} - pmod({at}, {size}) + {size})")
