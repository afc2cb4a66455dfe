"""CSV readings and landed message files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunledger.functions.times import parse_time
from sunledger.schemas import EVENT_TIME
from sunledger.session import require_utc
from sunledger.sources.decode import CORRUPT, finite_columns


def _csv_rows(
    spark: SparkSession, path: str | list[str], schema: T.StructType, mode: str, corrupt: str | None = None
) -> DataFrame:
    """Rows with the time as text. Every type is declared: inferring them would read all files once more. The header
    decides the column order, so it is read first, from one file; a file with another header stops the job."""
    require_utc(spark)
    header = spark.read.option("header", True).csv(path, enforceSchema=False).schema.fieldNames()
    text_time = {f.name: f.dataType for f in schema} | {EVENT_TIME: T.StringType()}
    declared = [T.StructField(name, text_time.get(name, T.StringType())) for name in header]
    if corrupt is None:
        return spark.read.csv(path, schema=T.StructType(declared), header=True, enforceSchema=False, mode=mode)
    declared.append(T.StructField(corrupt, T.StringType()))
    reader = spark.read.option("columnNameOfCorruptRecord", corrupt)
    return reader.csv(path, schema=T.StructType(declared), header=True, enforceSchema=False, mode=mode)


def csv_readings(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Readings of any number of plants (``path`` may be a glob), columns matched to the header by name. A value or a
    time in no known form stops the job; :func:`csv_with_rejects` splits such rows off instead."""
    rows = _csv_rows(spark, path, schema, "FAILFAST")
    time_type = schema[EVENT_TIME].dataType
    known = parse_time(EVENT_TIME).cast(time_type)
    shown = F.concat(F.lit("no time in a known form: "), F.coalesce(EVENT_TIME, F.lit("(none)")))
    when = F.coalesce(known, F.raise_error(shown).cast(time_type))
    return rows.withColumn(EVENT_TIME, when).select(*finite_columns(schema))


def csv_with_rejects(
    spark: SparkSession, path: str | list[str], schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """Readings, and the rows that gave none: ``(line, reject_reason)``. Each row is in one of the two."""
    rows = _csv_rows(spark, path, schema, "PERMISSIVE", CORRUPT)
    fields = [name for name in rows.columns if name != CORRUPT]
    rows = rows.withColumn("line", F.coalesce(CORRUPT, F.to_csv(F.struct(*fields))))
    when = parse_time(EVENT_TIME).cast(schema[EVENT_TIME].dataType)
    reason = F.when(F.col(CORRUPT).isNotNull(), "malformed").when(when.isNull(), "no time in a known form")
    rows = rows.withColumn("reject_reason", reason)
    good = rows.filter("reject_reason IS NULL").withColumn(EVENT_TIME, when).select(*finite_columns(schema))
    return good, rows.filter("reject_reason IS NOT NULL").select("line", "reject_reason")


def message_files(spark: SparkSession, path: str, stream: bool = False, **options: str) -> DataFrame:
    """Message values landed as text, one JSON object per line: the file twin of a topic."""
    reader = spark.readStream if stream else spark.read
    return reader.options(**options).format("text").load(path)
