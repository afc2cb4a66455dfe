"""Exact deduplication by a stateful stream.

Documents arrive as ``(doc_id, digest, locator)``. A streaming aggregation holds, per digest and without expiry, the
number of arrivals, the identifier that stays and the locator of its content. The state lives in RocksDB, on the
executors' disks, with its changes in the checkpoint, so it may outgrow memory and survives a lost executor. Spark
sums map-side before the state's exchange: a text that makes up a third of all rows reaches the state as one row per
map task.

A digest alone proves nothing: where one occurs more than once (a hit), the full normalised bytes of each arrival are
compared with the content the locator names. Arrivals that differ from it form groups by their bytes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sunledger.llm.common import ascii_lower, files_for, own_names, rebalanced, run_dir, stored
from sunledger.session import configure_streams

#: Many small stores on one executor: no disk reserved ahead, one bounded memory for all, and stores of ended runs are
#: closed soon.
STORE = {
    "rocksdb.allowFAllocate": "false",
    "rocksdb.boundedMemoryUsage": "true",
    "rocksdb.maxMemoryUsageMB": "256",
    "rocksdb.writeBufferSizeMB": "8",
    "maintenanceInterval": "5s",
}
#: Arrivals of a state store. On a local folder each store's checkpoint costs an executor some twenty child processes (chmod,
#: readlink), which for a moment share its memory.
STORE_ROWS = 1 << 16
ARRIVAL = "doc_id bigint, digest string, file string"


def normalised(text: str = "text") -> Column:
    return ascii_lower(F.coalesce(F.col(text), F.lit("")))


def sha256(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def arrivals(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Batch or stream of documents to what the state needs; the file is empty where the rows come from none."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        digest(normalised()).cast("string").alias("digest"),
        F.input_file_name().alias("file"),
    )


def keyed_state(arriving: DataFrame) -> DataFrame:
    """Per digest: arrivals so far, the largest identifier, and the file that holds it. Nulls come before any id."""
    return arriving.groupBy("digest").agg(
        F.count("*").alias("n_rows"), F.max(F.struct("doc_id", "file")).alias("locator")
    )


def start_state(
    arriving: DataFrame, state: str, checkpoint: str, available_now: bool = True, stores: int | None = None
) -> StreamingQuery:
    """Run the stream. Each micro-batch writes the digests it changed under a number of its own, so that a batch run
    twice replaces itself; :func:`read_state` takes the latest of each digest. The state is in as many stores as there
    are shuffle partitions, or in ``stores``; a checkpoint keeps the number it began with."""
    spark = configure_streams(arriving.sparkSession, rocksdb=True)
    for name, value in STORE.items():
        spark.conf.set(f"spark.sql.streaming.stateStore.{name}", value)

    def upsert(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{state}/batch={batch}")

    writer = keyed_state(arriving).writeStream.outputMode("update").foreachBatch(upsert)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    if stores is None:
        return writer.start()
    # A query takes the session's settings as they are when it starts.
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", stores)
    try:
        return writer.start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)


def read_state(spark: SparkSession, state: str) -> DataFrame:
    """``digest, n_rows, locator``: the latest version of every digest."""
    schema = "digest string, n_rows bigint, locator struct<doc_id: bigint, file: string>, batch bigint"
    versions = spark.read.schema(schema).parquet(state)
    latest = versions.groupBy("digest").agg(F.max_by(F.struct("n_rows", "locator"), "batch").alias("s"))
    return latest.select("digest", "s.n_rows", "s.locator")


def checked_hits(docs: DataFrame, state: DataFrame, digest: Callable[[Column], Column], path: str) -> DataFrame:
    """``doc_id, digest, other``: every arrival whose digest came more than once. ``other`` is null where its bytes
    are those at the locator, and else holds them."""
    spark = docs.sparkSession
    content = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), normalised().alias("content"))
    content = content.withColumn("digest", digest(F.col("content")).cast("string"))
    repeated = state.filter("n_rows > 1").select("digest", F.col("locator.doc_id").alias("at"))
    hits = stored(rebalanced(content.join(repeated, "digest")), f"{path}/hits")
    held = hits.filter(F.col("doc_id").eqNullSafe(F.col("at"))).groupBy("digest")
    held = stored(held.agg(F.min("content").alias("held")), f"{path}/held")
    compared = hits.join(held, "digest")
    other = F.when(F.col("content") != F.col("held"), F.col("content"))
    compared.select("doc_id", "digest", other.alias("other")).write.parquet(f"{path}/compared")
    return spark.read.schema("doc_id bigint, digest string, other string").parquet(f"{path}/compared")


def exact_dedup(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per document: ``doc_id, digest, keep_id, group_size, kept``.

    Texts are equal when they are after lower-casing A-Z alone; a null text is an empty one. The largest ``doc_id`` of
    equal texts stays, a null id only when there is no other. Of rows with the same id and equal texts one is kept.
    An empty table gives an empty result. Other columns are not looked at.
    """
    spark = docs.sparkSession
    path = run_dir(spark, "exact-dedup")
    arrived = stored(rebalanced(arrivals(docs, digest)), f"{path}/arrivals")
    stream = spark.readStream.schema(ARRIVAL).parquet(f"{path}/arrivals")
    stores = max(1, -(-arrived.count() // STORE_ROWS))
    start_state(stream, f"{path}/state", f"{path}/checkpoint", stores=stores).awaitTermination()
    spark.createDataFrame([], "digest string, n_rows bigint, locator struct<doc_id: bigint, file: string>").write.mode(
        "overwrite"
    ).parquet(f"{path}/state/batch=-1")
    state = read_state(spark, f"{path}/state")
    compared = checked_hits(docs, state, digest, path)

    collided = compared.filter("other is not null").select("digest").distinct()
    rest = compared.join(collided, "digest", "left_semi")
    by_bytes = rest.groupBy("digest", "other").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    by_bytes = by_bytes.withColumnRenamed("other", "held").withColumnRenamed("digest", "held_digest")
    same = (F.col("digest") == F.col("held_digest")) & F.col("other").eqNullSafe(F.col("held"))
    special = rest.join(by_bytes, same).groupBy("doc_id", "digest", "other", "keep_id", "group_size")
    special = special.agg(F.count("*").alias("n")).drop("other")

    groups = state.select("digest", F.col("locator.doc_id").alias("keep_id"), F.col("n_rows").alias("group_size"))
    plain = arrived.groupBy("doc_id", "digest").agg(F.count("*").alias("n"))
    plain = plain.join(groups, "digest").join(collided, "digest", "left_anti")
    columns = ["doc_id", "digest", "keep_id", "group_size", "n"]
    rows = plain.select(*columns).unionByName(special.select(*columns))
    # Rows with the same id and bytes cannot be told apart; the first of them stays.
    return rows.select(
        *columns[:4],
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))).alias("copy"),
    ).select(*columns[:4], (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"))


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns, whatever these are called. A null text is an empty one; a null id
    stays only where equal texts have no other; of repeated rows one stays; an empty table stays empty. They come in
    partitions of a useful size, yet as many as the session runs tasks at once."""
    spark = docs.sparkSession
    own_id, own_digest, digest_of = own_names(docs, "id", "digest", "digest_of")
    kept = stored(exact_dedup(docs).filter("kept").select("doc_id", "digest"), run_dir(spark, "exact-dedup-kept"))
    kept = kept.select(F.col("doc_id").alias(own_id), F.col("digest").alias(own_digest))
    keyed = docs.withColumn(digest_of, sha256(normalised()))
    same = F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.col(digest_of) == F.col(own_digest))
    rows = keyed.join(kept, same, "left_semi")
    partitions = max(files_for(kept.count()), spark.sparkContext.defaultParallelism)
    return one_per_key(rows, ["doc_id", digest_of]).drop(digest_of).coalesce(partitions)


def one_per_key(rows: DataFrame, key: list[str]) -> DataFrame:
    """Repeated rows collapse to one. The wide shuffle this takes is paid only where a count finds repeats."""
    repeated = rows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1").limit(1).count()
    return rows.dropDuplicates(key) if repeated else rows
