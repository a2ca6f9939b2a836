"""A stored table by key that takes batches: only the buckets that a batch touches are written again.

Rows lie in Parquet folders by ``bucket``, a hash of the key, and Spark's own dynamic
partition overwrite replaces those of a batch. A batch is first merged into a table of its own, then
a log names it as ready, then the buckets are overwritten from it and the log names it as done. A reader or
writer that finds a batch ready but not done does the overwrite again, so a lost driver costs nothing; a batch
that the log has as done is skipped, so a stream that repeats one after a restart changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

_LOG = "writer string, number long, ready string, buckets int, at timestamp"


def notes(spark: SparkSession, path: str) -> DataFrame:
    """What has been noted under ``path``; a row or two for each batch."""
    try:
        return spark.read.schema(_LOG).parquet(f"{path}/log")
    except AnalysisException as e:  # no batch has come yet
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LOG)


def note(spark: SparkSession, path: str, writer: str, number: int, ready: str | None = None, buckets: int = 0) -> None:
    row = spark.createDataFrame([(writer, number, ready, buckets)], "writer string, number long, ready string, buckets int")
    row.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{path}/log")


def bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def touched(rows: DataFrame, keys: list[str], buckets: int) -> list[int]:
    """The numbers of the folders where keys of ``rows`` can lie."""
    return [r.bucket for r in rows.select(bucket(keys, buckets).alias("bucket")).distinct().collect()]


def _finish(spark: SparkSession, path: str, schema: StructType) -> list:
    """Overwrite from a batch that is ready but not done, if one is; the log's rows."""
    log = notes(spark, path).collect()  # a row or two for each batch
    done = {(r.writer, r.number) for r in log if r.ready is None}
    for r in log:
        if r.ready is not None and (r.writer, r.number) not in done:
            _overwrite(spark, path, r, schema)
            return notes(spark, path).collect()
    return log


def _overwrite(spark: SparkSession, path: str, r, schema: StructType) -> None:
    whole = StructType([*schema.fields, StructField("bucket", IntegerType())])
    rows = spark.read.schema(whole).parquet(r.ready).repartition("bucket")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{path}/rows")
    note(spark, path, r.writer, r.number, None, r.buckets)


def read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows of the store; none before the first batch."""
    if not _finish(spark, path, schema):
        return spark.createDataFrame([], schema)
    whole = StructType([*schema.fields, StructField("bucket", IntegerType())])
    return spark.read.schema(whole).parquet(f"{path}/rows").select(schema.names)


def lookup(wanted: DataFrame, path: str, schema: StructType, keys: list[str]) -> DataFrame:
    """The store's rows with the ``keys`` of a row of ``wanted``; folders where none can lie are not read.

    The driver gets the numbers of those folders. Keys of ``wanted`` must have the store's types, as their hash depends on them.
    """
    spark = wanted.sparkSession
    log = _finish(spark, path, schema)
    if not log:
        return spark.createDataFrame([], schema)
    some = wanted.select(*keys).distinct()
    whole = StructType([*schema.fields, StructField("bucket", IntegerType())])
    rows = spark.read.schema(whole).parquet(f"{path}/rows").where(F.col("bucket").isin(touched(wanted, keys, log[0].buckets)))
    return rows.join(some, keys, "left_semi").select(schema.names)


def merge(path: str, batch: DataFrame, keys: list[str], combine: Callable[[DataFrame], DataFrame], writer: str, number: int, buckets: int = 64) -> bool:
    """Merge batch ``number`` of ``writer`` into the store under ``path``; False if it is there already.

    ``combine`` makes the new rows of the touched buckets out of the old and the batch's together, with the
    batch's columns; it keeps a row at least of every key. ``buckets`` counts when the store is begun. The driver gets the
    numbers of the touched buckets. One writer at a time: of two at once, one may undo what the other adds.
    """
    spark = batch.sparkSession
    log = _finish(spark, path, batch.schema)
    if any((r.writer, r.number, r.ready) == (writer, number, None) for r in log):
        return False
    buckets = log[0].buckets if log else buckets
    placed = batch.withColumn("bucket", bucket(keys, buckets))
    ready = f"{path}/ready/{writer}-{number}"
    old = placed.limit(0)
    if log:
        whole = StructType([*batch.schema.fields, StructField("bucket", IntegerType())])
        old = spark.read.schema(whole).parquet(f"{path}/rows").where(F.col("bucket").isin(touched(batch, keys, buckets)))
    merged = combine(old.union(placed).drop("bucket")).select(batch.columns)
    merged.withColumn("bucket", bucket(keys, buckets)).write.mode("overwrite").parquet(ready)
    note(spark, path, writer, number, ready, buckets)
    _finish(spark, path, batch.schema)
    return True


def follow(stream: DataFrame, path: str, keys: list[str], combine: Callable[[DataFrame], DataFrame], writer: str, buckets: int = 64) -> DataFrame:
    """Merge all that a stream has now into the store and return its rows.

    The stream's progress lies beside the store under the writer's name, so a later call goes on where this one ends, and one
    under another name brings a stream of its own.
    """
    spark, schema = stream.sparkSession, stream.schema
    query = (
        stream.writeStream.option("checkpointLocation", f"{path}/progress/{writer}")
        .foreachBatch(lambda batch, number: merge(path, batch, keys, combine, writer, number, buckets) and None).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return read(spark, path, schema)
