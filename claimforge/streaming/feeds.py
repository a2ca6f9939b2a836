"""Streams of feed items and job events, each with the batch result as its measure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from claimforge.operators import aggregates, extraction, keyed_store
from claimforge.session import shared_folder


def feed_event_stream(items: DataFrame, delay: str = "2 days") -> DataFrame:
    """Items of a stream, each unique key once within the delay that late items may have.

    If items have an ``event_number``, each case, court and number is there once as well; items that lack one of the three
    are told apart by their unique key alone.
    """
    events = extraction.feed_events(items.withWatermark("published_at", delay))
    once = events.dropDuplicatesWithinWatermark(["unique_key"])
    if "event_number" not in items.columns:
        return once
    whole = F.col("case_number").isNotNull() & F.col("court_id").isNotNull() & F.col("event_number").isNotNull()
    second = F.when(whole, F.concat_ws(":", "court_id", "case_number", "event_number")).otherwise(F.concat(F.lit("key "), F.col("unique_key")))
    return once.withColumn("_second", second).dropDuplicatesWithinWatermark(["_second"]).drop("_second", "event_number")


def job_counts(events: DataFrame, every: str = "1 hour", slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Jobs per type and window of event time.

    Written in append mode, a window appears once, when the watermark (``delay`` behind the newest row) has passed its end, and
    later rows of it are left out. In complete mode none are.
    """
    at: Column = F.window("created_at", every, slide) if slide else F.window("created_at", every)
    return (
        events.withWatermark("created_at", delay).groupBy(at.alias("w"), "job_type")
        .agg(F.count("*").alias("n"), F.count_if(F.col("status") == "failed").alias("failed"))
        .select(F.col("w.start").alias("window_start"), "job_type", "n", "failed")
    )


def worker_sessions(events: DataFrame, gap: str = "10 minutes", delay: str = "1 hour") -> DataFrame:
    """Runs of a worker without a pause of ``gap``."""
    return (
        events.withWatermark("created_at", delay).groupBy(F.session_window("created_at", gap).alias("w"), "worker").agg(F.count("*").alias("n"))
        .select("worker", F.col("w.start").alias("started"), F.col("w.end").alias("ended"), "n")
    )


def current_status(events: DataFrame) -> DataFrame:
    """The newest status per filing and type, whatever the order of arrival."""
    return events.groupBy("filing_id", "job_type").agg(F.max_by("status", F.struct("created_at", "job_id")).alias("status"), F.count("*").alias("n_updates"))


def run_available(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream over all that is there now and return what it wrote; progress and output lie in the shared folder."""
    spark = stream.sparkSession
    out, last = shared_folder(spark, name), [0]

    def write(batch: DataFrame, number: int) -> None:  # a repeated batch overwrites its own folder
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")
        last[0] = number

    query = (
        stream.writeStream.outputMode(mode).option("checkpointLocation", shared_folder(spark, f"{name}-progress"))
        .foreachBatch(write).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    if mode == "complete":  # each batch holds the whole result
        out = f"{out}/batch={last[0]}"
    return spark.read.schema(stream.schema).parquet(out).select(*stream.columns)


def _largest_claims(rows: DataFrame) -> DataFrame:
    return rows.groupBy("creditor_id", "filing_id").agg(F.max("amount").alias("amount"))


def exposure_store(claims: DataFrame, path: str, writer: str = "claims") -> DataFrame:
    """Claims ``filing_id, creditor_id, amount`` of a stream merged batch by batch into a stored exposure, which is returned.

    The keyed store under ``path`` has a row for each creditor and filing, the larger amount if a claim comes again.
    It outlives the stream: a second call goes on after what ``writer`` has brought, another writer adds to it.
    Exposure is that table by creditor.
    """
    rows = claims.select("creditor_id", "filing_id", "amount")
    return aggregates.exposure_by_filing(keyed_store.follow(rows, path, ["creditor_id"], _largest_claims, writer))


def feed_event_store(items: DataFrame, path: str, writer: str = "feed") -> DataFrame:
    """The events of a stream of items merged into a stored table of events, which is returned: of a unique key the earliest stays.

    Repeats of any time are found, those of other writers and earlier runs too; the stream itself keeps no state.
    """

    def earliest(rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c != "unique_key"]
        first = rows.groupBy("unique_key").agg(F.min_by(F.struct(*rest), F.struct("published_at", "event_id")).alias("r"))
        return first.select("unique_key", "r.*").select(rows.columns)

    return keyed_store.follow(extraction.feed_events(items), path, ["unique_key"], earliest, writer)


def file_stream(spark: SparkSession, schema: StructType, path: str, files_per_batch: int = 4) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
