"""The daily reports kept up to date by batches of changes, so that reading one touches only its window.

Under one path lie keyed stores and tables to which a batch only adds a folder, as their rows never change:

* ``creditors`` by id, a store, the texts parsed once, when they come;
* ``jobs`` by filing, a store, the newest status of each look-up job;
* ``counts`` by creditor, a store: marks of synced and enriched, ties to filings with open and with failed jobs, and the newest filing;
* ``filings``, and ``ties``, which creditors a filing has, both in folders by batch and by a hash of the filing;
* ``entries`` in folders by batch and month, each file sorted by day: creditor and filing with the filing's columns and the day on which the later of
  both was created. Those without a month never show in a report; of them the ones that are not ``met`` wait for their filing or creditor.

A job that leaves the queue takes back what it had counted: a batch adds to ``counts`` the difference
between what a touched filing's jobs say after and before it, for each of the filing's ties. So a stage is read from four sums
and no job or tie is looked at again. Ties whose filing or creditor has not come yet wait for it.

A batch is first written down with all differences (its plan) and its folders, and noted, then each store merges its part once.
Folders of a batch that is not noted are not read. A batch that is repeated, whole or after any step, changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from claimforge.operators import aggregates, keyed_store

TABLES = ("filings", "creditors", "links", "jobs", "synced", "contacts")


def _struct(**types: str | StructType) -> StructType:
    out = StructType()
    for name, kind in types.items():
        out = out.add(name, kind)
    return out


FILINGS = _struct(filing_id="long", debtor_name="string", case_number="string", filing_date="date", state="string", created_on="date")
CREDITORS = _struct(
    creditor_id="long", creditor="string", city="string", _home="string", claim="string", profile_url="string", tier="integer", _made="date", shown="boolean",
    source_filing_id="long",
)
JOBS = _struct(filing_id="long", job_id="long", status="string", created_at="timestamp")
TIES = _struct(filing_id="long", creditor_id="long")
COUNTS = _struct(
    creditor_id="long", synced="long", enriched="long", pending="long", failed="long", newest=_struct(created_on="date", filing_id="long", state="string")
)
ENTRIES = _struct(
    creditor_id="long", filing_id="long", debtor_name="string", case_number="string", filing_date="date", state="string", entered="date", created_on="date",
    met="boolean", batch="long", month="date",
)

SUMS = ("synced", "enriched", "pending", "failed")
OPEN = ("queued", "running", "retrying")


def _typed(df: DataFrame, schema: StructType) -> DataFrame:
    return df.select(*(F.col(f.name).cast(f.dataType) for f in schema.fields))


def _one_each(key: str):
    return lambda rows: rows.dropDuplicates([key])


def _newest_status(rows: DataFrame) -> DataFrame:
    newest = F.max(F.struct("created_at", "status")).alias("_r")
    return rows.groupBy("filing_id", "job_id").agg(newest).select("filing_id", "job_id", "_r.status", "_r.created_at")


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("creditor_id").agg(*(F.sum(c).alias(c) for c in SUMS), F.max("newest").alias("newest"))


# Name, schema, key and how old and new rows of a key become one, for each keyed store.
STORES = (
    ("creditors", CREDITORS, "creditor_id", _one_each("creditor_id")), ("jobs", JOBS, "filing_id", _newest_status), ("counts", COUNTS, "creditor_id", _summed)
)


def _of_batches(spark: SparkSession, path: str, schema: StructType, batches: set[int]) -> DataFrame:
    """The rows that ``batches`` added to the table under ``path``."""
    if not batches:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*(f"{path}/batch={n}" for n in sorted(batches)))


def _by_filing(spark: SparkSession, path: str, schema: StructType, batches: set[int]) -> DataFrame:
    return _of_batches(spark, path, StructType([*schema.fields, StructField("batch", LongType()), StructField("bucket", IntegerType())]), batches)


def _known(wanted: DataFrame, path: str, schema: StructType, batches: set[int], buckets: int) -> DataFrame:
    """Rows of ``batches`` with a filing of ``wanted``; folders where none can lie are not read."""
    rows = _by_filing(wanted.sparkSession, path, schema, batches)
    if batches:
        rows = rows.where(F.col("bucket").isin(keyed_store.touched(wanted, ["filing_id"], buckets)))
    return rows.join(wanted.select("filing_id").distinct(), "filing_id", "left_semi").select(schema.names)


def _flags(jobs: DataFrame) -> DataFrame:
    """Per filing 1 or 0 for open and for failed jobs."""
    return jobs.groupBy("filing_id").agg(
        F.max(F.col("status").isin(*OPEN).cast("long")).alias("pending"), F.max((F.col("status") == "failed").cast("long")).alias("failed")
    )


def _counted(rows: DataFrame, **what: Column) -> DataFrame:
    """Rows of ``counts`` that add ``what``."""
    none = F.lit(None).cast(COUNTS["newest"].dataType)
    return rows.select("creditor_id", *(what.get(c, F.lit(0)).cast("long").alias(c) for c in SUMS), what.get("newest", none).alias("newest"))


def _turns(ties: DataFrame, flags: DataFrame) -> DataFrame:
    """Rows of ``counts``: the flags of the filings of each creditor's ties, added up by numbers alone, so the aggregation hashes."""
    sums = ties.join(flags, "filing_id").groupBy("creditor_id").agg(F.sum("pending").alias("pending"), F.sum("failed").alias("failed"))
    return _counted(sums, pending=F.col("pending"), failed=F.col("failed"))


def _newest_filing(entries: DataFrame) -> DataFrame:
    """Each creditor's filing of the latest date, of equal ones that with the largest id; date and id make one decimal, which hashes."""
    step, least = (F.lit(str(n)).cast("decimal(21,0)") for n in (10**20, 2**63))
    day = (F.coalesce(F.unix_date("created_on"), F.lit(-900_000)) + 1_000_000).cast("decimal(10,0)")
    rank = (day * step + (F.col("filing_id").cast("decimal(20,0)") + least)).cast("decimal(38,0)")
    newest = entries.groupBy("creditor_id").agg(F.max(rank).alias("_rank"))
    return newest.select("creditor_id", (F.col("_rank") % step - least).cast("long").alias("filing_id"))


def _write_inputs(spark: SparkSession, path: str, number: int, changes: dict[str, DataFrame], buckets: int, profile: str, job_type: str) -> None:
    """The batch as it is, typed, each row once: a source that is read again may not give the same."""
    plan = f"{path}/plan/{number}"
    put = lambda df, name: df.write.mode("overwrite").parquet(f"{plan}/{name}")
    none = lambda schema: spark.createDataFrame([], schema)

    def add(df: DataFrame, name: str) -> None:  # a large bucket is several files
        rows = df.withColumn("bucket", keyed_store.bucket(["filing_id"], buckets)).hint("rebalance", "bucket")
        rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/{name}/batch={number}")

    filings = _typed(changes["filings"], FILINGS).where("filing_id IS NOT NULL") if "filings" in changes else none(FILINGS)
    add(filings.dropDuplicates(["filing_id"]), "filings")
    creditors = none(CREDITORS)
    if "creditors" in changes:
        shown = F.coalesce(aggregates.is_shown(), F.lit(False)).alias("shown")
        creditors = _typed(aggregates.report_facts(changes["creditors"], profile, shown, F.col("source_filing_id")), CREDITORS)
    put(creditors.dropDuplicates(["creditor_id"]), "creditors")
    jobs = none(JOBS)
    if "jobs" in changes:
        jobs = _newest_status(_typed(changes["jobs"].where(F.col("job_type") == job_type), JOBS)).select(JOBS.names)
    put(jobs, "jobs")
    ties = spark.read.schema(CREDITORS).parquet(f"{plan}/creditors").select(F.col("source_filing_id").alias("filing_id"), "creditor_id").where("filing_id IS NOT NULL")
    if "links" in changes:
        ties = ties.union(_typed(changes["links"], TIES).where("filing_id IS NOT NULL AND creditor_id IS NOT NULL"))
    add(ties.distinct(), "ties")
    marks = none(COUNTS)
    for table, column in (("synced", "synced"), ("contacts", "enriched")):
        if table in changes:
            ids = changes[table].select(F.col("creditor_id").cast("long").alias("creditor_id"))
            marks = marks.union(_counted(ids, **{column: F.lit(1)}))
    put(_summed(marks), "marks")


def _write_plan(spark: SparkSession, path: str, number: int, earlier: set[int], buckets: int) -> None:
    """What the batch changes, from its inputs, the rows of ``earlier`` batches and the stores as they are."""
    plan = f"{path}/plan/{number}"
    got = lambda name, schema: spark.read.schema(schema).parquet(f"{plan}/{name}")
    came = lambda name, schema: _by_filing(spark, f"{path}/{name}", schema, {number}).select(schema.names)
    known = lambda wanted, name, schema: _known(wanted, f"{path}/{name}", schema, earlier, buckets)
    stored = lambda wanted, name, schema, key: keyed_store.lookup(wanted, f"{path}/{name}", schema, [key])
    entries = lambda batch: _of_batches(spark, f"{path}/entries", ENTRIES, {batch})
    filings, creditors, jobs, ties = came("filings", FILINGS), got("creditors", CREDITORS), got("jobs", JOBS), came("ties", TIES)

    open_ties = ties
    if earlier:  # what waits is part of what the last batch wrote
        waiting = entries(max(earlier)).where("month IS NULL AND NOT met").select(TIES.names)
        ties.union(waiting).distinct().write.mode("overwrite").parquet(f"{plan}/open")  # read several times
        open_ties = got("open", TIES)
    all_filings = known(open_ties, "filings", FILINGS).union(filings).dropDuplicates(["filing_id"])
    made = lambda df: df.select("creditor_id", "_made", "shown")
    all_creditors = made(stored(open_ties, "creditors", CREDITORS, "creditor_id")).union(made(creditors)).dropDuplicates(["creditor_id"])
    met = (
        open_ties.join(all_filings.withColumn("_filing", F.lit(True)), "filing_id", "left").join(all_creditors, "creditor_id", "left")
        .withColumn("met", F.coalesce("_filing", F.lit(False)) & F.col("shown").isNotNull()).withColumn("entered", F.greatest("created_on", "_made"))
        .withColumn("month", F.when(F.col("met") & F.col("shown"), F.trunc("entered", "month"))).select(*(c for c in ENTRIES.names if c != "batch"))
    )
    apart = F.when(F.col("month").isNull(), F.pmod("filing_id", F.lit(buckets)))  # rows without a month are dealt to several tasks, as a large month is
    months = met.withColumn("_apart", apart).hint("rebalance", "month", "_apart").drop("_apart").sortWithinPartitions("month", "entered")
    months.write.mode("overwrite").partitionBy("month").parquet(f"{path}/entries/batch={number}")

    old = stored(ties.select("filing_id").union(jobs.select("filing_id")), "jobs", JOBS, "filing_id")
    now = _flags(_newest_status(old.union(jobs)))
    was = _flags(old).select("filing_id", F.col("pending").alias("_pending"), F.col("failed").alias("_failed"))
    less = lambda c: F.col(c) - F.coalesce(f"_{c}", F.lit(0))
    turned = (
        now.join(jobs.select("filing_id").distinct(), "filing_id", "left_semi").join(was, "filing_id", "left")
        .select("filing_id", less("pending").alias("pending"), less("failed").alias("failed")).where("pending != 0 OR failed != 0")
    )
    turned.write.mode("overwrite").parquet(f"{plan}/turned")
    turned = spark.read.schema(turned.schema).parquet(f"{plan}/turned")
    _newest_filing(entries(number).where("met")).write.mode("overwrite").parquet(f"{plan}/newest")
    newest = got("newest", StructType([StructField("creditor_id", LongType()), StructField("filing_id", LongType())]))
    come = filings.join(newest.select("filing_id").distinct(), "filing_id", "left_semi")
    their = known(newest, "filings", FILINGS).union(come).dropDuplicates(["filing_id"])
    parts = (
        got("marks", COUNTS), _turns(ties, now), _turns(known(turned, "ties", TIES), turned),
        _counted(newest.join(their, "filing_id"), newest=F.struct("created_on", "filing_id", "state")),
    )
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.union(part)
    _summed(counts).write.mode("overwrite").parquet(f"{plan}/counts")


def apply(
    spark: SparkSession, path: str, number: int, changes: dict[str, DataFrame], buckets: int = 64,
    profile: str = aggregates.PROFILE, job_type: str = "company_lookup",
) -> None:
    """Bring batch ``number`` of changes into the reports under ``path``.

    ``changes`` holds new rows by table, of ``TABLES`` those that have any, with the columns that ``aggregates.report_rows`` and
    ``pipeline_status`` take; jobs have ``job_id`` and ``created_at``, and one that comes again has its newest status. Filings and creditors come
    once (repeats must be equal), ties and marks any number of times, all in any order; rows without an id are left out. Batches come with rising
    numbers, one at a time. One that stopped before its plan was noted has left nothing; one that stopped later is finished by the next call of any number.
    ``buckets`` counts when the reports are begun.
    """
    plans = f"{path}/plan"
    noted = keyed_store.notes(spark, plans).collect()  # two rows for each batch
    planned, done = ({r.number for r in noted if r.writer == w} for w in ("plan", "done"))
    buckets = next((r.buckets for r in noted if r.writer == "plan"), buckets)
    for earlier in planned - done:  # at most one
        _bring(spark, path, earlier, buckets)
    if number in planned:
        return
    if planned and number < max(planned):
        raise ValueError(f"batch {number} comes after batch {max(planned)}")
    _write_inputs(spark, path, number, changes, buckets, profile, job_type)
    _write_plan(spark, path, number, planned, buckets)
    keyed_store.note(spark, plans, "plan", number, buckets=buckets)
    _bring(spark, path, number, buckets)


def _bring(spark: SparkSession, path: str, number: int, buckets: int) -> None:
    for name, schema, key, combine in STORES:
        rows = spark.read.schema(schema).parquet(f"{path}/plan/{number}/{name}").where(F.col(key).isNotNull())
        keyed_store.merge(f"{path}/{name}", rows, [key], combine, "report", number, buckets)
    keyed_store.note(spark, f"{path}/plan", "done", number)


def follow(stream: DataFrame, path: str, **settings) -> None:
    """Bring all that a stream has now into the reports; its progress lies beside them, so a later call goes on.

    The stream has a struct column for each table that changes, named as the table and null in rows of the others.
    """

    def one(batch: DataFrame, number: int) -> None:
        changes = {t: batch.where(F.col(t).isNotNull()).select(f"{t}.*") for t in TABLES if t in batch.columns}
        apply(batch.sparkSession, path, number, changes, **settings)

    stream.writeStream.option("checkpointLocation", f"{path}/progress").foreachBatch(one).trigger(availableNow=True).start().awaitTermination()


def _staged(spark: SparkSession, path: str, labels: dict[str, str]) -> DataFrame:
    has = lambda c: F.coalesce(F.col(c), F.lit(0)) > 0
    status = (
        F.when(has("synced"), labels["synced"]).when(has("enriched"), labels["enriched"]).when(has("pending"), labels["pending"])
        .when(has("failed"), labels["failed"]).otherwise(labels["new"])
    )
    creditors = keyed_store.read(spark, f"{path}/creditors", CREDITORS)
    return creditors.join(keyed_store.read(spark, f"{path}/counts", COUNTS), "creditor_id", "left").withColumn("status", status)


def status(spark: SparkSession, path: str, labels: dict[str, str] = aggregates.STAGE_LABELS) -> DataFrame:
    """Each creditor's stage, as ``aggregates.pipeline_status`` finds it."""
    return _staged(spark, path, labels).select("creditor_id", "status")


def report_rows(spark: SparkSession, path: str, since: str, labels: dict[str, str] = aggregates.STAGE_LABELS) -> DataFrame:
    """``aggregates.report_rows`` from the folders of the window's months and one row for each creditor."""
    day = F.lit(since).cast("date")
    done = {r.number for r in keyed_store.notes(spark, f"{path}/plan").where("writer = 'done'").collect()}
    entries = _of_batches(spark, f"{path}/entries", ENTRIES, done)
    window = entries.where((F.col("month") >= F.trunc(day, "month")) & (F.col("entered") >= day)).select(ENTRIES.names[:6]).distinct()
    return window.join(_staged(spark, path, labels), "creditor_id").select(
        "creditor_id", "filing_id", "debtor_name", "case_number", "filing_date", *aggregates.report_columns(), "tier"
    )


def report_flat(spark: SparkSession, path: str, since: str, labels: dict[str, str] = aggregates.STAGE_LABELS) -> DataFrame:
    """``aggregates.report_flat`` from one row for each creditor; no tie or filing is read."""
    day = F.lit(since).cast("date")
    rows = _staged(spark, path, labels).where(F.col("shown") & ((F.col("_made") >= day) | (F.col("newest.created_on") >= day)))
    return rows.withColumn("state", F.col("newest.state")).select("creditor_id", *aggregates.report_columns())
