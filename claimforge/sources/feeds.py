"""Reading and checking claim feeds and imports."""

from __future__ import annotations

import csv
import io

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimforge.functions import money, places

# The feed's columns.
REQUIRED = ("Date Filed", "Impacted Business", "City", "State", "Case Number", "Corporate Bankruptcy", "Loss")


def _quotes(text: str) -> Column:
    return F.length(text) - F.length(F.translate(text, '"', ""))


def _headings(spark: SparkSession, path: str, first_lines: int = 1000) -> list[str]:
    """Up to two different first records of the files, from their first lines if all are whole there."""
    first = lambda records: records.where("record = 1").select("file", F.ltrim(F.col("text"), F.lit("\ufeff")).alias("text"))
    begun = first(csv_records(spark, path, first_lines)).select("text", (_quotes("text") % 2 == 1).alias("cut")).groupBy("text", "cut").agg(F.count("*").alias("n"))
    found = begun.limit(3).collect()
    n_files = len(spark.read.text(path).inputFiles())
    if len(found) > 2 or any(r.cut for r in found) or sum(r.n for r in found) < n_files:  # cut, blank or different ones
        return [r.text for r in first(csv_records(spark, path)).select("text").distinct().limit(2).collect()]
    return [r.text for r in found]


def csv_records(spark: SparkSession, path: str, first_lines: int | None = None) -> DataFrame:
    """The records of CSV files as text: ``file, record, text``, counted from 1 in each file without blank ones.

    Quoted values may span lines, yet a file is read by as many tasks as its size asks for. A line begins a record if the
    number of quotes before it in the file is even. Each byte range counts its quotes, and its records for either
    state at its beginning; the sums over the ranges before (a row for each) tell which of the two holds and how many records come
    before. Only records of several lines are put together from them. A quote that is never closed takes the rest of its file
    into one record. With ``first_lines`` only so many
    lines of each file's first byte range are taken, so the last record may be cut.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value"
    )
    if first_lines is not None:
        begin = lines.where("block = 0").groupBy("file").agg(F.min("at").alias("_begin"))
        lines = lines.join(F.broadcast(begin), "file").where((F.col("block") == 0) & (F.col("at") < F.col("_begin") + first_lines)).drop("_begin")
    quotes = _quotes("value")
    blank = F.translate("value", "\r\ufeff", "") == ""
    inside = Window.partitionBy("file", "block").orderBy("at")
    before = F.coalesce(F.sum("quotes").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    counted = lines.withColumns({"quotes": quotes, "blank": blank}).withColumn("odd", before == 1)
    ranges = counted.groupBy("file", "block").agg(
        F.sum("quotes").alias("quotes"), F.count_if(~F.col("odd") & ~F.col("blank")).alias("even_starts"), F.count_if(F.col("odd") & ~F.col("blank")).alias("odd_starts")
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("open", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == 1)
    ranges = ranges.withColumn("starts", F.when(F.col("open"), F.col("odd_starts")).otherwise(F.col("even_starts")))
    ranges = ranges.select("file", "block", "open", F.coalesce(F.sum("starts").over(earlier), F.lit(0)).alias("records"))
    placed = counted.join(ranges, ["file", "block"]).withColumn("start", F.col("odd") == F.col("open"))
    placed = placed.withColumn("goes_on", (F.col("quotes") % 2 == 1) == F.col("start")).where(~(F.col("start") & F.col("blank")))
    number = F.col("records") + F.sum(F.col("start").cast("int")).over(inside)
    placed = placed.select("file", number.cast("long").alias("record"), "block", "at", "value", (F.col("start") & ~F.col("goes_on")).alias("whole"))
    several = placed.where(~F.col("whole")).groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("block", "at", "value"))).alias("parts"))
    texts = placed.where("whole").select("file", "record", F.col("value").alias("text")).union(several.select("file", "record", F.array_join("parts.value", "\n")))
    return texts.withColumn("text", F.regexp_replace("text", r"\r$", ""))


def read_claim_feed(spark: SparkSession, path: str) -> DataFrame:
    """CSV files as text columns plus file and line number (the heading is line 1). A heading without a required column fails.

    The files have one heading; a large file is many tasks (see ``csv_records``).
    """
    records = csv_records(spark, path)
    heads = _headings(spark, path)
    columns = [c.strip() for c in next(csv.reader(io.StringIO(heads[0], newline="")))] if heads else []
    if missing := [c for c in REQUIRED if c not in columns]:
        raise ValueError(f"the feed lacks the columns {', '.join(missing)}")
    if len(heads) > 1:
        raise ValueError(f"the feed's files have different headings: {heads[0]!r}, {heads[1]!r}")
    kind = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    row = F.from_csv("text", ", ".join(f"`{c}` string" for c in columns), {"quote": '"', "escape": '"', "maxCharsPerColumn": "-1"})
    rows = records.where("record > 1").select("file", F.col("record").cast("int").alias("line_number"), row.cast(kind).alias("r"))
    return rows.select("r.*", "file", "line_number")


def validate_claims(rows: DataFrame) -> DataFrame:
    """Typed feed rows with the reason where one is rejected and a warning where its state is unusable."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    missing = F.concat_ws(",", F.array_compact(F.array(*(F.when(blank(c), c) for c in ("creditor", "case_number", "debtor", "filed")))))
    state = places.state_code(F.col("state"))
    return rows.select(
        *[c for c in rows.columns if c not in ("state", "loss")], state.alias("state"), money.loss_amount(F.col("loss")).alias("loss"),
        places.city_state(F.col("city"), state).alias("address"), F.nullif(missing, F.lit("")).alias("rejected_for"),
        F.when(~blank("state") & state.isNull(), "unusable state").alias("warning"),
    )


def keep_states(rows: DataFrame, states: list[str]) -> DataFrame:
    return rows.where(F.col("state").isin(*states)) if states else rows


def expand_import(rows: DataFrame, row_schema: str) -> DataFrame:
    """The rows of ``body.rows`` or ``body.body.rows`` of JSON texts; texts without any are returned with a null row."""
    shape = F.from_json("body", f"struct<rows:array<{row_schema}>,body:struct<rows:array<{row_schema}>>>")
    items = F.coalesce(shape["rows"], shape["body"]["rows"])
    return rows.select("import_id", F.explode_outer(F.when(F.size(items) > 0, items)).alias("row"))


def import_rejects(rows: DataFrame, row_schema: str) -> DataFrame:
    """The imports that :func:`expand_import` finds no rows in: ``import_id, rejected_for``."""
    empty = expand_import(rows, row_schema).where("row IS NULL").select("import_id").distinct()
    return empty.select("import_id", F.lit("no rows").alias("rejected_for"))


def discovered(rows: DataFrame, until: str) -> DataFrame:
    """Cases with a number and a date that is not in the future; chapter and title get defaults."""
    return rows.where((F.coalesce(F.trim("case_number"), F.lit("")) != "") & (F.col("filing_date") <= F.lit(until).cast("date"))).select(
        "filing_id", "case_number", "filing_date", F.coalesce(F.nullif("chapter", F.lit("unknown")), F.lit("11")).alias("chapter"),
        F.coalesce(F.nullif(F.trim("debtor_name"), F.lit("")), F.lit("Unknown Debtor")).alias("title"),
    )
