"""State between runs: date watermarks, ledgers of known misses, completeness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def next_window(config: DataFrame, today: str, first_days: int = 7, overlap_days: int = 3) -> DataFrame:
    """From the stored date, or ``first_days`` ago; queries reach back ``overlap_days`` more."""
    last = F.to_date(F.try_to_timestamp(F.max(F.when(F.col("key") == "last_date", F.col("value")))))
    since = F.coalesce(last, F.date_sub(F.lit(today).cast("date"), first_days))
    return config.agg(since.alias("since")).select("since", F.date_sub("since", overlap_days).alias("query_from"))


def advance(runs: DataFrame) -> DataFrame:
    """The date moves only if all pages came, nothing was left for want of budget and nothing failed to store."""
    ok = F.bool_and(F.col("complete")) & ~F.bool_or(F.col("out_of_budget")) & (F.sum("errors") == 0)
    return runs.groupBy("run_id").agg(ok.alias("advance"), F.when(ok, F.max("until")).otherwise(F.min("since")).alias("last_date"))


def skip_known_misses(cases: DataFrame, ledger: DataFrame, today: str, most: int = 2) -> DataFrame:
    """Cases without those that were missed ``most`` times or already today."""
    skip = ledger.where((F.coalesce(F.try_to_number("attempts", F.lit("999")), F.lit(0)) >= most) | (F.col("last_date") == F.lit(today).cast("date")))
    return cases.join(skip.select("case_number"), "case_number", "left_anti")


def record_misses(ledger: DataFrame, misses: DataFrame, today: str) -> DataFrame:
    """One attempt more for each missed case; the filing date stays."""
    new = misses.groupBy("case_number").agg(F.min("filed").alias("_filed"))
    joined = ledger.join(new, "case_number", "full")
    missed = F.col("_filed").isNotNull()
    attempts = F.coalesce(F.col("attempts").cast("int"), F.lit(0)) + missed.cast("int")
    return joined.select(
        "case_number", F.coalesce("filed", "_filed").alias("filed"), attempts.alias("attempts"),
        F.when(missed, F.lit(today).cast("date")).otherwise(F.col("last_date")).alias("last_date"),
    )


def prune_ledger(ledger: DataFrame, today: str, days: int = 45, most: int = 5000) -> DataFrame:
    """Drop old entries and keep the newest ``most``; that number is the feature."""
    when = F.coalesce("filed", "last_date")
    return ledger.where(when >= F.date_sub(F.lit(today).cast("date"), days)).orderBy(when.desc(), "case_number").limit(most)


def typed_config(rows: DataFrame, spec: dict[str, tuple[str, object]]) -> DataFrame:
    """Key and value rows as one typed row: text, int or bool, with defaults for what is blank or bad."""
    out = []
    for key, (kind, default) in spec.items():
        raw = F.nullif(F.trim(F.max(F.when(F.col("key") == key, F.col("value")))), F.lit(""))
        value = {"text": raw, "int": raw.try_cast("int"), "bool": F.lower(raw).isin("true", "1", "yes")}[kind]
        out.append(F.coalesce(value, F.lit(default)).alias(key))
    return rows.agg(*out)


def intake_result(rows: DataFrame, by: str) -> DataFrame:
    actions = ("uploaded", "skipped", "known_missing", "unattempted")
    return rows.groupBy(by).agg(F.count("*").alias("found"), *(F.count_if(F.col("action") == a).alias(a) for a in actions))


def complete_windows(fetches: DataFrame, most_pages: int) -> DataFrame:
    """A window is incomplete when a page failed or pages were left beyond the limit."""
    bad = F.bool_or(F.col("failed")) | F.bool_or((F.col("page") >= most_pages) & F.col("has_next"))
    return fetches.groupBy("window_id").agg((~bad).alias("complete"), F.count("*").alias("n_pages"))
