"""First-of-group choices, work lists and call audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The wording of a list of largest claims, and of papers that only mention one.
LARGEST = r"\b([0-9]+|twenty|thirty)\s+largest\b|\blargest\s+unsecured\b"
NO_LIST = (
    "motion", "order", "notice", "affidavit", "certificate", "declaration", "hearing", "agenda", "objection", "application",
    "stipulation", "response",
)


def poll_candidates(filings: DataFrame, checks: DataFrame, limit: int | None, targets: DataFrame | None = None) -> DataFrame:
    """Filings to poll next: never checked first, then longest unchecked. The limit is the feature; none, or one below 1, fails.

    With ``targets (state)`` only filings of those states.
    """
    if limit is None or limit < 1:
        raise ValueError("poll candidates need a limit of at least 1, given or configured")
    if targets is not None:
        filings = filings.join(targets.select("state").distinct(), "state", "left_semi")
    last = checks.groupBy("filing_id").agg(F.max("checked_on").alias("last_check"))
    return (
        filings.where(F.trim("case_number") != "").join(last, "filing_id", "left")
        .orderBy(F.asc_nulls_first("last_check"), "created_on", "filing_id").limit(limit)
    )


def pick_document(docs: DataFrame) -> DataFrame:
    """Per filing the lowest document number, then the fewest pages; what is missing or bad comes last."""
    number = F.split_part("document_number", F.lit("."), F.lit(1)).try_cast("int")
    pages = F.when(F.col("page_count") > 0, F.col("page_count"))
    far = F.lit(2**31 - 1)
    # Both ranks make one number, and with the id (not negative) a decimal of 125 bits: the aggregation hashes and never sorts.
    both = F.coalesce(F.when(number > 0, number), far).cast("long") * F.lit(2**31) + F.coalesce(pages, far).cast("long")
    step = F.lit(str(2**63)).cast("decimal(19,0)")
    least = docs.groupBy("filing_id").agg(F.min((both.cast("decimal(19,0)") * step + F.col("document_id").cast("decimal(19,0)")).cast("decimal(38,0)")).alias("r"))
    document = (F.col("r") % step).cast("long")
    ranks = F.col("r").cast("decimal(38,0)") - document.cast("decimal(19,0)")
    pair = F.round(ranks / step).cast("long")
    return least.select(
        "filing_id", document.alias("document_id"), F.shiftright(pair, 31).cast("int").alias("number_rank"), pair.bitwiseAND(F.lit(2**31 - 1)).cast("int").alias("page_rank")
    )


def document_candidates(docs: DataFrame) -> DataFrame:
    """Documents that may be a list of the largest claims: wording, no motion or notice, and at hand."""
    text = F.lower("description")
    return docs.where(
        text.rlike(LARGEST) & ~text.rlike(rf"\b({'|'.join(NO_LIST)})\b")
        & F.col("is_available") & (F.coalesce("path", F.lit("")) != "")
    )


def handoff(docs: DataFrame, queue: DataFrame) -> DataFrame:
    """The latest document of each filing beside its latest queue entry ``(filing_id, queue_id, created_at)``."""
    last = queue.groupBy("filing_id").agg(F.max_by("queue_id", F.struct("created_at", "queue_id")).alias("queue_id"))
    return latest_document(docs).join(last, "filing_id", "full")


def latest_document(docs: DataFrame) -> DataFrame:
    able = docs.where(F.coalesce(F.trim("path"), F.lit("")) != "")
    rank = F.struct("filed_on", "document_id", "source_id")
    return able.groupBy("filing_id").agg(F.max_by("path", rank).alias("path"), F.max("filed_on").alias("filed_on"))


def best_candidates(
    candidates: DataFrame, creditors: DataFrame, geo_bonus: float = 0.5, least_lead: float = 0.05, failures: DataFrame | None = None
) -> DataFrame:
    """The best company per creditor: confidence plus a bonus for the state; a small lead is ambiguous.

    ``failures (creditor_id, http_status)`` are lookups that failed: 429 makes the status
    ``rate_limited``, any other ``error``; such a creditor has no company.
    """
    state = F.upper(F.left(F.coalesce("home_state", F.lit("")), F.lit(2)))
    here = (state != "") & F.contains(F.upper(F.coalesce("headquarters", F.lit(""))), state)
    score = F.coalesce("confidence", F.lit(0.5)) + F.when(here, geo_bonus).otherwise(0.0)
    scored = candidates.join(creditors.select("creditor_id", "home_state"), "creditor_id").withColumn("score", score)
    w = Window.partitionBy("creditor_id").orderBy(F.desc("score"), "place", "candidate_id", "name_key")
    ranked = scored.withColumn("k", F.row_number().over(w)).withColumn("second", F.lead("score").over(w)).where("k = 1")
    close = F.coalesce(F.col("score") - F.col("second") < least_lead, F.lit(False))
    best = ranked.select(
        "creditor_id", F.when(close, "ambiguous").otherwise("matched").alias("match_status"),
        F.when(~close, F.col("candidate_id")).alias("company_id"), F.round("score", 6).alias("score"),
    )
    out = creditors.select("creditor_id").join(best, "creditor_id", "left").withColumn("match_status", F.coalesce("match_status", F.lit("no_match")))
    if failures is None:
        return out
    bad = failures.groupBy("creditor_id").agg(F.when(F.bool_or(F.col("http_status") == 429), "rate_limited").otherwise("error").alias("_bad"))
    none = lambda c: F.when(F.col("_bad").isNull(), F.col(c)).alias(c)
    return out.join(bad, "creditor_id", "left").select("creditor_id", F.coalesce("_bad", "match_status").alias("match_status"), none("company_id"), none("score"))


def top_contacts(contacts: DataFrame, k: int = 3) -> DataFrame:
    named = contacts.where(F.coalesce(F.trim("full_name"), F.lit("")) != "")
    w = Window.partitionBy("creditor_id").orderBy(F.desc_nulls_last("engagement"), "contact_id")
    return named.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def contact_outcomes(lookups: DataFrame, saved: DataFrame) -> DataFrame:
    """Each lookup ``creditor_id, match_status, http_status`` with its saved contacts; a match without one found no contact."""
    n = saved.groupBy("creditor_id").agg(F.count("*").alias("_n"))
    count = F.coalesce("_n", F.lit(0))
    status = F.when(F.col("http_status") == 429, "rate_limited").when((count == 0) & (F.col("match_status") == "matched"), "no_contact_found").otherwise(F.col("match_status"))
    return lookups.join(n, "creditor_id", "left").select("creditor_id", status.alias("match_status"), count.cast("int").alias("contacts_saved"))


def claimable_jobs(jobs: DataFrame) -> DataFrame:
    """The oldest queued job of each type whose filing has no running one of the type."""
    running = jobs.where("status = 'running'").select("filing_id", "job_type").distinct()
    return (
        jobs.where("status = 'queued'").join(running, ["filing_id", "job_type"], "left_anti")
        .groupBy("job_type").agg(F.min_by("job_id", F.struct("created_at", "job_id")).alias("job_id"))
    )


def enqueueable(wanted: DataFrame, jobs: DataFrame) -> DataFrame:
    """Wanted pairs of filing and job type that have no queued or running job, each once."""
    open_ = jobs.where(F.col("status").isin("queued", "running")).select("filing_id", "job_type")
    return wanted.select("filing_id", "job_type").distinct().join(open_, ["filing_id", "job_type"], "left_anti")


def fail_stale(jobs: DataFrame, now: str, hours: int = 24) -> DataFrame:
    old = F.col("status").isin("queued", "running") & (F.col("created_at") < F.lit(now).cast("timestamp") - F.make_dt_interval(hours=F.lit(hours)))
    return jobs.withColumn("message", F.when(old, F.coalesce("message", F.lit("stale job"))).otherwise(F.col("message"))).withColumn(
        "status", F.when(old, "failed").otherwise(F.col("status"))
    )


def drain_order(jobs: DataFrame, kinds: tuple[str, ...] = ("document_parse", "company_lookup", "account_push")) -> DataFrame:
    """Queued jobs by kind, in the order of ``kinds``, then by age."""
    rank = F.array_position(F.array(*map(F.lit, kinds)), F.col("job_type"))
    return jobs.where((F.col("status") == "queued") & F.col("job_type").isin(*kinds)).withColumn("rank", rank).orderBy("rank", "created_at", "job_id")


def budgeted(rows: DataFrame, budget: int, cost: str = "cost", order: str = "filed_on", key: str = "filing_id") -> DataFrame:
    """Oldest first while the running cost fits ``budget``; the rest is ``unattempted``.

    Days are summed first, so the running sum over everything has one row per day;
    within a day it is a window by day.
    """
    days = rows.groupBy(order).agg(F.sum(cost).alias("_day"))
    before = F.sum("_day").over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    days = days.select(order, F.coalesce(before, F.lit(0)).alias("_before"))
    within = F.sum(cost).over(Window.partitionBy(order).orderBy(key).rowsBetween(Window.unboundedPreceding, 0))
    upto = F.col("_before") + within
    return (
        rows.join(days, order).withColumn("running_cost", upto.cast("long"))
        .withColumn("outcome", F.when(F.col("running_cost") <= budget, "attempted").otherwise("unattempted")).drop("_before")
    )


def call_audit(calls: DataFrame, per_minute: int = 5, per_hour: int = 50, gap_seconds: int = 15) -> DataFrame:
    """Calls in the trailing minute and hour and the gap before each, against the limits.

    The windows are those of an account and hour, with the calls of the hour before beside them, so a busy
    account is many tasks. Only the last call of each hour is ordered by account, for the gaps after empty hours.
    """
    span = 3_600_000_000
    own = calls.select("call_id", "account", F.unix_micros("called_at").alias("us")).withColumn("hour", F.floor(F.col("us") / span))
    last = own.groupBy("account", "hour").agg(F.max("us").alias("end"))
    before = last.select("account", "hour", F.lag("end").over(Window.partitionBy("account").orderBy("hour")).alias("before"))
    copies = own.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("later")).withColumn("hour", F.col("hour") + F.col("later"))
    w = Window.partitionBy("account", "hour").orderBy("us")
    minute, hour = w.rangeBetween(-59_999_999, 0), w.rangeBetween(-span + 1, 0)
    order = Window.partitionBy("account", "hour").orderBy("us", "call_id")
    counted = copies.select(
        "call_id", "account", "hour", "later", "us", F.count("*").over(minute).alias("last_minute"), F.count("*").over(hour).alias("last_hour"), F.lag("us").over(order).alias("near")
    ).where("later = 0")
    out = counted.join(before, ["account", "hour"]).select("call_id", "account", "last_minute", "last_hour", (F.col("us") - F.coalesce("near", "before")).alias("gap_us"))
    bad = (F.col("last_minute") > per_minute) | (F.col("last_hour") > per_hour) | F.coalesce(F.col("gap_us") < gap_seconds * 1_000_000, F.lit(False))
    return out.withColumn("violates", bad)


def review_page(reviews: DataFrame, status: str, limit: int, offset: int) -> DataFrame:
    """One page of a queue, newest first, with the total. Limit and offset are the feature."""
    able = reviews.where(F.col("status") == status)
    total = able.agg(F.count("*").alias("total"))
    return able.orderBy(F.desc("created_at"), F.desc("job_id")).offset(offset).limit(limit).crossJoin(F.broadcast(total))
