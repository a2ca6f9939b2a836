"""Filters and joins over filings, creditors, courts and accounts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimforge.functions import names, places


def creditor_filing_links(creditors: DataFrame, links: DataFrame) -> DataFrame:
    """Both ways in which a creditor is tied to a filing, each pair once."""
    return both_links(creditors, links).distinct()


def both_links(creditors: DataFrame, links: DataFrame) -> DataFrame:
    """The same where pairs may come twice, for uses on which that has no effect."""
    own = creditors.where("source_filing_id IS NOT NULL").select("creditor_id", F.col("source_filing_id").alias("filing_id"))
    direct = links.join(creditors.select("creditor_id"), "creditor_id").select("creditor_id", "filing_id")
    return direct.union(own)


def active_target_states(states: DataFrame, override: list[str] | None = None) -> DataFrame:
    rows = (
        states.sparkSession.createDataFrame([(s,) for s in override], "state string") if override else states.where("active").select("state")
    )
    return rows.select(F.upper(F.left(F.trim("state"), F.lit(2))).alias("state")).where(F.length("state") >= 2).distinct()


def with_target_flag(rows: DataFrame, targets: DataFrame, state: str = "state") -> DataFrame:
    """Adds ``is_target``. The target table is a dimension of at most a few hundred codes."""
    marks = targets.select(F.col("state").alias("_target"), F.lit(True).alias("_hit")).distinct()
    return (
        rows.join(marks, F.upper(F.left(F.trim(state), F.lit(2))) == F.col("_target"), "left")
        .withColumn("is_target", F.coalesce("_hit", F.lit(False))).drop("_target", "_hit")
    )


def court_states(rows: DataFrame, courts: DataFrame) -> DataFrame:
    """Rows with the state of their court; those without an active court are left out."""
    known = courts.where("active").select(F.col("court_id").alias("_court"), F.col("state").alias("court_state"))
    return rows.join(known, F.lower(F.trim("court_id")) == F.col("_court")).drop("_court")


def resolve_courts(rows: DataFrame, courts: DataFrame, targets: DataFrame) -> DataFrame:
    """Every row with its court's state and, where it must be skipped, the reason."""
    known = courts.where("active").select(F.col("court_id").alias("_court"), F.col("state").alias("court_state"))
    joined = rows.join(known, F.lower(F.trim("court_id")) == F.col("_court"), "left").drop("_court")
    blank = F.coalesce(F.trim("court_id"), F.lit("")) == ""
    reason = F.when(blank, "missing_court_id").when(F.col("court_state").isNull(), "unknown_court")
    return with_target_flag(joined.withColumn("skip_reason", reason), targets, "court_state")


def territory_reps(rows: DataFrame, territories: DataFrame, state: str, default: str = "rep_default") -> DataFrame:
    known = territories.select(F.upper("state").alias("_state"), F.col("rep").alias("_rep"))
    return (
        rows.where(F.coalesce(F.trim(state), F.lit("")) != "").join(known, F.upper(F.trim(state)) == F.col("_state"), "left")
        .withColumn("rep", F.coalesce("_rep", F.lit(default))).drop("_state", "_rep")
    )


def latest_filing(links: DataFrame, filings: DataFrame) -> DataFrame:
    """Each creditor's newest filing; of equal dates the larger id, an unknown date is oldest.

    Date and id (not negative) make one decimal, so the aggregation hashes and never sorts.
    """
    step = F.lit(str(10**19)).cast("decimal(20,0)")
    day = (F.coalesce(F.unix_date("created_on"), F.lit(-900_000)) + 1_000_000).cast("decimal(12,0)")
    newest = (
        links.join(filings.select("filing_id", (day * step + F.col("filing_id").cast("decimal(20,0)")).cast("decimal(38,0)").alias("_rank")), "filing_id")
        .groupBy("creditor_id").agg(F.max("_rank").alias("_rank")).select("creditor_id", (F.col("_rank") % step).cast("long").alias("filing_id"))
    )
    return newest.join(filings.select("filing_id", "created_on", "state"), "filing_id").select("creditor_id", "filing_id", "created_on", "state")


def company_creditors(creditors: DataFrame, links: DataFrame, filings: DataFrame) -> DataFrame:
    """Linked companies with a usable name, their state and comparable name."""
    able = creditors.where(F.col("is_company") & ~names.is_junk_name(F.col("name")))
    return (
        able.join(links, "creditor_id").join(filings.select("filing_id", F.col("state").alias("_state")), "filing_id")
        .select(
            "filing_id", "creditor_id", "name", "claim_amount",
            places.address_state(F.col("address"), F.col("_state")).alias("creditor_state"),
            names.company_name(F.col("name")).alias("normalized_name"),
        )
    )


def match_accounts(creditors: DataFrame, accounts: DataFrame) -> DataFrame:
    """Creditors against accounts: comparable name first, then the name as it is.

    One account of a name is reused; of several, the only one in the creditor's state;
    else the next name is tried. ``action`` is reuse, review or create.
    """
    tries = creditors.select(
        "creditor_id", F.upper(F.trim("state")).alias("_state"), F.lower("normalized_name").alias("a"), F.lower("name").alias("b")
    ).select(
        "creditor_id", "_state",
        F.posexplode(F.when(F.col("a") == F.col("b"), F.array("a")).otherwise(F.array("a", "b"))).alias("place", "key"),
    )
    sides = accounts.select(F.lower("account_name").alias("key"), "account_id", F.upper(F.trim("billing_state")).alias("_billing"))
    hits = (
        tries.join(sides, "key").groupBy("creditor_id", "place")
        .agg(
            F.count("*").alias("n"), F.min("account_id").alias("one"),
            F.count_if(F.col("_state") == F.col("_billing")).alias("n_state"),
            F.min(F.when(F.col("_state") == F.col("_billing"), F.col("account_id"))).alias("one_state"),
        )
    )
    clear = F.when(F.col("n") == 1, F.col("one")).when(F.col("n_state") == 1, F.col("one_state"))
    best = hits.groupBy("creditor_id").agg(
        F.min_by(clear, F.when(clear.isNotNull(), F.col("place"))).alias("account_id"), F.max("n").alias("most")
    )
    action = F.when(F.col("account_id").isNotNull(), "reuse").when(F.col("most") > 1, "review").otherwise("create")
    return creditors.select("creditor_id").join(best, "creditor_id", "left").select("creditor_id", action.alias("action"), "account_id")


def collapse_accounts(matches: DataFrame, order: str = "creditor_id") -> DataFrame:
    """Of one filing's creditors that resolve to one account, the first stays and the others are duplicates."""
    w = Window.partitionBy("filing_id", "account_id").orderBy(order)
    return matches.withColumn("is_duplicate", F.col("account_id").isNotNull() & (F.row_number().over(w) > 1))


def match_debtors(filings: DataFrame, crm: DataFrame) -> DataFrame:
    """By case number, else the only row of the debtor's name without a case, else create."""
    by_case = crm.where("case_number IS NOT NULL").groupBy("case_number").agg(F.min("crm_id").alias("_case"))
    by_name = (
        crm.where("case_number IS NULL").groupBy("debtor_name").agg(F.min("crm_id").alias("_name"), F.count("*").alias("_n"))
    )
    return (
        filings.join(by_case, "case_number", "left").join(by_name, "debtor_name", "left")
        .withColumn("crm_id", F.coalesce("_case", F.when(F.col("_n") == 1, F.col("_name"))))
        .withColumn("action", F.when(F.col("_case").isNotNull(), "case").when(F.col("crm_id").isNotNull(), "name").otherwise("create"))
        .drop("_case", "_name", "_n")
    )


def recency(accounts: DataFrame, deals: DataFrame, touches: DataFrame, as_of: str, days: int = 90) -> DataFrame:
    """Existing where an open deal or a touch within ``days`` before ``as_of`` exists, else New."""
    active = (
        deals.where("is_open").select("account_id")
        .union(touches.where(F.col("on") >= F.date_sub(F.lit(as_of).cast("date"), days)).select("account_id")).distinct()
        .withColumn("_hit", F.lit(True))
    )
    status = F.when(F.col("_hit"), "Existing").otherwise("New")
    return accounts.join(active, "account_id", "left").withColumn("recency", status).drop("_hit")


def relink_documents(docs: DataFrame, reviews: DataFrame, filings: DataFrame) -> DataFrame:
    """Documents without a filing: the review's filing first, else the case number in the path; else skipped."""
    case = places.found(F.col("path"), r"([0-9]{2}-bk-[0-9]+)")
    by_case = filings.select(F.col("case_number").alias("_case"), F.col("filing_id").alias("_path_filing"))
    by_review = reviews.groupBy("doc_id").agg(F.min("filing_id").alias("_review_filing"))
    return (
        docs.where("linked_filing IS NULL").join(by_review, "doc_id", "left").join(by_case, case == F.col("_case"), "left")
        .select(
            "doc_id", F.coalesce("_review_filing", "_path_filing").alias("filing_id"),
            F.when(F.col("_review_filing").isNotNull(), "review").when(F.col("_path_filing").isNotNull(), "path").otherwise("skipped").alias("source"),
        )
    )


def docket_by_debtor(filings: DataFrame, dockets: DataFrame) -> DataFrame:
    """Among a case's dockets the first whose name holds the debtor's, else the first."""
    holds = F.contains(names.company_name(F.col("docket_name")), names.company_name(F.col("debtor_name")))
    rank = F.struct((~holds).alias("other"), F.col("place"), F.col("docket_id"))
    return (
        filings.join(dockets, "case_number").groupBy("filing_id")
        .agg(F.min_by("docket_id", rank).alias("docket_id"), F.max(holds).alias("by_name"))
    )
