"""Grouped claims, exposure, reports and outcome counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimforge.functions import money, names, places
from claimforge.operators import linking

MONEY = "decimal(15,2)"


def combine_claims(rows: DataFrame) -> DataFrame:
    """Feed rows of one case and creditor as one: amounts summed (all null: null), first name and address kept."""
    line = F.struct("line_number", "part_id")
    address = F.nullif(F.trim("address"), F.lit(""))
    return rows.groupBy("case_number", F.lower(F.trim("creditor")).alias("creditor_key")).agg(
        F.min_by("creditor", line).alias("creditor"),
        F.min_by(address, F.when(address.isNotNull(), line)).alias("address"),
        F.sum("loss").cast(MONEY).alias("claim_amount"),
        F.sort_array(F.collect_list("line_number")).alias("line_numbers"),
        F.count("*").alias("n_rows"),
    )


def case_groups(rows: DataFrame) -> DataFrame:
    line = F.struct("line_number", "part_id", "filed", "debtor")
    return rows.groupBy("case_number").agg(
        F.min_by("debtor", line).alias("debtor"), F.min_by("filed", line).alias("filed"),
        F.countDistinct(F.lower(F.trim("creditor"))).alias("n_creditors"),
    )


def exposure(links: DataFrame, creditors: DataFrame, filings: DataFrame) -> DataFrame:
    """Filings and claims per creditor. The creditor's claim counts once for each filing, as a stored total would."""
    joined = links.join(creditors.select("creditor_id", "claim_amount"), "creditor_id").join(
        filings.select("filing_id", "filing_date"), "filing_id"
    )
    return joined.groupBy("creditor_id").agg(
        F.count("*").alias("filing_count"), F.coalesce(F.sum("claim_amount"), F.lit(0)).cast(MONEY).alias("total_claims"),
        F.min("filing_date").alias("first_seen"), F.max("filing_date").alias("last_seen"),
    )


def exposure_by_filing(claims: DataFrame) -> DataFrame:
    """The variant without double counting: amounts claimed in each filing."""
    return claims.groupBy("creditor_id").agg(
        F.countDistinct("filing_id").alias("filing_count"), F.sum("amount").cast(MONEY).alias("total_claims")
    )


def repeat_exposure(links: DataFrame, creditors: DataFrame, filings: DataFrame, as_of: str, threshold: int = 4, months: int = 18) -> DataFrame:
    cutoff = F.add_months(F.lit(as_of).cast("date"), -months)
    recent = filings.where(F.col("filing_date") >= cutoff).select("filing_id")
    counts = (
        links.join(recent, "filing_id").join(creditors.select("creditor_id", "claim_amount"), "creditor_id").groupBy("creditor_id")
        .agg(F.count("*").alias("n"), F.coalesce(F.sum("claim_amount"), F.lit(0)).cast(MONEY).alias("total"))
    )
    every = creditors.select("creditor_id").join(counts, "creditor_id", "left")
    n, total = F.coalesce("n", F.lit(0)), F.coalesce("total", F.lit(0).cast(MONEY))
    text = F.concat(
        F.lit("Repeat exposure: "), n.cast("string"), F.lit(" filings since "), cutoff.cast("string"), F.lit(" totaling $"),
        F.format_number(total, 2), F.lit(" — use alternate messaging"),
    )
    return every.select("creditor_id", (n >= threshold).alias("is_repeat"), n.alias("filing_count"), total.alias("total_claims"), text.alias("message"))


STAGE_LABELS = {"synced": "Synced", "enriched": "Enriched", "pending": "Pending Enrichment", "failed": "Enrichment Failed", "new": "New"}


def pipeline_status(
    creditors: DataFrame, links: DataFrame, jobs: DataFrame, synced: DataFrame, contacts: DataFrame, job_type: str = "company_lookup", labels: dict[str, str] = STAGE_LABELS
) -> DataFrame:
    """Each creditor's stage: synced, enriched, pending, failed or new. Every side is aggregated to its key first.

    ``job_type`` is that of the jobs that look a creditor up, ``labels`` name the stages.
    """
    flags = jobs.where(F.col("job_type") == job_type).groupBy("filing_id").agg(
        F.bool_or(F.col("status").isin("queued", "running", "retrying")).alias("pending"), F.bool_or(F.col("status") == "failed").alias("failed")
    )
    by_creditor = (
        linking.both_links(creditors, links).join(flags, "filing_id")  # pairs that come twice change no flag
        .groupBy("creditor_id").agg(F.bool_or("pending").alias("pending"), F.bool_or("failed").alias("failed"))
    )
    mark = lambda df, c: df.select("creditor_id").distinct().withColumn(c, F.lit(True))
    joined = (
        creditors.select("creditor_id").join(mark(synced, "synced"), "creditor_id", "left")
        .join(mark(contacts, "enriched"), "creditor_id", "left").join(by_creditor, "creditor_id", "left")
    )
    status = (
        F.when(F.col("synced"), labels["synced"]).when(F.col("enriched"), labels["enriched"]).when(F.col("pending"), labels["pending"])
        .when(F.col("failed"), labels["failed"]).otherwise(labels["new"])
    )
    return joined.select("creditor_id", status.alias("status"))


PROFILE = "https://example.org/company/{id}/overview"


def is_shown() -> Column:
    """Whether reports show a creditor."""
    return F.col("is_company") & ~names.is_junk_name(F.col("name"))


def report_facts(creditors: DataFrame, profile: str, *more: Column) -> DataFrame:
    """All that a creditor alone decides of its report row: texts are parsed once for each, not for each of its filings."""
    return creditors.select(
        "creditor_id", names.shown_name(F.col("original_name"), F.col("name")).alias("creditor"), places.address_city(F.col("address")).alias("city"),
        places.found(F.col("address"), places.ADDRESS_STATE).alias("_home"), money.dollars(F.col("claim_amount")).alias("claim"),
        places.filled_template(F.col("company_id"), profile).alias("profile_url"), F.col("company_tier").alias("tier"), F.col("created_on").alias("_made"),
        *more,
    )


def _report_creditors(creditors: DataFrame, profile: str) -> DataFrame:
    return report_facts(creditors.where(is_shown()), profile)


def report_columns() -> list[Column | str]:
    state = F.upper(F.coalesce("_home", F.nullif(F.trim("state"), F.lit("")))).alias("state")
    return ["creditor", "city", state, "claim", "status", "profile_url"]


def _pairs(creditors: DataFrame, links: DataFrame) -> DataFrame:
    """Creditors and filings by either tie; a pair may come twice, and a creditor need not exist."""
    own = creditors.where("source_filing_id IS NOT NULL").select("creditor_id", F.col("source_filing_id").alias("filing_id"))
    return links.select("creditor_id", "filing_id").union(own)


def report_rows(creditors: DataFrame, links: DataFrame, filings: DataFrame, status: DataFrame, since: str, profile: str = PROFILE) -> DataFrame:
    """One row per company creditor and filing, if either was created since ``since``.

    New filings with all their creditors, and new creditors with their older filings, are found apart, so each
    date is a filter of its table's scan and no table is joined whole with another.
    """
    day = F.lit(since).cast("date")
    shown, pairs = _report_creditors(creditors, profile), _pairs(creditors, links)
    filings = filings.select("filing_id", "debtor_name", "case_number", "filing_date", "state", "created_on")
    of_new_filings = pairs.join(filings.where(F.col("created_on") >= day), "filing_id")
    new = shown.where(F.col("_made") >= day).select("creditor_id")
    of_new_creditors = pairs.join(new, "creditor_id", "left_semi").join(filings.where(F.coalesce(F.col("created_on") < day, F.lit(True))), "filing_id")
    joined = of_new_filings.unionByName(of_new_creditors).distinct().join(shown, "creditor_id").join(status, "creditor_id")
    return joined.select("creditor_id", "filing_id", "debtor_name", "case_number", "filing_date", *report_columns(), "tier")


def report_flat(creditors: DataFrame, links: DataFrame, filings: DataFrame, status: DataFrame, since: str, profile: str = PROFILE) -> DataFrame:
    """One row per company creditor, with the state of its newest filing; creditors without filings too.

    A creditor with a new filing has its newest among those; only for new creditors are older ones looked through.
    """
    day = F.lit(since).cast("date")
    shown, pairs = _report_creditors(creditors, profile), _pairs(creditors, links)
    recent = linking.latest_filing(pairs, filings.where(F.col("created_on") >= day)).select("creditor_id", "state")
    new = shown.where(F.col("_made") >= day).select("creditor_id").join(recent, "creditor_id", "left_anti")
    older = linking.latest_filing(pairs.join(new, "creditor_id", "left_semi"), filings).select("creditor_id", "state")
    some = new.join(older, "creditor_id", "left").select("creditor_id", "state").union(recent)
    return shown.join(some, "creditor_id").join(status, "creditor_id").select("creditor_id", *report_columns())


def report_envelope(rows: DataFrame) -> DataFrame:
    return rows.agg(F.countDistinct("filing_id").alias("debtor_count"), F.countDistinct("creditor_id").alias("creditor_count"))


def report_messages(rows: DataFrame, most: int = 40) -> DataFrame:
    """Report rows as text: a block per debtor, newest filing first, claims high to low.

    Up to ``most`` creditors in all give one message, more give a header and one
    message per debtor. Ties keep the order of debtor and creditor.
    """
    line = F.concat(
        F.lit("• "), F.col("creditor"), F.lit(" | "), F.concat_ws(", ", "city", "state"), F.lit(" | "), F.col("claim"), F.lit(" | "),
        F.coalesce(F.element_at(F.create_map(*(F.lit(x) for t in money.TIERS for x in t[:2])), F.col("tier")), F.lit("—")), F.lit(" | "), F.col("status"),
    )
    key = F.struct(
        (-money.sort_amount(F.col("claim"))).alias("a"), F.col("creditor").alias("b"), F.col("creditor_id").alias("c"), line.alias("line")
    )
    blocks = rows.groupBy("debtor_name", "case_number", "filing_date").agg(
        F.count("*").alias("n"), F.sort_array(F.collect_list(key)).alias("lines")
    )
    plural = lambda n, word: F.concat(n.cast("string"), F.lit(f" {word}"), F.when(n == 1, "").otherwise("s"))
    head = F.concat(F.col("debtor_name"), F.lit(" ("), F.col("case_number"), F.lit("), filed "), F.col("filing_date").cast("string"), F.lit(": "), plural(F.col("n"), "creditor"))
    texts = blocks.select(
        "debtor_name", "case_number", "filing_date", "n",
        F.concat(head, F.lit("\n"), F.concat_ws("\n", F.transform("lines", lambda x: x.line))).alias("text"),
    )
    total = rows.agg(F.count("*").alias("total"), F.countDistinct("case_number").alias("debtors"))
    title = F.concat(plural(F.col("debtors"), "debtor"), F.lit(", "), plural(F.col("total"), "creditor"))
    both = texts.crossJoin(F.broadcast(total))  # one row of totals
    order = F.struct((-F.unix_date("filing_date")).alias("a"), F.col("debtor_name").alias("b"), F.col("case_number").alias("c"), F.col("text").alias("text"))
    one = (
        both.where(F.col("total") <= most).groupBy("total", "debtors").agg(F.sort_array(F.collect_list(order)).alias("all"))
        .select(F.lit("").alias("case_number"), F.concat(title, F.lit("\n\n"), F.concat_ws("\n\n", F.transform("all", lambda x: x.text))).alias("text"))
    )
    header = total.where(F.col("total") > most).select(F.lit("").alias("case_number"), title.alias("text"))
    return one.union(header).union(both.where(F.col("total") > most).select("case_number", "text"))


def pipeline_summary(filings: DataFrame, creditors: DataFrame, jobs: DataFrame, reviews: DataFrame, queue: DataFrame, since: str, poll_type: str = "docket_poll") -> DataFrame:
    """One row of counts; each table is scanned once. Reviews are counted whatever their status."""
    day = F.lit(since).cast("date")
    done = lambda t, s: F.count_if((F.col("job_type") == t) & (F.col("status") == s) & (F.col("created_at") >= F.lit(since).cast("timestamp")))
    parts = [
        filings.agg(F.count_if(F.col("created_on") >= day).alias("new_filings")),
        creditors.agg(F.count_if(F.col("created_on") >= day).alias("new_creditors")),
        jobs.agg(done(poll_type, "completed").alias("polls_completed"), done(poll_type, "failed").alias("polls_failed")),
        reviews.agg(F.count("*").alias("reviews")),
        queue.agg(F.count_if(F.col("status") == "monitoring").alias("monitoring"), F.count_if(F.col("status") == "pending_approval").alias("pending_approval")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(p)  # one row each
    return out


def match_outcomes(rows: DataFrame, by: str) -> DataFrame:
    """Staged results per job: counts by outcome.

    ``rows`` has ``match_status, company_id`` and, where known, ``cache_hit`` and ``contacts_saved``; null or absent they count as false and 0.
    """
    status = F.col("match_status")
    known = lambda c, none: F.coalesce(c, F.lit(none)) if c in rows.columns else F.lit(none)
    saved = known("contacts_saved", 0)
    has_company = F.coalesce(F.trim(F.col("company_id").cast("string")), F.lit("")) != ""
    alone = ("matched", "no_match", "ambiguous", "error", "rate_limited", "skipped_individual")
    return rows.groupBy(by).agg(
        F.count("*").alias("total"), *(F.count_if(status == s).alias(s) for s in alone),
        F.count_if(has_company | status.isin("matched", "cached", "dry_run")).alias("with_company"), F.count_if(known("cache_hit", False)).alias("cache_hits"),
        F.count_if(status.isin("no_contact_found", "no_match") & (saved == 0)).alias("no_contact"), F.sum(saved).cast("long").alias("contacts_saved"),
    )


def run_outcomes(jobs: DataFrame) -> DataFrame:
    """Per filing: done, failed and open jobs; the run fails only if all have failed."""
    done, failed = F.count_if(F.col("status") == "completed"), F.count_if(F.col("status") == "failed")
    return jobs.groupBy("filing_id").agg(
        done.alias("done"), failed.alias("failed"), F.count_if(~F.col("status").isin("completed", "failed")).alias("open"),
        ((done == 0) & (failed > 0)).alias("run_failed"),
    )


def document_results(docs: DataFrame, by: str = "filing_id") -> DataFrame:
    """Ordered parse results per job, with what failed or needs review."""
    return docs.groupBy(by).agg(
        F.count("*").alias("n_docs"), F.bool_or("flagged").alias("any_review"), F.bool_or(F.col("valid_rows") == 0).alias("any_failed"),
        F.concat_ws(",", F.transform(F.sort_array(F.collect_list("doc_id")), lambda x: x.cast("string"))).alias("doc_ids"),
        F.min_by("linked_filing", F.when(F.col("linked_filing").isNotNull(), F.col("doc_id"))).alias("first_filing"),
    )


def matrix_validation(docs: DataFrame) -> DataFrame:
    """Share of valid rows per document, its level and whether someone must look at it.

    ``docs`` has ``doc_id, valid_rows, total_rows, ocr`` and, where known, ``ocr_confidence``.
    """
    valid, total = F.sum("valid_rows"), F.sum("total_rows")
    share = F.when(total > 0, F.round(F.least(valid / total, F.lit(1.0)), 4)).otherwise(0.0)
    level = F.when(share >= 0.95, "high").when(share >= 0.8, "medium").otherwise("low")
    review = (share < 0.85) | (valid == 0) | (F.bool_or("ocr") & (share < 0.9))
    if "ocr_confidence" in docs.columns:
        review = review | F.coalesce(F.bool_or(F.col("ocr") & (F.col("ocr_confidence") < 0.9)), F.lit(False))
    missing = F.array_compact(F.array(F.when(total == 0, "creditors"), F.when(valid < total, "creditor_name"), F.when((valid == 0) & (total > 0), "creditor_name_quality")))
    return docs.groupBy("doc_id").agg(
        share.alias("share"), level.alias("level"), review.alias("needs_review"), F.concat_ws(",", missing).alias("missing")
    )


def form_validation(rows: DataFrame, fields: list[str], name_field: str, id_col: str = "filing_id") -> DataFrame:
    """Share of known fields, its level, and whether someone must look: for a weak form, one without a name, or (with ``ocr``) a read one below 0.9."""
    missing = F.array_compact(F.array(*(F.when(F.coalesce(F.col(f).cast("string"), F.lit("")) == "", f) for f in fields)))
    n = F.size(missing)
    share = F.round((len(fields) - n) / F.lit(len(fields)), 4)
    review = (share < 0.85) | F.array_contains(missing, name_field)
    if "ocr" in rows.columns:
        review = review | (F.col("ocr") & (share < 0.9))
    return rows.select(
        id_col, share.alias("share"), F.when(n == 0, "high").when(n <= 2, "medium").otherwise("low").alias("level"),
        F.concat_ws(",", missing).alias("missing"), review.alias("needs_review"),
    )


def ocr_rollup(words: DataFrame) -> DataFrame:
    """Pages from recognised words (blank or negative ones dropped), then documents from pages."""
    good = words.where((F.trim("word") != "") & (F.col("confidence") >= 0))
    pages = good.groupBy("doc_id", "page").agg(
        F.concat_ws(" ", F.transform(F.sort_array(F.collect_list(F.struct("place", "word"))), lambda x: x.word)).alias("text"),
        (F.avg("confidence") / 100).alias("confidence"),
    )
    return pages.groupBy("doc_id").agg(
        F.concat_ws("\n", F.transform(F.sort_array(F.collect_list(F.struct("page", "text"))), lambda x: x.text)).alias("text"),
        F.round(F.avg(F.when(F.col("confidence") > 0, F.col("confidence"))), 6).alias("confidence"), F.count("*").alias("n_pages"),
    )


def parse_mode(pages: DataFrame, least_chars: int = 50, share: float = 0.8, most_pages: int = 500) -> DataFrame:
    text = F.avg((F.coalesce(F.length("text"), F.lit(0)) >= least_chars).cast("int"))
    return pages.groupBy("doc_id").agg(
        F.count("*").alias("n_pages"),
        F.when(F.count("*") > most_pages, "rejected").when(text >= share, "structured").otherwise("ocr").alias("mode"),
    )


def contact_titles(titles: DataFrame, tier: int, fallback: bool) -> DataFrame:
    keep = F.col("tier") >= tier if fallback else F.col("tier") == tier
    return titles.where(keep & (F.trim("title") != "")).select(F.trim("title").alias("title")).distinct()


def fill_profile(accounts: DataFrame) -> DataFrame:
    filled = F.coalesce(F.trim("billing_state"), F.lit("")) != ""
    doubles = accounts.groupBy(F.lower("account_name").alias("k")).count().where("count > 1").agg(F.count("*").alias("duplicate_names"))
    return accounts.agg(F.count("*").alias("accounts"), F.count_if(filled).alias("with_state")).crossJoin(doubles)


def claims_rollup(claims: DataFrame, filings: DataFrame) -> DataFrame:
    """Totals by state and year with subtotals (grouping sets are ours; the amounts are exact decimals)."""
    joined = claims.join(filings.select("filing_id", "state", F.year("filing_date").alias("year")), "filing_id")
    return joined.rollup("state", "year").agg(F.count("*").alias("n"), F.sum("amount").cast("decimal(18,2)").alias("total"))
