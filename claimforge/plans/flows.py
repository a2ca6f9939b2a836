"""Whole flows: feed ingest, document parsing, review corrections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimforge.functions import names
from claimforge.operators import aggregates, extraction, fuzzy, merging, ranking
from claimforge.plans.changes import petition_tables, sheets
from claimforge.plans.registry import query
from claimforge.session import materialize
from claimforge.sources import feeds


def ingest_feed(rows: DataFrame, states: list[str], jobs: DataFrame) -> dict[str, DataFrame]:
    """A claim feed to filings, creditors by case, rejects and the jobs that are due."""
    checked = materialize(feeds.validate_claims(rows), "checked")
    good = feeds.keep_states(checked.where("rejected_for IS NULL"), states)
    filings = merging.filings_from_feed(good.select("case_number", "debtor", "filed", "line_number", "part_id"))
    due = ranking.enqueueable(filings.select(F.col("case_number").alias("filing_id"), F.lit("company_lookup").alias("job_type")), jobs)
    return {"filings": filings, "creditors": aggregates.combine_claims(good), "rejects": checked.where("rejected_for IS NOT NULL"), "jobs": due}


FORM_VALUES = ("debtor_name", "city", "state", "court_district", "industry_code", "estimated_assets", "estimated_liabilities", "estimated_creditor_count")


def parse_documents(docs: DataFrame, known: DataFrame, tables: DataFrame, pages: DataFrame | None = None, store: DataFrame | None = None) -> dict[str, DataFrame]:
    """Texts ``doc_id, text`` (and where known ``filing_id, hint``) to forms, creditors and validation, skipping content in ``known (content_sha256)``.

    Hash, cache lookup, mode by ``pages (doc_id, text)``, kind, then by kind: forms to their fields; lists and schedules
    to creditors with the fallbacks, fuzzy dedup inside the document and the share of usable rows. What is neither, has
    too many pages or fails its validation is in ``reviews (doc_id, reason)``. With ``store`` the creditors of lists that
    passed and have a filing are merged into it as ``store``.
    """
    hashed = docs.withColumn("content_sha256", F.sha2(F.coalesce("text", F.lit("")), 256)).join(known, "content_sha256", "left_anti")
    if pages is None:
        hashed = hashed.withColumn("mode", F.lit("structured"))
    else:
        hashed = hashed.join(aggregates.parse_mode(pages).select("doc_id", "mode"), "doc_id", "left").fillna("structured", ["mode"])
    hashed = materialize(hashed, "to-parse")
    able = hashed.where("mode <> 'rejected'")
    kinds = materialize(extraction.classify(able, hint_col="hint" if "hint" in docs.columns else None), "kinds")  # each branch below picks by kind
    of = lambda rows, *which: rows.join(kinds.where(F.col("kind").isin(*which)).select("doc_id"), "doc_id", "left_semi")

    fields = extraction.form_fields(of(able, "form_201"), "doc_id", tables=of(tables, "form_201"))
    fields = materialize(fields, "forms")  # validation reads each field several times
    ranges = [F.coalesce(f"least_{a}", f"most_{a}").alias(b) for a, b in (("assets", "estimated_assets"), ("liabilities", "estimated_liabilities"), ("creditors", "estimated_creditor_count"))]
    ocr = able.select("doc_id", (F.col("mode") == "ocr").alias("ocr"))
    checked_forms = aggregates.form_validation(fields.select("*", *ranges).join(ocr, "doc_id"), list(FORM_VALUES), "debtor_name", "doc_id")

    lists = of(able, "creditor_matrix", "schedule")
    found = extraction.extract_creditors(lists, of(tables, "creditor_matrix"), schedules=of(tables, "schedule")).select(
        "doc_id", F.xxhash64("doc_id", "source", "place", "name").alias("row_id"), "name", "address", "claim_amount",
        F.lit(None).cast("double").alias("confidence"), F.col("place").alias("line_number"),
    )
    found = materialize(found, "extracted")
    creditors = fuzzy.deduplicate(found, "doc_id")
    counts = creditors.groupBy("doc_id").agg(F.count_if(F.col("name") != "").alias("valid_rows"), F.count("*").alias("total_rows"))
    zero = F.lit(0).cast("long")
    checked_lists = aggregates.matrix_validation(
        lists.select("doc_id").join(ocr, "doc_id").join(counts, "doc_id", "left").select(
            "doc_id", F.coalesce("valid_rows", zero).alias("valid_rows"), F.coalesce("total_rows", zero).alias("total_rows"), "ocr"
        )
    )
    validation = checked_lists.unionByName(checked_forms.select(checked_lists.columns))
    failed = validation.where("needs_review").select("doc_id", F.coalesce(F.nullif("missing", F.lit("")), F.lit("low_confidence")).alias("reason"))
    neither = kinds.where(~F.col("kind").isin("form_201", "creditor_matrix", "schedule")).select("doc_id", F.lit("unknown_filing_type").alias("reason"))
    large = hashed.where("mode = 'rejected'").select("doc_id", F.lit("too_many_pages").alias("reason"))
    out = {"kinds": kinds, "forms": fields, "creditors": creditors, "validation": validation, "reviews": failed.union(neither).union(large)}
    if store is not None:
        good = checked_lists.where("NOT needs_review").select("doc_id", F.col("share").alias("_share")).join(docs.where("filing_id IS NOT NULL").select("doc_id", "filing_id"), "doc_id")
        batch = creditors.join(good, "doc_id").select(
            "filing_id", F.struct("doc_id", "cluster_id").alias("arrival"), F.col("name").alias("creditor_name"), "address", "claim_amount",
            F.lit(None).cast("string").alias("original_name"), F.coalesce("confidence", "_share").alias("confidence"), names.entity_type(F.col("name")).alias("entity_type"),
        )
        out["store"] = merging.merge_creditors(store, batch)
    return out


def apply_corrections(corrected: DataFrame, store: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Corrected creditors per document, deduplicated and validated again: the merged store, and documents still rejected."""
    clean = materialize(fuzzy.deduplicate(corrected, "doc_id"), "corrected")
    share = clean.groupBy("doc_id").agg(F.count_if(F.col("name") != "").alias("valid_rows"), F.count("*").alias("total_rows"), F.lit(False).alias("ocr"))
    checked = aggregates.matrix_validation(share)
    good = clean.join(checked.where("NOT needs_review").select("doc_id"), "doc_id", "left_semi").select(
        F.col("doc_id").alias("filing_id"), F.struct("doc_id", "cluster_id").alias("arrival"), F.col("name").alias("creditor_name"), "address", "claim_amount",
        F.lit(None).cast("string").alias("original_name"), "confidence", F.lit("company").alias("entity_type"),
    )
    return merging.merge_creditors(store, good), checked.where("needs_review")


@query(
    "flow_feed_creditors",
    "SELECT case_number, count(DISTINCT lower(trim(creditor))) AS n_creditors FROM feed WHERE trim(creditor) <> '' AND case_number <> '' AND "
    "CASE WHEN regexp_matches(trim(state), '^[A-Za-z]{2}$') THEN upper(trim(state)) END IN ('CA', 'NY') GROUP BY case_number",
)
def _(t):
    out = ingest_feed(t.feed, ["CA", "NY"], t.jobs.withColumn("filing_id", F.col("filing_id").cast("string")))
    return out["creditors"].groupBy("case_number").agg(F.count("*").alias("n_creditors"))


@query("t12_parsed_documents")
def _(t):
    docs = t.notices.select(F.col("filing_id").alias("doc_id"), "text")
    none = docs.limit(0)
    tables = sheets(t).where("doc_id % 10 = 1").select(F.floor(F.col("doc_id") / 10).alias("doc_id"), "tables")
    pages = t.claims.select(F.col("filing_id").alias("doc_id"), F.repeat(F.lit("x"), F.col("part_id") % 60 + 20).alias("text"))
    return parse_documents(docs, none.select(F.sha2("text", 256).alias("content_sha256")), tables, pages)["creditors"]


def _review_sql() -> str:
    from claimforge.plans.changes import T1_KINDS_SQL, form_sql

    shown = {"estimated_assets": "assets", "estimated_liabilities": "liabilities", "estimated_creditor_count": "creditors"}
    value = lambda c: f"coalesce(least_{shown[c]}, most_{shown[c]})" if c in shown else c
    miss = ", ".join(f"CASE WHEN {value(c)} IS NULL THEN '{c}' END" for c in FORM_VALUES)
    return f"""WITH m AS (SELECT filing_id, list_filter([{miss}], lambda x: x IS NOT NULL) AS miss FROM ({form_sql()}))
      SELECT 2 * filing_id AS doc_id, array_to_string(miss, ',') AS reason FROM m WHERE (8 - len(miss)) / 8 < 0.85 OR list_contains(miss, 'debtor_name')
      UNION ALL SELECT 2 * doc_id + 1, 'unknown_filing_type' FROM ({T1_KINDS_SQL}) WHERE kind IN ('unknown', 'sofa')"""


@query("t12b_review_queue", _review_sql())
def _(t):
    docs = t.petitions.select((2 * F.col("filing_id")).alias("doc_id"), "text").union(t.documents.select((2 * F.col("doc_id") + 1).alias("doc_id"), "text"))
    none = docs.limit(0)
    tables = petition_tables(t).select((2 * F.col("filing_id")).alias("doc_id"), "tables")
    return parse_documents(docs, none.select(F.sha2("text", 256).alias("content_sha256")), tables)["reviews"]


@query("u22_applied_corrections")
def _(t):
    rows = t.claims.join(t.supplier.select(F.col("s_suppkey").alias("creditor_id"), F.col("s_name").alias("name")), "creditor_id")
    corrected = rows.select(
        F.col("filing_id").alias("doc_id"), F.xxhash64("filing_id", "creditor_id", "part_id", "line_number").alias("row_id"), "name", F.lit("1 Main St").alias("address"),
        F.col("amount").alias("claim_amount"), F.lit(0.9).alias("confidence"), "line_number",
    )
    store = t.creditors.select("name", "address", "claim_amount", "original_name", F.lit(None).cast("double").alias("confidence"), "source_filing_id", "is_company")
    return apply_corrections(corrected, store)[0]
