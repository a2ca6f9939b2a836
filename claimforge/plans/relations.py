"""Queries for joins, aggregates, reports and rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimforge.functions import names
from claimforge.operators import aggregates, linking, maintained_report, ranking
from claimforge.plans.registry import query
from claimforge.plans.scalars import CITY_SQL, COURT_SQL, DOLLARS_SQL, FEED_STATE_SQL, JUNK_SQL, LOSS_SQL, NAME_SQL, NORM_SQL, STATE_SQL
from claimforge.session import shared_folder
from claimforge.sources import feeds

LINKS_SQL = """(SELECT creditor_id, filing_id FROM links JOIN (SELECT creditor_id FROM creditors) USING (creditor_id)
  UNION SELECT creditor_id, source_filing_id FROM creditors WHERE source_filing_id IS NOT NULL)"""
SINCE = "2000-01-01"


@query("j1_creditor_links", f"SELECT creditor_id, filing_id FROM {LINKS_SQL}")
def _(t):
    return linking.creditor_filing_links(t.creditors, t.links)


@query("j2_court_states", "SELECT filing_id, c.state AS court_state FROM filings f JOIN courts c ON lower(trim(f.court_id)) = c.court_id WHERE active")
def _(t):
    return linking.court_states(t.filings, t.courts).select("filing_id", "court_state")


@query(
    "j3_resolved_courts",
    "SELECT filing_id, c.state AS court_state, CASE WHEN coalesce(trim(f.court_id), '') = '' THEN 'missing_court_id' WHEN c.state IS NULL THEN 'unknown_court' END AS skip_reason, "
    "coalesce(c.state IN (SELECT state FROM target_states WHERE active), false) AS is_target FROM filings f LEFT JOIN (SELECT * FROM courts WHERE active) c ON lower(trim(f.court_id)) = c.court_id",
)
def _(t):
    out = linking.resolve_courts(t.filings, t.courts, linking.active_target_states(t.target_states))
    return out.select("filing_id", "court_state", "skip_reason", "is_target")


@query("j4_active_courts", f"SELECT {COURT_SQL.format('court_id')} AS court, c.state FROM courts c JOIN target_states s ON c.state = s.state WHERE c.active AND s.active")
def _(t):
    from claimforge.functions import places

    active = t.target_states.where("active").select("state")
    return t.courts.where("active").join(active, "state").select(places.court_base(F.col("court_id")).alias("court"), "state")


@query("j5_territory_reps", "SELECT account_id, coalesce(rep, 'rep_default') AS rep FROM accounts LEFT JOIN territories ON billing_state = state WHERE coalesce(trim(billing_state), '') <> ''")
def _(t):
    return linking.territory_reps(t.accounts, t.territories, "billing_state").select("account_id", "rep")


@query(
    "j6_latest_filing",
    f"SELECT creditor_id, filing_id, created_on, state FROM {LINKS_SQL} l JOIN filings USING (filing_id) QUALIFY row_number() OVER (PARTITION BY creditor_id ORDER BY created_on DESC, filing_id DESC) = 1",
)
def _(t):
    return linking.latest_filing(linking.creditor_filing_links(t.creditors, t.links), t.filings)


@query("j7_new_favorites", "SELECT filing_id, case_number FROM filings WHERE chapter = '11' AND filing_id NOT IN (SELECT filing_id FROM jobs)")
def _(t):
    return t.filings.where("chapter = '11'").join(t.jobs.select("filing_id"), "filing_id", "left_anti").select("filing_id", "case_number")


MATCH_SQL = f"""WITH c AS (SELECT creditor_id, lower({NAME_SQL}) AS a, lower(name) AS b, upper(trim(home_state)) AS st FROM creditors),
  tries AS (SELECT creditor_id, st, 0 AS place, a AS key FROM c UNION ALL SELECT creditor_id, st, 1, b FROM c WHERE a <> b),
  acc AS (SELECT lower(trim({NORM_SQL.format('account_name')})) AS key, account_id, upper(trim(billing_state)) AS bs FROM accounts),
  hits AS (SELECT creditor_id, place, count(*) AS n, min(account_id) AS one, count(*) FILTER (WHERE st = bs) AS ns, min(account_id) FILTER (WHERE st = bs) AS ones FROM tries JOIN acc USING (key) GROUP BY creditor_id, place),
  ok AS (SELECT creditor_id, place, n, CASE WHEN n = 1 THEN one WHEN ns = 1 THEN ones END AS clear FROM hits),
  best AS (SELECT creditor_id, arg_min(clear, place) FILTER (WHERE clear IS NOT NULL) AS account_id, max(n) AS most FROM ok GROUP BY creditor_id)
  SELECT creditor_id, CASE WHEN account_id IS NOT NULL THEN 'reuse' WHEN most > 1 THEN 'review' ELSE 'create' END AS action, account_id FROM c LEFT JOIN best USING (creditor_id)"""


def _matched(t):
    able = t.creditors.select("creditor_id", "name", names.company_name(F.col("name")).alias("normalized_name"), F.col("home_state").alias("state"))
    accounts = t.accounts.withColumn("account_name", names.company_name(F.col("account_name")))
    return linking.match_accounts(able, accounts)


@query("j8_account_matches", MATCH_SQL)
def _(t):
    return _matched(t)


@query(
    "j9_collapsed_accounts",
    "SELECT filing_id, creditor_id, account_id, row_number() OVER (PARTITION BY filing_id, account_id ORDER BY creditor_id) > 1 AS is_duplicate "
    "FROM (SELECT filing_id, creditor_id, creditor_id % 7 AS account_id FROM links)",
)
def _(t):
    return linking.collapse_accounts(t.links.withColumn("account_id", F.col("creditor_id") % 7)).select("filing_id", "creditor_id", "account_id", "is_duplicate")


@query(
    "j10_debtor_matches",
    """WITH crm AS (SELECT filing_id AS crm_id, CASE WHEN filing_id % 3 = 0 THEN case_number END AS case_number, debtor_name FROM filings WHERE filing_id % 5 < 2),
      k AS (SELECT case_number, min(crm_id) AS a FROM crm WHERE case_number IS NOT NULL GROUP BY 1),
      m AS (SELECT debtor_name, min(crm_id) AS b, count(*) AS n FROM crm WHERE case_number IS NULL GROUP BY 1)
      SELECT filing_id, coalesce(a, CASE WHEN n = 1 THEN b END) AS crm_id, CASE WHEN a IS NOT NULL THEN 'case' WHEN n = 1 THEN 'name' ELSE 'create' END AS action
      FROM filings LEFT JOIN k USING (case_number) LEFT JOIN m USING (debtor_name)""",
)
def _(t):
    crm = t.filings.where("filing_id % 5 < 2").select(
        F.col("filing_id").alias("crm_id"), F.when(F.col("filing_id") % 3 == 0, F.col("case_number")).alias("case_number"), "debtor_name"
    )
    return linking.match_debtors(t.filings.select("filing_id", "case_number", "debtor_name"), crm).select("filing_id", "crm_id", "action")


@query("j11_row_actions", "SELECT l.filing_id, l.creditor_id, CASE WHEN c.creditor_id IS NULL THEN 'insert' ELSE 'update' END AS action FROM links l LEFT JOIN (SELECT DISTINCT filing_id, creditor_id FROM claims WHERE flag = 'R') c USING (filing_id, creditor_id)")
def _(t):
    have = t.claims.where("flag = 'R'").select("filing_id", "creditor_id").distinct().withColumn("hit", F.lit(True))
    return t.links.join(have, ["filing_id", "creditor_id"], "left").select("filing_id", "creditor_id", F.when(F.col("hit"), "update").otherwise("insert").alias("action"))


@query(
    "j12_recency",
    "SELECT account_id, CASE WHEN account_id IN (SELECT debtor_id FROM filings WHERE order_status = 'P' AND filing_id % 9 = 0) OR account_id IN "
    "(SELECT debtor_id FROM filings WHERE filing_date >= DATE '2001-08-01' - 90) THEN 'Existing' ELSE 'New' END AS recency FROM accounts",
)
def _(t):
    deals = t.filings.select(F.col("debtor_id").alias("account_id"), ((F.col("order_status") == "P") & (F.col("filing_id") % 9 == 0)).alias("is_open"))
    touches = t.filings.select(F.col("debtor_id").alias("account_id"), F.col("filing_date").alias("on"))
    return linking.recency(t.accounts, deals, touches, "2001-08-01").select("account_id", "recency")


@query("j13_enrichment_lookup", "SELECT filing_id, creditor_id, company_tier, company_id FROM links LEFT JOIN creditors USING (creditor_id)")
def _(t):
    return t.links.join(t.creditors.select("creditor_id", "company_tier", "company_id"), "creditor_id", "left").select("filing_id", "creditor_id", "company_tier", "company_id")


@query(
    "j14_relinked_documents",
    """WITH r AS (SELECT doc_id, min(filing_id) AS a FROM metas WHERE doc_id % 2 = 0 GROUP BY doc_id)
      SELECT doc_id, coalesce(a, f.filing_id) AS filing_id, CASE WHEN a IS NOT NULL THEN 'review' WHEN f.filing_id IS NOT NULL THEN 'path' ELSE 'skipped' END AS source
      FROM metas m LEFT JOIN r USING (doc_id) LEFT JOIN filings f ON f.case_number = regexp_extract(path, '([0-9]{2}-bk-[0-9]+)', 1) WHERE linked_filing IS NULL""",
)
def _(t):
    return linking.relink_documents(t.metas.drop("filing_id"), t.metas.where("doc_id % 2 = 0").select("doc_id", "filing_id"), t.filings)


@query(
    "j15_docket_by_debtor",
    """WITH d AS (SELECT l_partkey AS docket_id, CAST(l_linenumber AS INT) AS place, case_number, CASE WHEN l_partkey % 3 = 0 THEN 'In re ' || debtor_name ELSE 'Other' END AS docket_name,
        filing_id, debtor_name FROM lineitem JOIN filings ON l_orderkey = filing_id)
      SELECT filing_id, arg_min(docket_id, (docket_name = 'Other', place, docket_id)) AS docket_id, max(docket_name <> 'Other') AS by_name FROM d GROUP BY filing_id""",
)
def _(t):
    dockets = t.claims.join(t.filings.select("filing_id", "case_number", "debtor_name"), "filing_id").select(
        F.col("part_id").alias("docket_id"), F.col("line_number").alias("place"), "case_number",
        F.when(F.col("part_id") % 3 == 0, F.concat(F.lit("In re "), "debtor_name")).otherwise("Other").alias("docket_name"),
    )
    return linking.docket_by_debtor(t.filings.select("filing_id", "case_number", "debtor_name"), dockets)


@query(
    "j17_existing_gate",
    "SELECT filing_id, filing_id IN (SELECT filing_id FROM docket_docs WHERE path IS NOT NULL) AS has_object, filing_id IN (SELECT filing_id FROM links) AS has_row FROM filings",
)
def _(t):
    mark = lambda df, c: df.select("filing_id").distinct().withColumn(c, F.lit(True))
    out = t.filings.join(mark(t.docket_docs.where("path IS NOT NULL"), "o"), "filing_id", "left").join(mark(t.links, "r"), "filing_id", "left")
    return out.select("filing_id", F.coalesce("o", F.lit(False)).alias("has_object"), F.coalesce("r", F.lit(False)).alias("has_row"))


FEED_SQL = f"SELECT *, {LOSS_SQL} AS amount, nullif(concat_ws(', ', nullif(trim(city), ''), {FEED_STATE_SQL}), '') AS addr FROM feed"


@query(
    "a1_combined_claims",
    f"""SELECT case_number, lower(trim(creditor)) AS creditor_key, arg_min(creditor, (line_number, part_id)) AS creditor, arg_min(addr, (line_number, part_id)) FILTER (WHERE addr IS NOT NULL) AS address,
      CAST(sum(amount) AS DECIMAL(15,2)) AS claim_amount, array_to_string(list_sort(list(line_number)), ',') AS line_numbers, count(*) AS n_rows FROM ({FEED_SQL}) GROUP BY ALL""",
)
def _(t):
    rows = feeds.validate_claims(t.feed.withColumn("raw", F.col("creditor")))
    return aggregates.combine_claims(rows).withColumn("line_numbers", F.concat_ws(",", F.col("line_numbers").cast("array<string>")))


@query(
    "a2_case_groups",
    "SELECT case_number, arg_min(debtor, (line_number, part_id, filed, debtor)) AS debtor, arg_min(filed, (line_number, part_id, filed, debtor)) AS filed, count(DISTINCT lower(trim(creditor))) AS n_creditors FROM feed WHERE case_number <> '' GROUP BY case_number",
)
def _(t):
    return aggregates.case_groups(t.feed.where("case_number <> ''"))


@query(
    "a5_exposure",
    "SELECT creditor_id, count(*) AS filing_count, CAST(coalesce(sum(claim_amount), 0) AS DECIMAL(15,2)) AS total_claims, min(filing_date) AS first_seen, max(filing_date) AS last_seen "
    "FROM links JOIN creditors USING (creditor_id) JOIN filings USING (filing_id) GROUP BY creditor_id",
)
def _(t):
    return aggregates.exposure(t.links, t.creditors, t.filings)


@query("a5b_exposure_by_filing", "SELECT creditor_id, count(DISTINCT filing_id) AS filing_count, CAST(sum(amount) AS DECIMAL(15,2)) AS total_claims FROM claims GROUP BY creditor_id")
def _(t):
    return aggregates.exposure_by_filing(t.claims)


A6_SQL = """WITH k AS (SELECT creditor_id, count(*) AS n, CAST(coalesce(sum(claim_amount), 0) AS DECIMAL(15,2)) AS total FROM links JOIN creditors USING (creditor_id)
    JOIN filings USING (filing_id) WHERE filing_date >= CAST(DATE '2001-06-01' - INTERVAL 3 MONTH AS DATE) GROUP BY creditor_id),
  x AS (SELECT creditor_id, coalesce(n, 0) AS n, coalesce(total, 0) AS total FROM creditors LEFT JOIN k USING (creditor_id))
  SELECT creditor_id, n >= 20 AS is_repeat, n AS filing_count, CAST(total AS DECIMAL(15,2)) AS total_claims, 'Repeat exposure: ' || n || ' filings since 2001-03-01 totaling $' ||
    format('{:,.2f}', CAST(total AS DOUBLE)) || ' — use alternate messaging' AS message FROM x"""


@query("a6_repeat_exposure", A6_SQL)
def _(t):
    return aggregates.repeat_exposure(t.links, t.creditors, t.filings, "2001-06-01", threshold=20, months=3)


@query(
    "c16_gate_reasons",
    f"WITH r AS ({A6_SQL.replace('WITH k AS', 'WITH k AS', 1)}) SELECT creditor_id, CASE WHEN creditor_id % 17 = 0 THEN 'dnc' WHEN lower(name) LIKE '%bank%' THEN 'suppressed' "
    "WHEN company_tier = 3 THEN 'active_engagement' WHEN is_repeat THEN 'repeat_exposure' ELSE 'ok' END AS reason FROM creditors JOIN r USING (creditor_id)",
)
def _(t):
    repeat = aggregates.repeat_exposure(t.links, t.creditors, t.filings, "2001-06-01", threshold=20, months=3).select("creditor_id", "is_repeat")
    reason = (
        F.when(F.col("creditor_id") % 17 == 0, "dnc").when(names.holds_any(F.col("name"), ["bank"]), "suppressed").when(F.col("company_tier") == 3, "active_engagement")
        .when(F.col("is_repeat"), "repeat_exposure").otherwise("ok")
    )
    return t.creditors.join(repeat, "creditor_id").select("creditor_id", reason.alias("reason"))


STATUS_SQL = f"""SELECT creditor_id, CASE WHEN creditor_id % 8 = 0 THEN 'Synced' WHEN creditor_id % 8 = 1 THEN 'Enriched' WHEN pending THEN 'Pending Enrichment' WHEN failed THEN 'Enrichment Failed' ELSE 'New' END AS status
  FROM creditors LEFT JOIN (SELECT creditor_id, bool_or(status IN ('queued', 'running', 'retrying')) AS pending, bool_or(status = 'failed') AS failed
  FROM {LINKS_SQL} l JOIN jobs USING (filing_id) WHERE job_type = 'company_lookup' GROUP BY creditor_id) s USING (creditor_id)"""


def _status(t):
    return aggregates.pipeline_status(t.creditors, t.links, t.jobs, t.creditors.where("creditor_id % 8 = 0"), t.creditors.where("creditor_id % 8 = 1"))


@query("st1_pipeline_status", STATUS_SQL)
def _(t):
    return _status(t)


URL_SQL = "CASE WHEN coalesce(trim(company_id), '') = '' THEN '' ELSE 'https://example.org/company/' || trim(company_id) || '/overview' END"
SHOWN_SQL = f"coalesce(nullif(trim(original_name), ''), name) AS creditor, {CITY_SQL} AS city, {STATE_SQL % 'f.state'} AS state, {DOLLARS_SQL.format('claim_amount')} AS claim, status, {URL_SQL} AS profile_url"
A8_SQL = f"""SELECT c.creditor_id, f.filing_id, debtor_name, case_number, filing_date, {SHOWN_SQL}, company_tier AS tier FROM creditors c JOIN {LINKS_SQL} l ON c.creditor_id = l.creditor_id
  JOIN filings f ON f.filing_id = l.filing_id JOIN ({STATUS_SQL}) s ON s.creditor_id = c.creditor_id WHERE is_company AND NOT {JUNK_SQL} AND (c.created_on >= DATE '{{0}}' OR f.created_on >= DATE '{{0}}')"""


def report(t, since: str = SINCE):
    return aggregates.report_rows(t.creditors, t.links, t.filings, _status(t), since)


@query("a8_daily_report", A8_SQL.replace("{0}", SINCE))
def _(t):
    return report(t)


@query("a8_report_envelope", f"SELECT count(DISTINCT filing_id) AS debtor_count, count(DISTINCT creditor_id) AS creditor_count FROM ({A8_SQL.replace('{0}', SINCE)})")
def _(t):
    return aggregates.report_envelope(report(t))


A9_SQL = f"""WITH n AS (SELECT creditor_id, filing_id, created_on AS newest, state FROM {LINKS_SQL} l JOIN filings USING (filing_id) QUALIFY row_number() OVER (PARTITION BY creditor_id ORDER BY created_on DESC, filing_id DESC) = 1)
  SELECT c.creditor_id, {SHOWN_SQL} FROM creditors c LEFT JOIN n f ON f.creditor_id = c.creditor_id JOIN ({STATUS_SQL}) s ON s.creditor_id = c.creditor_id
  WHERE is_company AND NOT {JUNK_SQL} AND (c.created_on >= DATE '2001-07-20' OR newest >= DATE '2001-07-20')"""


@query("a9_flat_report", A9_SQL)
def _(t):
    return aggregates.report_flat(t.creditors, t.links, t.filings, _status(t), "2001-07-20")


def kept_reports(t) -> str:
    """The tables as three batches of changes in a store of reports: two thirds of the ties come before their filings, and every third job is queued first."""
    path, later = shared_folder(t.spark, "kept-reports"), F.col("created_at") - F.expr("INTERVAL 1 HOUR")
    for k in range(3):
        part = lambda df, key, k=k: df.where(F.col(key) % 3 == k)
        jobs = part(t.jobs, "job_id")
        if k == 0:
            jobs = jobs.unionByName(part(t.jobs, "job_id", 2).withColumn("status", F.lit("queued")).withColumn("created_at", later))
        changes = {
            "filings": part(t.filings, "filing_id"), "creditors": part(t.creditors, "creditor_id"), "links": part(t.links, "filing_id", (k + 1) % 3), "jobs": jobs,
            "synced": part(t.creditors, "creditor_id").where("creditor_id % 8 = 0"), "contacts": part(t.creditors, "creditor_id").where("creditor_id % 8 = 1"),
        }
        maintained_report.apply(t.spark, path, k, changes, buckets=8)
    return path


@query("a8c_maintained_report", A8_SQL.replace("{0}", SINCE))
def _(t):
    return maintained_report.report_rows(t.spark, kept_reports(t), SINCE)


@query("a9c_maintained_flat", A9_SQL)
def _(t):
    return maintained_report.report_flat(t.spark, kept_reports(t), "2001-07-20")


LABEL_SQL = "CASE tier WHEN 1 THEN 'Enterprise' WHEN 2 THEN 'Mid-Market' WHEN 3 THEN 'SMB' ELSE '—' END"
A19_SQL = f"""WITH r AS ({A8_SQL}),
  l AS (SELECT *, '• ' || creditor || ' | ' || concat_ws(', ', city, state) || ' | ' || claim || ' | ' || {LABEL_SQL} || ' | ' || status AS line,
     coalesce(TRY_CAST(replace(replace(claim, '$', ''), ',', '') AS DECIMAL(15,2)), 0) AS amount FROM r),
  b AS (SELECT debtor_name, case_number, filing_date, count(*) AS n, string_agg(line, chr(10) ORDER BY amount DESC, creditor, creditor_id, line) AS lines FROM l GROUP BY ALL),
  x AS (SELECT *, debtor_name || ' (' || case_number || '), filed ' || filing_date || ': ' || n || ' creditor' || CASE WHEN n = 1 THEN '' ELSE 's' END || chr(10) || lines AS text FROM b),
  h AS (SELECT count(DISTINCT case_number) AS d, count(*) AS c FROM r),
  t AS (SELECT c, d || ' debtor' || CASE WHEN d = 1 THEN '' ELSE 's' END || ', ' || c || ' creditor' || CASE WHEN c = 1 THEN '' ELSE 's' END AS title FROM h)
  SELECT '' AS case_number, title || chr(10) || chr(10) || string_agg(text, chr(10) || chr(10) ORDER BY filing_date DESC, debtor_name, case_number, text) AS text FROM x, t WHERE c <= 40 GROUP BY title
  UNION ALL SELECT '', title FROM t WHERE c > 40 UNION ALL SELECT case_number, text FROM x, t WHERE c > 40"""


@query("a19_report_messages", A19_SQL.replace("{0}", "2001-07-25"))
def _(t):
    return aggregates.report_messages(report(t, "2001-07-25"))


@query("w14_top_claims", f"""SELECT creditor_id, filing_id, claim FROM ({A8_SQL.replace('{0}', SINCE)}) QUALIFY row_number() OVER (PARTITION BY debtor_name
  ORDER BY coalesce(TRY_CAST(replace(replace(claim, '$', ''), ',', '') AS DECIMAL(15,2)), 0) DESC, creditor_id, filing_id) <= 2""")
def _(t):
    from pyspark.sql import Window

    from claimforge.functions import money

    w = Window.partitionBy("debtor_name").orderBy(money.sort_amount(F.col("claim")).desc(), "creditor_id", "filing_id")
    return report(t).withColumn("k", F.row_number().over(w)).where("k <= 2").select("creditor_id", "filing_id", "claim")


@query("s7_exported_messages", f"SELECT case_number, length(text) AS size FROM ({A19_SQL.replace('{0}', '2001-07-01')})")
def _(t):
    path = shared_folder(t.spark, "messages")
    aggregates.report_messages(report(t, "2001-07-01")).write.json(path)
    return t.spark.read.schema("case_number string, text string").json(path).select("case_number", F.length("text").cast("long").alias("size"))


@query(
    "a7_pipeline_summary",
    """SELECT (SELECT count(*) FROM filings WHERE created_on >= DATE '2001-01-01') AS new_filings, (SELECT count(*) FROM creditors WHERE created_on >= DATE '2001-01-01') AS new_creditors,
      (SELECT count(*) FROM jobs WHERE job_type = 'docket_poll' AND status = 'completed') AS polls_completed, (SELECT count(*) FROM jobs WHERE job_type = 'docket_poll' AND status = 'failed') AS polls_failed,
      (SELECT count(*) FROM metas) AS reviews, (SELECT count(*) FROM docket_docs WHERE description = 'Petition') AS monitoring, (SELECT count(*) FROM docket_docs WHERE description = 'Notice of hearing') AS pending_approval""",
)
def _(t):
    status = F.when(F.col("description") == "Petition", "monitoring").when(F.col("description") == "Notice of hearing", "pending_approval")
    return aggregates.pipeline_summary(t.filings, t.creditors, t.jobs, t.metas, t.docket_docs.withColumn("status", status), "2001-01-01")


BEST_SQL = """WITH s AS (SELECT k.*, home_state, coalesce(confidence, 0.5) + CASE WHEN contains(upper(coalesce(headquarters, '')), home_state) THEN 0.5 ELSE 0 END AS score FROM candidates k JOIN creditors USING (creditor_id)),
  r AS (SELECT *, row_number() OVER w AS k, lead(score) OVER w AS second FROM s WINDOW w AS (PARTITION BY creditor_id ORDER BY score DESC, place, candidate_id, name_key)),
  b AS (SELECT * FROM r WHERE k = 1)
  SELECT creditor_id, CASE WHEN candidate_id IS NULL THEN 'no_match' WHEN coalesce(score - second < 0.05, false) THEN 'ambiguous' ELSE 'matched' END AS match_status,
    CASE WHEN NOT coalesce(score - second < 0.05, false) THEN candidate_id END AS company_id, round(CAST(score AS DOUBLE), 6) AS score FROM (SELECT creditor_id FROM creditors) c LEFT JOIN b USING (creditor_id)"""


@query(
    "w5_best_candidates",
    f"SELECT creditor_id, CASE WHEN creditor_id % 9 = 4 THEN 'rate_limited' WHEN creditor_id % 11 = 3 THEN 'error' ELSE match_status END AS match_status, CASE WHEN creditor_id % 9 <> 4 AND creditor_id % 11 <> 3 THEN company_id END AS company_id, "
    f"CASE WHEN creditor_id % 9 <> 4 AND creditor_id % 11 <> 3 THEN score END AS score FROM ({BEST_SQL})",
)
def _(t):
    limited = t.creditors.where("creditor_id % 9 = 4").select("creditor_id", F.lit(429).alias("http_status"))
    broken = t.creditors.where("creditor_id % 11 = 3").select("creditor_id", F.lit(500).alias("http_status"))
    return ranking.best_candidates(t.candidates, t.creditors, failures=limited.union(broken))


@query(
    "a10_match_outcomes",
    f"""WITH x AS (SELECT creditor_id, company_id, CASE WHEN creditor_id % 17 = 5 THEN 'skipped_individual' WHEN creditor_id % 19 = 7 THEN 'no_contact_found' WHEN creditor_id % 23 = 9 THEN 'cached' ELSE match_status END AS s,
        creditor_id % 6 = 0 AS hit, CASE WHEN creditor_id % 4 > 1 THEN creditor_id % 4 ELSE 0 END AS saved FROM ({BEST_SQL}))
      SELECT creditor_id % 10 AS job_id, count(*) AS total, count(*) FILTER (WHERE s = 'matched') AS matched, count(*) FILTER (WHERE s = 'no_match') AS no_match, count(*) FILTER (WHERE s = 'ambiguous') AS ambiguous,
        count(*) FILTER (WHERE s = 'error') AS error, count(*) FILTER (WHERE s = 'rate_limited') AS rate_limited, count(*) FILTER (WHERE s = 'skipped_individual') AS skipped_individual,
        count(*) FILTER (WHERE company_id IS NOT NULL OR s IN ('matched', 'cached', 'dry_run')) AS with_company, count(*) FILTER (WHERE hit) AS cache_hits,
        count(*) FILTER (WHERE s IN ('no_contact_found', 'no_match') AND saved = 0) AS no_contact, CAST(sum(saved) AS BIGINT) AS contacts_saved FROM x GROUP BY 1""",
)
def _(t):
    k = F.col("creditor_id")
    status = F.when(k % 17 == 5, "skipped_individual").when(k % 19 == 7, "no_contact_found").when(k % 23 == 9, "cached").otherwise(F.col("match_status"))
    staged = ranking.best_candidates(t.candidates, t.creditors).withColumns(
        {"match_status": status, "job_id": k % 10, "cache_hit": k % 6 == 0, "contacts_saved": F.when(k % 4 > 1, k % 4)}
    )
    return aggregates.match_outcomes(staged, "job_id")


@query(
    "a11_document_results",
    """SELECT filing_id, count(*) AS n_docs, bool_or(flagged) AS any_review, bool_or(valid_rows = 0) AS any_failed, array_to_string(list_sort(list(doc_id)), ',') AS doc_ids,
      arg_min(linked_filing, doc_id) FILTER (WHERE linked_filing IS NOT NULL) AS first_filing FROM metas GROUP BY filing_id""",
)
def _(t):
    return aggregates.document_results(t.metas)


@query(
    "a12_matrix_validation",
    """WITH s AS (SELECT doc_id, sum(valid_rows) AS v, sum(total_rows) AS n, bool_or(ocr) AS o FROM metas GROUP BY doc_id),
      x AS (SELECT *, CASE WHEN n > 0 THEN round(least(v / n, 1.0), 4) ELSE 0.0 END AS share FROM s)
      SELECT doc_id, CAST(share AS DOUBLE) AS share, CASE WHEN share >= 0.95 THEN 'high' WHEN share >= 0.8 THEN 'medium' ELSE 'low' END AS level,
        share < 0.85 OR v = 0 OR (o AND share < 0.9) AS needs_review, concat_ws(',', CASE WHEN n = 0 THEN 'creditors' END, CASE WHEN v < n THEN 'creditor_name' END, CASE WHEN v = 0 AND n > 0 THEN 'creditor_name_quality' END) AS missing FROM x""",
)
def _(t):
    return aggregates.matrix_validation(t.metas)


@query(
    "a13_form_validation",
    """WITH m AS (SELECT filing_id, list_filter([CASE WHEN coalesce(debtor_name, '') = '' THEN 'debtor_name' END, CASE WHEN coalesce(state, '') = '' THEN 'state' END,
       CASE WHEN coalesce(trim(court_id), '') IN ('', ' ') AND coalesce(court_id, '') = '' THEN 'court_id' END, CASE WHEN liabilities IS NULL THEN 'liabilities' END], lambda x: x IS NOT NULL) AS miss FROM filings)
      SELECT filing_id, CAST(round((4 - len(miss)) / 4, 4) AS DOUBLE) AS share, CASE WHEN len(miss) = 0 THEN 'high' WHEN len(miss) <= 2 THEN 'medium' ELSE 'low' END AS level,
       array_to_string(miss, ',') AS missing, (4 - len(miss)) / 4 < 0.85 OR list_contains(miss, 'debtor_name') AS needs_review FROM m""",
)
def _(t):
    return aggregates.form_validation(t.filings, ["debtor_name", "state", "court_id", "liabilities"], "debtor_name")


@query(
    "a14_ocr_rollup",
    """WITH w AS (SELECT l_suppkey AS doc_id, l_linenumber AS page, l_orderkey AS place, CASE WHEN l_partkey % 6 = 0 THEN ' ' ELSE 'w' || l_partkey END AS word, l_partkey % 100 - 3 AS confidence FROM lineitem),
      p AS (SELECT doc_id, page, string_agg(word, ' ' ORDER BY place, word) AS text, avg(confidence) / 100 AS c FROM w WHERE trim(word) <> '' AND confidence >= 0 GROUP BY ALL)
      SELECT doc_id, string_agg(text, chr(10) ORDER BY page, text) AS text, round(avg(c) FILTER (WHERE c > 0), 6) AS confidence, count(*) AS n_pages FROM p GROUP BY doc_id""",
)
def _(t):
    word = F.when(F.col("part_id") % 6 == 0, " ").otherwise(F.concat(F.lit("w"), F.col("part_id").cast("string")))
    words = t.claims.select(
        F.col("creditor_id").alias("doc_id"), F.col("line_number").alias("page"), F.col("filing_id").alias("place"), word.alias("word"), (F.col("part_id") % 100 - 3).alias("confidence")
    )
    return aggregates.ocr_rollup(words)


@query(
    "a15_parse_modes",
    """SELECT source AS doc_id, count(*) AS n_pages, CASE WHEN count(*) > 500 THEN 'rejected' WHEN avg(CAST(coalesce(length(text), 0) >= 300 AS INT)) >= 0.8 THEN 'structured' ELSE 'ocr' END AS mode FROM documents GROUP BY source""",
)
def _(t):
    return aggregates.parse_mode(t.documents.select(F.col("source").alias("doc_id"), "text"), least_chars=300)


@query(
    "a16_run_outcomes",
    "SELECT filing_id, count(*) FILTER (WHERE status = 'completed') AS done, count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status NOT IN ('completed', 'failed')) AS open, "
    "count(*) FILTER (WHERE status = 'completed') = 0 AND count(*) FILTER (WHERE status = 'failed') > 0 AS run_failed FROM jobs WHERE job_type = 'company_lookup' GROUP BY filing_id",
)
def _(t):
    return aggregates.run_outcomes(t.jobs.where("job_type = 'company_lookup'"))


@query(
    "a17_push_outcomes",
    "SELECT filing_id, count(*) FILTER (WHERE status = 'completed') AS done, count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status NOT IN ('completed', 'failed')) AS open, "
    "count(*) FILTER (WHERE status = 'completed') = 0 AND count(*) FILTER (WHERE status = 'failed') > 0 AS run_failed FROM jobs WHERE job_type = 'account_push' GROUP BY filing_id",
)
def _(t):
    return aggregates.run_outcomes(t.jobs.where("job_type = 'account_push'"))


@query("a18_contact_titles", "SELECT DISTINCT p_type AS title FROM part WHERE p_size % 3 + 1 >= 2")
def _(t):
    return aggregates.contact_titles(t.part.select((F.col("p_size") % 3 + 1).alias("tier"), F.col("p_type").alias("title")), 2, True)


@query("w13_ranked_titles", "SELECT DISTINCT p_brand AS title FROM part WHERE p_size % 3 = 1 ORDER BY title")
def _(t):
    return aggregates.contact_titles(t.part.select((F.col("p_size") % 3).alias("tier"), F.col("p_brand").alias("title")), 1, False).orderBy("title")


@query(
    "a21_fill_profile",
    "SELECT (SELECT count(*) FROM accounts) AS accounts, (SELECT count(*) FROM accounts WHERE coalesce(trim(billing_state), '') <> '') AS with_state, "
    "(SELECT count(*) FROM (SELECT lower(account_name) FROM accounts GROUP BY 1 HAVING count(*) > 1)) AS duplicate_names",
)
def _(t):
    return aggregates.fill_profile(t.accounts)


@query(
    "x_claims_rollup",
    "SELECT state, CAST(year(filing_date) AS INT) AS year, count(*) AS n, CAST(sum(amount) AS DECIMAL(18,2)) AS total FROM claims JOIN filings USING (filing_id) GROUP BY ROLLUP (state, CAST(year(filing_date) AS INT))",
)
def _(t):
    return aggregates.claims_rollup(t.claims, t.filings)


@query(
    "w1_poll_candidates",
    "SELECT filing_id, case_number FROM filings LEFT JOIN (SELECT filing_id, max(CAST(created_at AS DATE)) AS last_check FROM jobs GROUP BY 1) USING (filing_id) "
    "WHERE trim(case_number) <> '' AND state IN (SELECT state FROM target_states WHERE active) ORDER BY last_check NULLS FIRST, created_on, filing_id LIMIT 50",
)
def _(t):
    checks = t.jobs.select("filing_id", F.to_date("created_at").alias("checked_on"))
    return ranking.poll_candidates(t.filings, checks, 50, linking.active_target_states(t.target_states)).select("filing_id", "case_number")


@query(
    "w2_latest_documents",
    "WITH d AS (SELECT filing_id, arg_max(path, (filed_on, document_id, source_id)) AS path, max(filed_on) AS filed_on FROM docket_docs WHERE coalesce(path, '') <> '' GROUP BY filing_id), "
    "q AS (SELECT filing_id, job_id AS queue_id FROM jobs QUALIFY row_number() OVER (PARTITION BY filing_id ORDER BY created_at DESC, job_id DESC) = 1) "
    "SELECT filing_id, path, filed_on, queue_id FROM d FULL JOIN q USING (filing_id)",
)
def _(t):
    return ranking.handoff(t.docket_docs, t.jobs.select("filing_id", F.col("job_id").alias("queue_id"), "created_at"))


@query(
    "w3_picked_documents",
    """WITH r AS (SELECT *, coalesce(CASE WHEN TRY_CAST(split_part(document_number, '.', 1) AS INT) > 0 THEN TRY_CAST(split_part(document_number, '.', 1) AS INT) END, 2147483647) AS a,
       coalesce(CASE WHEN page_count > 0 THEN page_count END, 2147483647) AS b FROM docket_docs)
      SELECT filing_id, document_id, a AS number_rank, b AS page_rank FROM r QUALIFY row_number() OVER (PARTITION BY filing_id ORDER BY a, b, document_id, source_id, filed_on) = 1""",
)
def _(t):
    return ranking.pick_document(t.docket_docs)


@query(
    "w4_top_contacts",
    "SELECT filing_id, part_id, CAST(k AS INT) AS place FROM (SELECT filing_id, part_id, row_number() OVER (PARTITION BY creditor_id, filing_id ORDER BY amount DESC NULLS LAST, part_id, line_number) AS k FROM claims WHERE flag <> 'N') WHERE k <= 3",
)
def _(t):
    contacts = t.claims.select(
        F.struct("creditor_id", "filing_id").alias("creditor_id"), "filing_id", "part_id", F.when(F.col("flag") != "N", F.col("flag")).alias("full_name"),
        F.col("amount").alias("engagement"), F.struct("part_id", "line_number").alias("contact_id"),
    )
    return ranking.top_contacts(contacts).select("filing_id", "part_id", "place")


@query(
    "w6_claimable_jobs",
    "SELECT job_type, arg_min(job_id, (created_at, job_id)) AS job_id FROM jobs q WHERE status = 'queued' AND NOT EXISTS (SELECT 1 FROM jobs r WHERE r.status = 'running' AND r.filing_id = q.filing_id AND r.job_type = q.job_type) GROUP BY job_type",
)
def _(t):
    return ranking.claimable_jobs(t.jobs)


@query(
    "w7_enqueueable",
    "SELECT DISTINCT filing_id, 'document_parse' AS job_type FROM links l WHERE NOT EXISTS (SELECT 1 FROM jobs j WHERE j.status IN ('queued', 'running') AND j.job_type = 'document_parse' AND j.filing_id = l.filing_id)",
)
def _(t):
    return ranking.enqueueable(t.links.withColumn("job_type", F.lit("document_parse")), t.jobs)


@query(
    "w8_stale_jobs",
    "SELECT job_id, CASE WHEN old THEN 'failed' ELSE status END AS status, CASE WHEN old THEN coalesce(message, 'stale job') ELSE message END AS message FROM "
    "(SELECT *, status IN ('queued', 'running') AND created_at < TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 24 HOUR AS old FROM jobs)",
)
def _(t):
    return ranking.fail_stale(t.jobs, "2024-01-20 00:00:00").select("job_id", "status", "message")


@query(
    "w9_drain_order",
    "SELECT job_id, CAST(CASE job_type WHEN 'document_parse' THEN 1 WHEN 'company_lookup' THEN 2 ELSE 3 END AS BIGINT) AS rank FROM jobs WHERE status = 'queued' AND job_type <> 'docket_poll'",
)
def _(t):
    return ranking.drain_order(t.jobs).select("job_id", F.col("rank").cast("long").alias("rank"))


W10_SQL = "SELECT filing_id, running_cost, CASE WHEN running_cost <= 9000 THEN 'attempted' ELSE 'unattempted' END AS outcome FROM (SELECT filing_id, CAST(sum(filing_id % 4 + 1) OVER (ORDER BY filing_date, filing_id) AS BIGINT) AS running_cost FROM filings)"


@query("w10_budgeted_worklist", W10_SQL)
def _(t):
    rows = t.filings.select("filing_id", F.col("filing_date").alias("filed_on"), (F.col("filing_id") % 4 + 1).alias("cost"))
    return ranking.budgeted(rows, 9000).select("filing_id", "running_cost", "outcome")


@query(
    "w12_call_audit",
    """WITH c AS (SELECT call_id, account, epoch_us(called_at) AS us FROM calls),
      x AS (SELECT call_id, account, count(*) OVER (PARTITION BY account ORDER BY us RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW) AS last_minute,
        count(*) OVER (PARTITION BY account ORDER BY us RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW) AS last_hour, us - lag(us) OVER (PARTITION BY account ORDER BY us, call_id) AS gap_us FROM c)
      SELECT *, last_minute > 5 OR last_hour > 50 OR coalesce(gap_us < 15000000, false) AS violates FROM x""",
)
def _(t):
    return ranking.call_audit(t.calls)
