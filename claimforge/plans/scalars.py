"""Queries for scalar functions and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimforge.functions import money, names, places
from claimforge.operators import incremental, linking, ranking
from claimforge.plans.registry import query
from claimforge.sources import feeds

JUNK_SQL = (
    "(length(trim(name)) < 3 OR lower(trim(name)) IN ({}) OR regexp_matches(lower(trim(name)), '^({})') OR "
    "regexp_matches(lower(trim(name)), '({})') OR regexp_matches(trim(name), '^[0-9]{{1,3}}$'))"
).format(", ".join(f"'{w}'" for w in names.JUNK_WORDS), "|".join(names.JUNK_HEADS), "|".join(names.JUNK_LABELS))
STATE_SQL = (
    r"upper(coalesce(nullif(regexp_extract(coalesce(address, ''), '(?:,\s*|\s+)([A-Z]{2})\s*(?:[0-9]{5}(?:-[0-9]{4})?)?\s*$', 1), ''), "
    r"nullif(trim(%s), '')))"
)
CITY_SQL = (
    r"nullif(trim(coalesce(nullif(regexp_extract(coalesce(address, ''), ',\s*([^,]+)\s*,\s*[A-Z]{2}\s*(?:[0-9]{5}(?:-[0-9]{4})?)?\s*$', 1), ''), "
    r"nullif(regexp_extract(coalesce(address, ''), '^\s*[0-9]+[^,]*,\s*([^,]+)\s*,\s*[A-Z]{2}', 1), ''))), '')"
)
NORM_SQL = (
    r"trim(regexp_replace(upper(regexp_replace(regexp_replace(regexp_replace(coalesce(trim({0}), ''), '\s+&\s+', ' and ', 'gi'), "
    r"',?\s+(inc|llc|corp|ltd)\.?$', '', 'gi'), '[^\w\s]', ' ', 'g')), '\s+', ' ', 'g'))"
)
NAME_SQL = NORM_SQL.format("name")
DOLLARS_SQL = "CASE WHEN {0} IS NULL THEN '' ELSE '$' || format('{{:,.2f}}', CAST({0} AS DOUBLE)) END"


@query("f1_junk_names", f"SELECT creditor_id, {JUNK_SQL} AS is_junk FROM creditors")
def _(t):
    return t.creditors.select("creditor_id", names.is_junk_name(F.col("name")).alias("is_junk"))


@query("f2_suppressed_names", "SELECT creditor_id, lower(name) LIKE '%bank%' OR lower(name) LIKE '%trust%' OR lower(name) LIKE '%form%' AS suppressed FROM creditors")
def _(t):
    return t.creditors.select("creditor_id", names.holds_any(F.col("name"), ["Bank", "trust", "FORM"]).alias("suppressed"))


@query("f3_keyword_hits", "SELECT doc_id, coalesce(lower(text) LIKE '%license%' OR lower(text) LIKE '%password%', false) AS hit FROM documents")
def _(t):
    return t.documents.select("doc_id", names.holds_any(F.col("text"), ["license", "password"]).alias("hit"))


@query("f5_target_states", "SELECT DISTINCT upper(substr(trim(state), 1, 2)) AS state FROM target_states WHERE active")
def _(t):
    return linking.active_target_states(t.target_states)


@query("f6_target_flags", "SELECT filing_id, state IN (SELECT state FROM target_states WHERE active) AS is_target FROM filings")
def _(t):
    return linking.with_target_flag(t.filings, linking.active_target_states(t.target_states)).select("filing_id", "is_target")


@query("f7_monitored_cases", "SELECT filing_id, case_number, debtor_name, state FROM filings WHERE order_status = 'O' AND chapter <> 'unknown'")
def _(t):
    return t.filings.where((F.col("order_status") == "O") & (F.col("chapter") != "unknown")).select("filing_id", "case_number", "debtor_name", "state")


@query(
    "f8_discovered_cases",
    "SELECT filing_id, case_number, filing_date, coalesce(nullif(chapter, 'unknown'), '11') AS chapter, "
    "coalesce(nullif(trim(debtor_name), ''), 'Unknown Debtor') AS title FROM filings WHERE filing_date <= DATE '2000-06-30'",
)
def _(t):
    return feeds.discovered(t.filings, "2000-06-30")


@query(
    "f9_document_candidates",
    r"SELECT filing_id, document_id, source_id, filed_on FROM docket_docs WHERE regexp_matches(lower(description), "
    r"'\b([0-9]+|twenty|thirty)\s+largest\b|\blargest\s+unsecured\b') AND NOT regexp_matches(lower(description), "
    r"'\b(motion|order|notice|affidavit|certificate|declaration|hearing|agenda|objection|application|stipulation|response)\b') AND is_available AND path IS NOT NULL",
)
def _(t):
    return ranking.document_candidates(t.docket_docs).select("filing_id", "document_id", "source_id", "filed_on")


F10_SQL = f"""SELECT filing_id, creditor_id, name, claim_amount, {STATE_SQL % 'state'} AS creditor_state, {NAME_SQL} AS normalized_name
FROM creditors JOIN links USING (creditor_id) JOIN (SELECT filing_id, state FROM filings) f USING (filing_id) WHERE is_company AND NOT {JUNK_SQL}"""


@query("f10_company_creditors", F10_SQL)
def _(t):
    return linking.company_creditors(t.creditors, t.links, t.filings)


@query("f11_company_creditor_counts", f"SELECT filing_id, count(*) AS n FROM ({F10_SQL}) GROUP BY filing_id")
def _(t):
    return linking.company_creditors(t.creditors, t.links, t.filings).groupBy("filing_id").agg(F.count("*").alias("n"))


@query(
    "f12_review_page",
    "SELECT job_id, filing_id, total FROM (SELECT job_id, filing_id, created_at, count(*) OVER () AS total FROM jobs WHERE status = 'failed') "
    "ORDER BY created_at DESC, job_id DESC LIMIT 20 OFFSET 40",
)
def _(t):
    return ranking.review_page(t.jobs, "failed", 20, 40).select("job_id", "filing_id", "total")


@query("n1_company_names", f"SELECT creditor_id, {NAME_SQL} AS normalized_name FROM creditors")
def _(t):
    return t.creditors.select("creditor_id", names.company_name(F.col("name")).alias("normalized_name"))


KEY_SQL = rf"md5({NAME_SQL} || '|' || upper(trim(regexp_replace(coalesce(address, ''), '\s+', ' ', 'g'))))"


@query("n2_company_keys", f"SELECT creditor_id, {KEY_SQL} AS cache_key FROM creditors")
def _(t):
    return t.creditors.select("creditor_id", names.company_key(F.col("name"), F.col("address")).alias("cache_key"))


@query(
    "n3_lookup_rows",
    f"SELECT creditor_id, {NAME_SQL} AS normalized_name, {KEY_SQL} AS cache_key, coalesce(trim(name), '') AS lookup_name, "
    "coalesce(trim(address), '') AS lookup_address FROM creditors",
)
def _(t):
    return t.creditors.select(
        "creditor_id", names.company_name(F.col("name")).alias("normalized_name"), names.company_key(F.col("name"), F.col("address")).alias("cache_key"),
        F.coalesce(F.trim("name"), F.lit("")).alias("lookup_name"), F.coalesce(F.trim("address"), F.lit("")).alias("lookup_address"),
    )


@query(
    "n4_cache_hits",
    f"SELECT creditor_id, k.company_id IS NOT NULL AS hit FROM (SELECT creditor_id, {KEY_SQL} AS cache_key FROM creditors) c LEFT JOIN "
    f"(SELECT {KEY_SQL} AS cache_key, company_id FROM creditors WHERE creditor_id % 2 = 0 AND company_id IS NOT NULL AND created_on > DATE '1998-01-01') k USING (cache_key)",
)
def _(t):
    key = names.company_key(F.col("name"), F.col("address")).alias("cache_key")
    cache = t.creditors.where("creditor_id % 2 = 0 AND company_id IS NOT NULL").select(key, "company_id", F.col("created_on").alias("expires"))
    live = cache.where(F.col("expires") > F.lit("1998-01-01").cast("date"))
    return t.creditors.select("creditor_id", key).join(live, "cache_key", "left").select("creditor_id", F.col("company_id").isNotNull().alias("hit"))


@query("c1_creditor_states", f"SELECT creditor_id, {STATE_SQL % 'home_state'} AS state FROM creditors")
def _(t):
    return t.creditors.select("creditor_id", places.address_state(F.col("address"), F.col("home_state")).alias("state"))


@query("c2_creditor_cities", f"SELECT creditor_id, {CITY_SQL} AS city FROM creditors")
def _(t):
    return t.creditors.select("creditor_id", places.address_city(F.col("address")).alias("city"))


@query("c3_money_text", f"SELECT filing_id, creditor_id, part_id, line_number, {DOLLARS_SQL.format('amount')} AS claim FROM claims")
def _(t):
    return t.claims.select("filing_id", "creditor_id", "part_id", "line_number", money.dollars(F.col("amount")).alias("claim"))


@query(
    "c4_profile_urls",
    "SELECT creditor_id, CASE WHEN coalesce(trim(company_id), '') = '' THEN '' ELSE 'https://x.test/' || trim(company_id) || '/o' END AS url FROM creditors",
)
def _(t):
    return t.creditors.select("creditor_id", places.filled_template(F.col("company_id"), "https://x.test/{id}/o").alias("url"))


TIER_SQL = "CASE WHEN revenue >= {0} OR employees >= {1} THEN {2}"


@query(
    "c5_tiers_by_table",
    "SELECT creditor_id, CASE WHEN revenue >= 1000000000 OR employees >= 5000 THEN 1 WHEN revenue >= 100000000 OR employees >= 500 THEN 2 ELSE 3 END AS tier, "
    "CASE WHEN revenue IS NULL AND employees IS NULL THEN 'default_null_firmographics' "
    "WHEN (revenue >= 1000000000 AND employees >= 5000) THEN 'revenue_and_employees' WHEN revenue >= 1000000000 THEN 'revenue' WHEN employees >= 5000 THEN 'employees' "
    "WHEN (revenue >= 100000000 AND employees >= 500) THEN 'revenue_and_employees' WHEN revenue >= 100000000 THEN 'revenue' WHEN employees >= 500 THEN 'employees' "
    "WHEN revenue >= 0 AND employees >= 0 THEN 'revenue_and_employees' WHEN revenue >= 0 THEN 'revenue' WHEN employees >= 0 THEN 'employees' ELSE 'fallback_smb' END AS matched_on FROM firmographics",
)
def _(t):
    tier, why = money.tier_by_table(F.col("revenue"), F.col("employees"))
    return t.firmographics.select("creditor_id", tier.alias("tier"), why.alias("matched_on"))


@query(
    "c6_tiers_by_constants",
    "SELECT creditor_id, CASE WHEN revenue IS NULL AND employees IS NULL THEN NULL WHEN revenue // 1000 >= 1000000 OR employees >= 5000 THEN 1 "
    "WHEN revenue // 1000 >= 100000 OR employees >= 500 THEN 2 ELSE 3 END AS tier FROM firmographics",
)
def _(t):
    return t.firmographics.select("creditor_id", money.tier_by_constants(F.expr("revenue div 1000"), F.col("employees")).alias("tier"))


@query(
    "c7_labels",
    "SELECT filing_id, CASE chapter WHEN '11' THEN 'Chapter 11' WHEN '7' THEN 'Chapter 7' WHEN '11-Subchapter-V' THEN 'Chapter 11' ELSE '' END AS chapter_label FROM filings",
)
def _(t):
    known = F.create_map(*map(F.lit, ("11", "Chapter 11", "7", "Chapter 7", "11-Subchapter-V", "Chapter 11")))
    return t.filings.select("filing_id", F.coalesce(F.element_at(known, F.col("chapter")), F.lit("")).alias("chapter_label"))


@query(
    "c8_midpoints",
    "SELECT creditor_id, CAST(CASE WHEN revenue IS NOT NULL AND employees IS NOT NULL THEN (revenue + employees) / 2 ELSE coalesce(revenue, employees) END AS DOUBLE) AS mid, "
    "CASE WHEN revenue IS NOT NULL AND employees IS NOT NULL THEN (revenue + employees) // 2 ELSE coalesce(revenue, employees) END AS whole_mid FROM firmographics",
)
def _(t):
    a, b = F.col("revenue"), F.col("employees")
    return t.firmographics.select("creditor_id", money.midpoint(a, b).cast("double").alias("mid"), money.whole_midpoint(a, b).alias("whole_mid"))


LOSS_SQL = "CASE WHEN regexp_matches(regexp_replace(loss, '[^0-9.-]', '', 'g'), '^-?[0-9]+(\\.[0-9]+)?$') THEN CAST(regexp_replace(loss, '[^0-9.-]', '', 'g') AS DECIMAL(15,2)) END"
SAFE_SQL = "CASE WHEN regexp_matches(regexp_replace(loss, '[^0-9.]', '', 'g'), '^[0-9]+(\\.[0-9]+)?$') THEN CAST(regexp_replace(loss, '[^0-9.]', '', 'g') AS DECIMAL(15,2)) END"
FEED_STATE_SQL = "CASE WHEN regexp_matches(trim(state), '^[A-Za-z]{2}$') THEN upper(trim(state)) END"


@query("c9_losses", f"SELECT case_key, part_id, line_number, {LOSS_SQL} AS loss_amount, {SAFE_SQL} AS safe_amount FROM feed")
def _(t):
    loss = F.col("loss")
    return t.feed.select("case_key", "part_id", "line_number", money.loss_amount(loss).alias("loss_amount"), money.safe_numeric(loss).alias("safe_amount"))


@query("c10_state_codes", f"SELECT case_key, part_id, line_number, {FEED_STATE_SQL} AS state FROM feed")
def _(t):
    return t.feed.select("case_key", "part_id", "line_number", places.state_code(F.col("state")).alias("state"))


@query(
    "c11_addresses",
    f"SELECT case_key, part_id, line_number, nullif(concat_ws(', ', nullif(trim(city), ''), {FEED_STATE_SQL}), '') AS address FROM feed",
)
def _(t):
    return t.feed.select("case_key", "part_id", "line_number", places.city_state(F.col("city"), places.state_code(F.col("state"))).alias("address"))


@query(
    "c12_docket_numbers",
    "SELECT case_key, part_id, line_number, coalesce(nullif(regexp_extract(case_number, '(?i)([0-9]{2})-?bk-?([0-9]+)', 1), '') || '-' || "
    "regexp_extract(case_number, '(?i)([0-9]{2})-?bk-?([0-9]+)', 2), nullif(regexp_extract(case_number, '([0-9]{2}-[0-9]+)', 1), ''), case_number) AS docket FROM feed",
)
def _(t):
    return t.feed.select("case_key", "part_id", "line_number", places.docket_number(F.col("case_number")).alias("docket"))


@query("c13_document_keys", "SELECT filing_id, 'cases/' || regexp_replace(case_number || ' ' || debtor_name, '[^A-Za-z0-9._-]', '-', 'g') || '.pdf' AS k FROM filings")
def _(t):
    return t.filings.select("filing_id", places.document_key(F.concat("case_number", F.lit(" "), "debtor_name")).alias("k"))


COURT_SQL = "CASE regexp_replace(lower(trim({0})), 'k$', '') WHEN 'maeb' THEN 'mieb' ELSE regexp_replace(lower(trim({0})), 'k$', '') END"


@query("c14_court_bases", f"SELECT filing_id, {COURT_SQL.format('court_id')} AS court FROM filings")
def _(t):
    return t.filings.select("filing_id", places.court_base(F.col("court_id")).alias("court"))


@query(
    "c15_typed_config",
    "SELECT coalesce(max(CASE WHEN account_id = 3 THEN account_name END), 'x') AS name_3, coalesce(max(CASE WHEN account_id = 4 THEN TRY_CAST(account_name AS INT) END), 7) AS number_4, "
    "coalesce(max(CASE WHEN account_id = -1 THEN 1 END) = 1, true) AS flag_99 FROM accounts",
)
def _(t):
    rows = t.accounts.select(F.concat(F.lit("k"), F.col("account_id").cast("string")).alias("key"), F.col("account_name").alias("value"))
    out = incremental.typed_config(rows, {"k3": ("text", "x"), "k4": ("int", 7), "k-1": ("bool", True)})
    return out.toDF("name_3", "number_4", "flag_99")


@query(
    "c17_entity_types",
    r"""SELECT case_key, part_id, line_number, CASE WHEN regexp_matches(n, '(?i)\b(llc|l\.l\.c\.|inc\.?|corp\.?|corporation|ltd\.?|lp|llp|co\.)\b') THEN 'company'
      WHEN regexp_matches(n, '(?i)(\band\b|&)') AND len(regexp_split_to_array(trim(n), '\s+')) >= 3 THEN 'individual'
      WHEN len(regexp_split_to_array(trim(n), '\s+')) >= 2 AND regexp_matches(regexp_split_to_array(trim(n), '\s+')[1], '^[A-Z]')
        AND regexp_matches(regexp_split_to_array(trim(n), '\s+')[2], '^[A-Z]') THEN 'individual' ELSE 'company' END AS entity_type
      FROM (SELECT *, creditor || CASE part_id % 4 WHEN 0 THEN ' LLC' WHEN 1 THEN ' and Sons' WHEN 2 THEN ' Smith' ELSE ' store' END AS n FROM feed)""",
)
def _(t):
    tail = F.when(F.col("part_id") % 4 == 0, " LLC").when(F.col("part_id") % 4 == 1, " and Sons").when(F.col("part_id") % 4 == 2, " Smith").otherwise(" store")
    return t.feed.select("case_key", "part_id", "line_number", names.entity_type(F.concat("creditor", tail)).alias("entity_type"))


@query(
    "c19_review_reasons",
    "SELECT doc_id, CASE WHEN ocr AND valid_rows < 20 THEN 'low_priority,' ELSE '' END || CASE WHEN flagged THEN 'creditor_name' ELSE 'low_confidence' END AS reason FROM metas",
)
def _(t):
    weak = F.when(F.col("ocr") & (F.col("valid_rows") < 20), "low_priority")
    return t.metas.select("doc_id", F.concat_ws(",", weak, F.when(F.col("flagged"), "creditor_name").otherwise("low_confidence")).alias("reason"))


@query(
    "c20_dedup_keys",
    r"SELECT creditor_id, trim(concat_ws(' ', trim(regexp_replace(regexp_replace(lower(name), '[^\w\s]', ' ', 'g'), '\s+', ' ', 'g')), "
    r"trim(regexp_replace(regexp_replace(lower(coalesce(address, '')), '[^\w\s]', ' ', 'g'), '\s+', ' ', 'g')))) AS key FROM creditors",
)
def _(t):
    return t.creditors.select("creditor_id", names.dedup_key(F.col("name"), F.col("address")).alias("key"))


@query("c21_schedule_costs", "SELECT filing_id, document_id, source_id, filed_on, CAST(least(page_count * CAST(0.1 AS DOUBLE), CAST(4.5 AS DOUBLE)) AS DECIMAL(6,2)) AS cost FROM docket_docs")
def _(t):
    return t.docket_docs.select("filing_id", "document_id", "source_id", "filed_on", money.schedule_cost(F.col("page_count")).alias("cost"))


@query(
    "s2_validated_claims",
    f"SELECT case_key, part_id, line_number, {FEED_STATE_SQL} AS state, {LOSS_SQL} AS loss, nullif(concat_ws(',', CASE WHEN trim(creditor) = '' THEN 'creditor' END, "
    f"CASE WHEN trim(case_number) = '' THEN 'case_number' END), '') AS rejected_for, CASE WHEN trim(state) <> '' AND {FEED_STATE_SQL} IS NULL THEN 'unusable state' END AS warning FROM feed",
)
def _(t):
    return feeds.validate_claims(t.feed).select("case_key", "part_id", "line_number", "state", "loss", "rejected_for", "warning")


@query("f4_kept_states", f"SELECT count(*) AS kept FROM feed WHERE {FEED_STATE_SQL} IN ('TX', 'NY')")
def _(t):
    return feeds.keep_states(feeds.validate_claims(t.feed), ["TX", "NY"]).agg(F.count("*").alias("kept"))


@query("s3_table_scan", "SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 1000")
def _(t):
    return t.supplier.where("s_acctbal > 1000").select("s_suppkey", "s_name")
