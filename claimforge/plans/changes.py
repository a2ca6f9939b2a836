"""Queries for upserts, extraction, fuzzy dedup, incremental state and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimforge.operators import extraction, fuzzy, incremental, merging
from claimforge.plans.registry import query
from claimforge.plans.relations import LINKS_SQL
from claimforge.plans.scalars import JUNK_SQL
from claimforge.session import shared_folder
from claimforge.sources import feeds
from claimforge.streaming import feeds as streams
from claimforge.streaming import ledger

BATCH_SQL = """SELECT filing_id, creditor_id, part_id, line_number, (creditor_id % 3 + 1) * 1000000000 + filing_id * 10 + line_number AS arrival, name AS creditor_name, address, amount,
    CASE WHEN part_id % 4 = 0 THEN 'orig ' || CAST(part_id AS STRING) END AS original_name, CASE WHEN part_id % 2 = 0 THEN CAST(part_id % 100 AS DOUBLE) / 100 END AS confidence,
    CASE part_id % 3 WHEN 0 THEN 'company' WHEN 1 THEN 'individual' END AS entity_type FROM claims JOIN (SELECT creditor_id, name, address FROM creditors) c USING (creditor_id)"""


def _batch(t, *more):
    return (
        t.claims.join(t.creditors.select("creditor_id", F.col("name").alias("creditor_name"), "address"), "creditor_id")
        .select(
            "filing_id", F.struct(((F.col("creditor_id") % 3 + 1) * 1000000000 + F.col("filing_id") * 10 + F.col("line_number")).alias("a"), "part_id", "amount").alias("arrival"),
            "creditor_name", "address", F.col("amount").alias("claim_amount"),
            F.when(F.col("part_id") % 4 == 0, F.concat(F.lit("orig "), F.col("part_id").cast("string"))).alias("original_name"),
            F.when(F.col("part_id") % 2 == 0, (F.col("part_id") % 100).cast("double") / 100).alias("confidence"),
            F.when(F.col("part_id") % 3 == 0, "company").when(F.col("part_id") % 3 == 1, "individual").alias("entity_type"), *more,
        )
    )


def _store(t):
    return t.creditors.where("creditor_id % 2 = 0").select(
        "name", "address", "claim_amount", "original_name", F.lit(None).cast("double").alias("confidence"), "source_filing_id", "is_company"
    )


@query(
    "u1_merged_creditors",
    f"""WITH b AS (SELECT *, lower(trim(creditor_name)) AS nk, lower(coalesce(nullif(trim(address), ''), '')) AS ak, (arrival, part_id, amount) AS o FROM ({BATCH_SQL})),
      n AS (SELECT nk, ak, sum(amount) AS claim, count(*) AS n, arg_min(trim(creditor_name), o) AS name, arg_min(nullif(trim(address), ''), o) FILTER (WHERE nullif(trim(address), '') IS NOT NULL) AS address,
        arg_min(original_name, o) FILTER (WHERE original_name IS NOT NULL) AS original_name, arg_min(confidence, o) FILTER (WHERE confidence IS NOT NULL) AS confidence,
        arg_min(filing_id, o) AS source_filing_id, arg_min(coalesce(entity_type = 'company', true), o) AS is_company FROM b WHERE nk <> '' AND NOT {JUNK_SQL.replace('(name)', '(creditor_name)')} GROUP BY nk, ak),
      s AS (SELECT lower(trim(name)) AS nk, lower(trim(coalesce(address, ''))) AS ak, * FROM creditors WHERE creditor_id % 2 = 0)
      SELECT nk AS name_key, ak AS address_key, CAST(CASE WHEN s.name IS NOT NULL AND n.n IS NOT NULL THEN coalesce(s.claim_amount, 0) + coalesce(claim, 0) WHEN s.name IS NOT NULL THEN s.claim_amount
        WHEN n > 1 THEN coalesce(claim, 0) ELSE claim END AS DECIMAL(15,2)) AS claim_amount, coalesce(s.original_name, n.original_name) AS original_name, n.confidence AS confidence,
        coalesce(s.source_filing_id, n.source_filing_id) AS source_filing_id, coalesce(s.is_company, n.is_company) AS is_company FROM s FULL JOIN n USING (nk, ak)""",
)
def _(t):
    store = _store(t)
    return merging.merge_creditors(store, _batch(t)).drop("name", "address")


@query("u1b_merged_once", f"SELECT count(*) AS n FROM (SELECT DISTINCT lower(trim(creditor_name)), lower(coalesce(address, '')) FROM ({BATCH_SQL}) WHERE NOT {JUNK_SQL.replace('(name)', '(creditor_name)')})")
def _(t):
    return merging.merge_creditors(_store(t).limit(0), _batch(t), additive=False).agg(F.count("*").alias("n"))


AUDITED = "part_id % 10 < 3"


@query(
    "u1c_merged_audits",
    f"""WITH b AS (SELECT lower(trim(creditor_name)) AS nk, lower(coalesce(nullif(trim(address), ''), '')) AS ak, (arrival, part_id, amount) AS o, * FROM ({BATCH_SQL}) WHERE {AUDITED} AND NOT {JUNK_SQL.replace('(name)', '(creditor_name)')}),
      n AS (SELECT nk, ak, count(*) AS n, arg_max('g' || CAST(filing_id AS STRING), o) AS g, list_distinct(flatten(list(['part ' || CAST(part_id % 6 AS STRING), 'shared']))) AS names, list_distinct(list(line_number)) AS lines FROM b GROUP BY nk, ak),
      s AS (SELECT lower(trim(name)) AS nk, lower(trim(coalesce(address, ''))) AS ak, creditor_id % 4 = 0 AS audited FROM creditors WHERE creditor_id % 2 = 0),
      j AS (SELECT nk, ak, coalesce(audited, false) AS a, n, g, CASE WHEN audited THEN list_distinct(coalesce(names, []) || ['old', 'shared']) ELSE names END AS names, CASE WHEN audited THEN list_distinct(coalesce(lines, []) || [99]) ELSE lines END AS lines
        FROM s FULL JOIN n USING (nk, ak))
      SELECT nk AS name_key, ak AS address_key, coalesce(g, CASE WHEN a THEN 'stored' END) AS group_id, array_to_string(list_sort(names), '|') AS names, array_to_string(list_sort(lines), ',') AS lines,
        CAST(CASE WHEN a AND n IS NULL THEN 2 WHEN NOT a AND n = 1 THEN 5 ELSE greatest(1, len(names)) END AS INT) AS duplicate_count FROM j WHERE a OR n IS NOT NULL""",
)
def _(t):
    audit = lambda group, names, lines, n: F.struct(group.alias("dedup_group_id"), F.array(*names).alias("merged_names"), F.array(lines).alias("source_line_numbers"), F.lit(n).alias("duplicate_count"))
    old = audit(F.lit("stored"), (F.lit("old"), F.lit("shared")), F.lit(99), 2)
    store = t.creditors.where("creditor_id % 2 = 0").select(
        "name", "address", "claim_amount", "original_name", F.lit(None).cast("double").alias("confidence"), "source_filing_id", "is_company", F.when(F.col("creditor_id") % 4 == 0, old).alias("audit")
    )
    new = audit(F.concat(F.lit("g"), F.col("filing_id").cast("string")), (F.concat(F.lit("part "), (F.col("arrival.part_id") % 6).cast("string")), F.lit("shared")), F.col("line_number"), 5)
    batch = _batch(t, "line_number").withColumn("audit", F.when(F.col("arrival.part_id") % 10 < 3, new))
    out = merging.merge_creditors(store, batch).where("audit IS NOT NULL")
    lines = F.concat_ws(",", F.col("audit.source_line_numbers").cast("array<string>"))
    return out.select("name_key", "address_key", F.col("audit.dedup_group_id").alias("group_id"), F.concat_ws("|", "audit.merged_names").alias("names"), lines.alias("lines"), "audit.duplicate_count")


@query("u2_safe_numbers", "SELECT p_partkey, CAST(regexp_replace('-$' || CAST(p_size AS STRING) || '.5x', '[^0-9.]', '', 'g') AS DECIMAL(15,2)) AS amount FROM part")
def _(t):
    from claimforge.functions import money

    return t.part.select("p_partkey", money.safe_numeric(F.concat(F.lit("-$"), F.col("p_size").cast("string"), F.lit(".5x"))).alias("amount"))


U3_SQL = "SELECT case_number, debtor, filed FROM feed WHERE case_number <> '' QUALIFY row_number() OVER (PARTITION BY case_number ORDER BY filed DESC, line_number DESC, part_id DESC, debtor DESC) = 1"


@query("u3_upserted_filings", U3_SQL)
def _(t):
    rows = t.feed.where("case_number <> ''").select("case_number", "debtor", "filed", "line_number", "part_id")
    return merging.filings_from_feed(rows).select("case_number", "debtor", "filed")


@query(
    "u4_patched_filings",
    "SELECT f.filing_id, CASE WHEN f.filing_id % 2 = 0 AND f.filing_id % 3 > 0 THEN 'new' ELSE f.chapter END AS chapter, CASE WHEN f.filing_id % 2 = 0 THEN f.state ELSE f.state END AS state, "
    "f.filing_id % 5 = 0 OR (f.filing_id % 2 = 0 AND f.filing_id % 7 = 0) AS review FROM filings f",
)
def _(t):
    store = t.filings.select("filing_id", "chapter", "state", (F.col("filing_id") % 5 == 0).alias("review"))
    batch = t.filings.where("filing_id % 2 = 0").select(
        "filing_id", F.when(F.col("filing_id") % 3 > 0, "new").alias("chapter"), F.lit(None).cast("string").alias("state"), (F.col("filing_id") % 7 == 0).alias("review")
    )
    return merging.upsert(store, batch, ["filing_id"], {"chapter": "patch", "state": "patch", "review": "any"})


@query(
    "u5_case_status",
    "WITH o AS (SELECT DISTINCT filing_id FROM links WHERE filing_id % 2 = 0), n AS (SELECT DISTINCT filing_id FROM jobs) SELECT filing_id, CASE WHEN n.filing_id IS NOT NULL THEN 'monitored' ELSE 'new' END AS stage FROM o FULL JOIN n USING (filing_id)",
)
def _(t):
    store = t.links.where("filing_id % 2 = 0").select("filing_id").distinct().withColumn("stage", F.lit("new"))
    return merging.upsert(store, t.jobs.select("filing_id").distinct().withColumn("stage", F.lit("monitored")), ["filing_id"], {"stage": "patch"})


@query(
    "u6_docket_entries",
    """SELECT filing_id, document_number, left(arg_max(description, (filed_on, document_id, source_id)), 500) AS title, max(filed_on) AS filed_on, arg_max(page_count, (filed_on, document_id, source_id)) AS page_count,
      arg_max(path, (filed_on, document_id, source_id)) FILTER (WHERE path IS NOT NULL) AS path FROM docket_docs WHERE trim(document_number) <> '' GROUP BY filing_id, document_number""",
)
def _(t):
    return merging.upsert_docket(t.docket_docs)


@query("u7_parse_results", "SELECT filing_id, job_type, arg_max(status, (created_at, job_id)) AS status FROM jobs GROUP BY filing_id, job_type")
def _(t):
    return merging.last_per_key(t.jobs.select("filing_id", "job_type", "status", "created_at", "job_id"), ["filing_id", "job_type"], ["created_at", "job_id"]).select("filing_id", "job_type", "status")


@query("u8_accounts", "SELECT account_id, CASE WHEN account_id % 4 = 0 THEN 'new' ELSE segment END AS segment FROM accounts")
def _(t):
    batch = t.accounts.where("account_id % 2 = 0").select("account_id", F.when(F.col("account_id") % 4 == 0, "new").alias("segment"))
    return merging.upsert(t.accounts.select("account_id", "segment"), batch, ["account_id"], {"segment": "patch"})


@query("u9_company_cache", "SELECT company_id, max(created_on) + greatest(0, 1) AS expires_on FROM creditors WHERE coalesce(trim(company_id), '') <> '' GROUP BY company_id")
def _(t):
    rows = t.creditors.where(F.coalesce(F.trim("company_id"), F.lit("")) != "")
    return merging.last_per_key(rows.select("company_id", "created_on"), ["company_id"], ["created_on"]).select("company_id", F.date_add("created_on", 1).alias("expires_on"))


@query(
    "u10_replaced_contacts",
    """WITH b AS (SELECT creditor_id, part_id, 'new' AS origin FROM (SELECT creditor_id, part_id, row_number() OVER (PARTITION BY creditor_id ORDER BY amount DESC NULLS LAST, part_id, filing_id, line_number) AS k FROM claims WHERE creditor_id % 3 = 0) WHERE k <= 3)
      SELECT * FROM b UNION ALL SELECT DISTINCT creditor_id, part_id, 'old' FROM claims WHERE part_id < 5 AND creditor_id NOT IN (SELECT creditor_id FROM b)""",
)
def _(t):
    from claimforge.operators import ranking

    new = t.claims.where("creditor_id % 3 = 0").select(
        "creditor_id", "part_id", F.lit("x").alias("full_name"), F.col("amount").alias("engagement"), F.struct("part_id", "filing_id", "line_number").alias("contact_id")
    )
    old = t.claims.where("part_id < 5").select("creditor_id", "part_id").distinct().withColumn("origin", F.lit("old"))
    return merging.replace_groups(old, ranking.top_contacts(new).select("creditor_id", "part_id").withColumn("origin", F.lit("new")), "creditor_id")


@query("u11_staged_results", "SELECT account_id, segment || CASE WHEN account_id % 2 = 0 THEN '/new' ELSE '/old' END || CASE WHEN account_id % 2 = 0 THEN '/added' ELSE '' END AS entries FROM accounts")
def _(t):
    old = t.accounts.select("account_id", F.create_map(F.lit("a"), "segment", F.lit("b"), F.lit("old")).alias("m"))
    new = t.accounts.where("account_id % 2 = 0").select("account_id", F.create_map(F.lit("b"), F.lit("new"), F.lit("c"), F.lit("added")).alias("m"))
    out = merging.add_results(old, new, ["account_id"], "m")
    return out.select("account_id", F.concat_ws("/", F.element_at("m", "a"), F.try_element_at("m", F.lit("b")), F.try_element_at("m", F.lit("c"))).alias("entries"))


DOC_STORE_SQL = "SELECT content_sha256, parser, min(linked_filing) AS linked_filing FROM metas WHERE {} GROUP BY content_sha256, parser"


@query(
    "u12_documents",
    f"SELECT content_sha256, parser, coalesce(s.linked_filing, b.linked_filing) AS linked_filing FROM ({DOC_STORE_SQL.format('doc_id % 3 > 0')}) s FULL JOIN ({DOC_STORE_SQL.format('doc_id % 2 = 0')}) b USING (content_sha256, parser)",
)
def _(t):
    one = lambda cond: t.metas.where(cond).groupBy("content_sha256", "parser").agg(F.min("linked_filing").alias("linked_filing"))
    return merging.upsert_documents(one("doc_id % 3 > 0"), one("doc_id % 2 = 0"))[0]


@query("u13_linked_documents", "SELECT doc_id, coalesce(linked_filing, filing_id) AS linked_filing FROM metas")
def _(t):
    return merging.upsert(t.metas.select("doc_id", "linked_filing"), t.metas.select("doc_id", F.col("filing_id").alias("linked_filing")), ["doc_id"], {"linked_filing": "keep"})


@query(
    "u14_cleared_filings",
    "SELECT filing_id FROM (SELECT filing_id, CASE WHEN doc_id % 2 = 0 AND flagged THEN 'resolved' WHEN flagged THEN 'pending' ELSE 'done' END AS s FROM metas) GROUP BY filing_id HAVING NOT bool_or(s = 'pending')",
)
def _(t):
    reviews = t.metas.select("doc_id", "filing_id", F.when(F.col("flagged"), "pending").otherwise("done").alias("status"))
    return merging.resolve_reviews(reviews, t.metas.where("doc_id % 2 = 0"))[1]


@query("u15_replaced_rows", "SELECT filing_id, count(*) AS n FROM (SELECT filing_id FROM claims WHERE flag = 'A' AND filing_id NOT IN (SELECT filing_id FROM claims WHERE flag = 'N') UNION ALL SELECT filing_id FROM claims WHERE flag = 'N') GROUP BY filing_id")
def _(t):
    pick = lambda f: t.claims.where(F.col("flag") == f).select("filing_id", "creditor_id", "amount")
    return merging.replace_groups(pick("A"), pick("N"), "filing_id").groupBy("filing_id").agg(F.count("*").alias("n"))


DUP_SQL = "SELECT creditor_id, 'n' || CAST(creditor_id % 40 AS STRING) AS name, CASE WHEN creditor_id % 3 = 0 THEN 'a' END AS address, created_on FROM creditors"


@query(
    "u16_deduped_links",
    f"""WITH c AS ({DUP_SQL}), k AS (SELECT creditor_id, first_value(creditor_id) OVER (PARTITION BY name, coalesce(address, '') ORDER BY created_on, creditor_id) AS keeper FROM c)
      SELECT DISTINCT filing_id, keeper AS creditor_id FROM links JOIN k USING (creditor_id)""",
)
def _(t):
    rows = t.creditors.select(
        "creditor_id", F.concat(F.lit("N"), (F.col("creditor_id") % 40).cast("string")).alias("name"), F.when(F.col("creditor_id") % 3 == 0, "A ").alias("address"), "created_on"
    )
    return merging.dedupe_store(rows, t.links)[1]


@query(
    "u16b_moved_accounts",
    f"""WITH c AS ({DUP_SQL}), k AS (SELECT creditor_id, first_value(creditor_id) OVER (PARTITION BY name, coalesce(address, '') ORDER BY created_on, creditor_id) AS keeper FROM c),
      a AS (SELECT DISTINCT creditor_id, part_id % 50 AS account_id FROM claims), m AS (SELECT keeper, creditor_id, account_id FROM a JOIN k USING (creditor_id))
      SELECT keeper AS creditor_id, account_id, coalesce(max(creditor_id) FILTER (WHERE creditor_id = keeper), min(creditor_id)) AS made_for FROM m GROUP BY keeper, account_id""",
)
def _(t):
    rows = t.creditors.select(
        "creditor_id", F.concat(F.lit("N"), (F.col("creditor_id") % 40).cast("string")).alias("name"), F.when(F.col("creditor_id") % 3 == 0, "A ").alias("address"), "created_on"
    )
    accounts = t.claims.select("creditor_id", (F.col("part_id") % 50).alias("account_id"), F.col("creditor_id").alias("made_for")).distinct()
    return merging.dedupe_store(rows, t.links, t.links, accounts)[3]


@query(
    "u17_purged_creditors",
    f"SELECT creditor_id FROM creditors WHERE NOT ({JUNK_SQL} AND source_filing_id IS NULL AND creditor_id NOT IN (SELECT creditor_id FROM claims WHERE part_id < 100) AND creditor_id NOT IN (SELECT creditor_id FROM firmographics WHERE employees > 6000))",
)
def _(t):
    return merging.purge_orphan_junk(t.creditors, t.claims.where("part_id < 100"), t.firmographics.where("employees > 6000")).select("creditor_id")


@query(
    "u18_set_tiers",
    f"""SELECT creditor_id, coalesce(w.tier, company_tier) AS company_tier FROM creditors LEFT JOIN (SELECT creditor_id, arg_max(tier, filing_id) AS tier FROM
      (SELECT creditor_id, filing_id, CAST(filing_id % 5 AS INT) AS tier FROM {LINKS_SQL} l WHERE filing_id % 100 = 1 OR filing_id % 100 = 4) WHERE tier BETWEEN 1 AND 3 GROUP BY 1) w USING (creditor_id)""",
)
def _(t):
    wanted = t.filings.where("filing_id % 100 IN (1, 4)").select("filing_id").join(t.links, "filing_id").union(
        t.creditors.where("source_filing_id % 100 IN (1, 4)").select(F.col("source_filing_id"), "creditor_id")
    )
    return merging.set_tiers(t.creditors, wanted.withColumn("tier", (F.col("filing_id") % 5).cast("int")), t.links).select("creditor_id", "company_tier")


@query("u19_set_company_ids", "SELECT creditor_id, CASE WHEN creditor_id % 5 = 0 THEN 'v' || CAST(creditor_id AS STRING) ELSE company_id END AS company_id FROM creditors")
def _(t):
    wanted = t.creditors.select("creditor_id", F.when(F.col("creditor_id") % 5 == 0, F.concat(F.lit(" v"), F.col("creditor_id").cast("string"))).otherwise(" ").alias("new_id"))
    return merging.set_company_ids(t.creditors, wanted).select("creditor_id", "company_id")


@query("u20_config_changes", "SELECT account_id AS k, CASE WHEN account_id % 4 = 0 THEN 'INSERT' WHEN account_id % 5 = 0 THEN 'DELETE' ELSE 'UPDATE' END AS change FROM accounts WHERE account_id % 4 = 0 OR account_id % 5 = 0 OR account_id % 3 = 0")
def _(t):
    base = t.accounts.select(F.col("account_id").alias("k"), F.col("account_name").alias("v"))
    old = base.where("k % 4 > 0")
    new = base.where("k % 4 = 0 OR k % 5 > 0").withColumn("v", F.when(F.col("k") % 3 == 0, F.concat("v", F.lit("!"))).otherwise(F.col("v")))
    return merging.config_changes(old, new, "k").select("k", "change")


@query("u21_unmerged_documents", "SELECT doc_id FROM metas WHERE valid_rows > 0 AND NOT flagged AND doc_id NOT IN (SELECT doc_id FROM metas WHERE ocr)")
def _(t):
    return t.metas.where("valid_rows > 0 AND NOT flagged").select("doc_id").join(t.metas.where("ocr").select("doc_id"), "doc_id", "left_anti")


@query(
    "u23b_written_back",
    """WITH r AS (SELECT creditor_id, CASE WHEN creditor_id % 9 = 0 THEN 'failed' WHEN creditor_id % 4 > 0 THEN 'matched' ELSE 'no_match' END AS outcome, revenue, employees FROM firmographics WHERE creditor_id % 7 > 0)
      SELECT creditor_id, CASE WHEN outcome = 'matched' THEN 'v' || CAST(creditor_id AS STRING) ELSE company_id END AS company_id, CAST(CASE WHEN outcome = 'matched' THEN coalesce(CASE WHEN revenue IS NULL AND employees IS NULL THEN NULL
        WHEN coalesce(revenue >= 1000000, false) OR coalesce(employees >= 5000, false) THEN 1 WHEN coalesce(revenue >= 100000, false) OR coalesce(employees >= 500, false) THEN 2 ELSE 3 END, company_tier) ELSE company_tier END AS INT) AS company_tier,
        CASE WHEN outcome = 'matched' THEN 'Name ' || CAST(creditor_id AS STRING) END AS canonical_name, outcome, CASE WHEN outcome = 'matched' THEN 'company' WHEN creditor_id % 2 = 0 THEN 'person' END AS contact
      FROM creditors LEFT JOIN r USING (creditor_id)""",
)
def _(t):
    status = F.when(F.col("creditor_id") % 9 == 0, "limit").when(F.col("creditor_id") % 4 > 0, "full").when(F.col("creditor_id") % 8 == 0, "part")
    number = F.col("creditor_id").cast("string")
    results = t.firmographics.where("creditor_id % 7 > 0").select(
        "creditor_id", status.alias("status"), F.concat(F.lit("v"), number).alias("company_id"), F.concat(F.lit("Name "), number).alias("name"), "revenue", "employees"
    )
    contacts = t.creditors.where("creditor_id % 2 = 0").select("creditor_id", "company_id", F.col("name").alias("full_name"), F.lit("person").alias("kind"))
    out, contacts = merging.write_back(t.creditors, contacts, results)
    return out.select("creditor_id", "company_id", "company_tier", "canonical_name", "outcome").join(contacts.select("creditor_id", F.col("kind").alias("contact")), "creditor_id", "left")


@query(
    "u23_applied_enrichment",
    """WITH r AS (SELECT creditor_id, candidate_id, confidence, CASE WHEN name_key % 20 = 0 THEN 'failed' WHEN confidence * 10 < 0.7 THEN 'no_match' ELSE 'matched' END AS outcome FROM candidates),
      b AS (SELECT creditor_id, arg_max((outcome, 'c' || CAST(candidate_id AS STRING)), (confidence * 10, 'c' || CAST(candidate_id AS STRING))) AS x FROM (SELECT * FROM r QUALIFY count(*) OVER (PARTITION BY creditor_id, confidence, candidate_id) = 1) GROUP BY creditor_id)
      SELECT creditor_id, CASE WHEN x[1] = 'matched' THEN x[2] ELSE company_id END AS company_id, x[1] AS outcome FROM creditors LEFT JOIN b USING (creditor_id)""",
)
def _(t):
    from pyspark.sql import Window

    w = Window.partitionBy("creditor_id", "confidence", "candidate_id")
    rows = t.candidates.withColumn("n", F.count("*").over(w)).where("n = 1").select(
        "creditor_id", F.when(F.col("name_key") % 20 == 0, "e").alias("error"), (F.col("confidence") * 10).alias("score"), F.concat(F.lit("c"), F.col("candidate_id").cast("string")).alias("new_id")
    )
    return merging.apply_enrichment(t.creditors, rows)


@query("x2_merged_audits", "SELECT account_id AS k, account_name || '|' || account_name || 'Z' AS names, CAST(2 AS INT) AS duplicate_count FROM accounts")
def _(t):
    audit = lambda name: F.struct(F.lit("g").alias("dedup_group_id"), F.array(name).alias("merged_names"), F.array(F.lit(1)).alias("source_line_numbers"), F.lit(1).alias("duplicate_count"))
    both = t.accounts.select(F.col("account_id").alias("k"), audit(F.col("account_name")).alias("a"), audit(F.concat("account_name", F.lit("Z"))).alias("b"))
    return both.select("k", merging.merge_audits(F.col("a"), F.col("b")).alias("m")).select("k", F.concat_ws("|", "m.merged_names").alias("names"), "m.duplicate_count")


@query("s6_written_upsert", U3_SQL)
def _(t):
    rows = t.feed.where("case_number <> ''").select("case_number", "debtor", "filed", "line_number", "part_id")
    path = shared_folder(t.spark, "filings")
    merging.write_version(merging.filings_from_feed(rows.limit(0)).select("case_number", "debtor", "filed"), path)
    merging.write_version(merging.filings_from_feed(rows).select("case_number", "debtor", "filed"), path)
    return merging.read_version(t.spark, path)


T1_SQL = "SELECT doc_id, CASE WHEN a > 0 AND a >= b AND a >= c THEN 'form_201' WHEN b > 0 AND b >= c THEN 'creditor_matrix' WHEN c > 0 THEN 'schedule' ELSE 'unknown' END AS kind, greatest(a, b, c) AS score FROM (SELECT doc_id, {} AS a, {} AS b, {} AS c FROM x)"
_COUNT = lambda ps: " + ".join(f"CAST(regexp_matches(lower(text), '{p}') AS INT)" for p in ps)


T1_KINDS_SQL = "WITH x AS (SELECT doc_id, coalesce(text, '') AS text FROM documents) " + T1_SQL.format(*(_COUNT(extraction.ANCHORS[k]) for k in ("form_201", "creditor_matrix", "schedule")))


@query(
    "t1_document_kinds",
    "WITH x AS (SELECT filing_id AS doc_id, text FROM petitions UNION ALL SELECT filing_id, text FROM notices UNION ALL SELECT doc_id, coalesce(text, '') FROM documents) "
    + T1_SQL.format(*(_COUNT(extraction.ANCHORS[k]) for k in ("form_201", "creditor_matrix", "schedule"))),
)
def _(t):
    docs = t.petitions.select(F.col("filing_id").alias("doc_id"), "text").union(t.notices.select("filing_id", "text")).union(t.documents.select("doc_id", "text"))
    return extraction.classify(docs)


@query(
    "t1b_hinted_kinds",
    "SELECT filing_id, CASE WHEN filing_id % 5 = 0 THEN 'schedule' WHEN filing_id % 5 = 1 THEN 'form_201' ELSE 'creditor_matrix' END AS kind FROM notices",
)
def _(t):
    hint = F.when(F.col("filing_id") % 5 == 0, "Schedule ").when(F.col("filing_id") % 5 == 1, "form_201").when(F.col("filing_id") % 5 == 2, "no kind")
    return extraction.classify(t.notices.withColumn("hint", hint), "filing_id", hint_col="hint").select("filing_id", "kind")


def form_sql() -> str:
    """The fields by DuckDB's own functions."""
    first = lambda c: "coalesce(" + ", ".join(f"nullif(trim(regexp_extract(text, '(?i){p.replace(chr(39), chr(39) * 2)}', 1)), '')" for p in extraction.FORM_PATTERNS[c]) + f") AS {c}"

    def ends(section: str, patterns: tuple[str, ...], kind: str) -> tuple[str, str, str]:
        found = [f"nullif(regexp_extract({section}, '(?i){p}', {g}), '')" for p, g in zip((patterns[0], *patterns), (1, 2, 1, 1))]
        low, high, more, less = (f"TRY_CAST(replace({x}, ',', '') AS {kind})" for x in found)
        return (
            f"CASE WHEN {found[0]} IS NOT NULL THEN {low} WHEN {found[2]} IS NOT NULL THEN {more} END",
            f"CASE WHEN {found[0]} IS NOT NULL THEN {high} WHEN {found[2]} IS NULL THEN {less} END",
            f"coalesce({found[0]}, {found[2]}, {found[3]}) IS NOT NULL",
        )

    out = [first(c) for c in extraction.FORM_PATTERNS]
    for what in ("assets", "liabilities"):
        least, most, met = ends(what, extraction.DOLLAR_RANGES, "DECIMAL(15,2)")
        least_of, most_of, _ = ends(f"cells_{what}", extraction.DOLLAR_RANGES, "DECIMAL(15,2)")
        out += [f"CASE WHEN {met} THEN {least} ELSE {least_of} END AS least_{what}", f"CASE WHEN {met} THEN {most} ELSE {most_of} END AS most_{what}"]
    least, most, _ = ends("near_creditors", extraction.CREDITOR_RANGES, "INT")
    section = lambda text, label: f"CASE WHEN contains(lower({text}), '{label}') THEN substr({text}, strpos(lower({text}), '{label}'), 800) ELSE {text} END"
    at = "strpos(lower(text), 'creditor')"
    near = f"CASE WHEN {at} > 0 THEN substr(text, greatest({at} - 200, 1), {at} + 400 - greatest({at} - 200, 1)) ELSE text END"
    cells = "CASE WHEN filing_id % 3 = 0 THEN 'Summary ' || chr(10) || 'Total assets $' || (filing_id % 90 + 1) || ',000 or more' || chr(10) || 'Liabilities less than $8,000' END"
    return (
        f"WITH c AS (SELECT filing_id, text, {cells} AS cells FROM petitions), "
        f"s AS (SELECT filing_id, text, {section('text', 'estimated assets')} AS assets, {section('text', 'estimated liabilities')} AS liabilities, "
        f"{section('cells', 'assets')} AS cells_assets, {section('cells', 'liabilities')} AS cells_liabilities, {near} AS near_creditors FROM c) "
        f"SELECT filing_id, {', '.join(out)}, {least} AS least_creditors, {most} AS most_creditors FROM s"
    )


def petition_tables(t):
    """Tables of a third of the petitions, with ranges that some of the texts lack."""
    row = lambda *cells: F.array(*cells)
    assets = F.concat(F.lit("$"), (F.col("filing_id") % 90 + 1).cast("string"), F.lit(",000 or more"))
    rows = F.array(row(F.lit("Summary"), F.lit(None).cast("string")), row(F.lit("Total assets"), assets), row(F.lit("Liabilities"), F.lit("less than $8,000")))
    return t.petitions.where("filing_id % 3 = 0").select("filing_id", F.array(rows).alias("tables"))


@query("t2_form_fields", form_sql())
def _(t):
    return extraction.form_fields(t.petitions, tables=petition_tables(t))


BLOCK_SQL = r"""WITH b AS (SELECT filing_id, unnest(regexp_split_to_array(text, '\n{2,}')) AS raw, unnest(range(len(regexp_split_to_array(text, '\n{2,}')))) AS block FROM notices),
  l AS (SELECT *, list_filter(list_transform(string_split(raw, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS lines FROM b),
  n AS (SELECT *, TRY_CAST(nullif(regexp_extract(lines[1], '^([0-9]+)\.?\s+', 1), '') AS INT) AS line_number, trim(regexp_replace(lines[1], '^[0-9]+\.?\s+', '')) AS name FROM l
    WHERE len(lines) > 0 AND length(lines[1]) >= 3 AND NOT regexp_matches(lower(lines[1]), '^(list of creditors|creditor matrix|creditors holding|official form 204|20 largest unsecured|name of creditor|creditor\s*name)\b'))
  SELECT filing_id, CAST(block AS INT) AS block, line_number, name, CASE WHEN len(lines) > 1 THEN array_to_string(lines[2:3], ', ') END AS address,
    TRY_CAST(nullif(regexp_replace(regexp_extract(raw, '(\$\s*[0-9,]+(?:\.[0-9]+)?)', 1), '[^0-9.]', '', 'g'), '') AS DECIMAL(15,2)) AS claim_amount FROM n WHERE (line_number IS NOT NULL OR len(lines) >= 2 OR contains(raw, '$'))"""


@query("t3_creditor_blocks", BLOCK_SQL + f" AND NOT {JUNK_SQL}")
def _(t):
    return extraction.creditor_blocks(t.notices).drop("entity_type")


FLAT_SQL = r"""WITH b AS (SELECT filing_id, unnest(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g'))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM notices),
  g AS (SELECT *, sum(CAST(regexp_matches(line, '^[0-9]+\.\s+') AS INT)) OVER (PARTITION BY filing_id ORDER BY pos) AS block FROM b WHERE line <> ''),
  k AS (SELECT filing_id, block, list(line ORDER BY pos) AS lines FROM g WHERE block > 0 GROUP BY ALL)
  SELECT filing_id, CAST(block AS INT) AS block, TRY_CAST(nullif(regexp_extract(lines[1], '^([0-9]+)\.?\s+', 1), '') AS INT) AS line_number, trim(regexp_replace(lines[1], '^[0-9]+\.?\s+', '')) AS name,
    CASE WHEN len(lines) > 1 THEN array_to_string(lines[2:3], ', ') END AS address,
    TRY_CAST(nullif(regexp_replace(regexp_extract(array_to_string(lines, chr(10)), '(\$\s*[0-9,]+(?:\.[0-9]+)?)', 1), '[^0-9.]', '', 'g'), '') AS DECIMAL(15,2)) AS claim_amount FROM k"""


@query("t4_numbered_creditors", FLAT_SQL)
def _(t):
    return extraction.numbered_creditors(t.notices).drop("entity_type")


# Cells of one row a table: the name is the first that is no junk, then the rest by its place.
_JUNK_CELL = JUNK_SQL.replace("(name)", "(x)").replace("creditor\\s*name)", "creditor\\s*name)\\b")
_CLEAN = "regexp_replace(x, '[^0-9.]', '', 'g')"
_IS_AMOUNT = rf"(regexp_matches(x, '^[$0-9.,\s]+$') AND regexp_matches({_CLEAN}, '^([0-9]+\.?[0-9]*|\.[0-9]+)$'))"


def _sheet_sql(headed: str) -> str:
    return f"""WITH c AS (SELECT doc_id, list_transform(string_split(cells, '|'), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')) AS c FROM sheet_rows WHERE {headed}),
      k AS (SELECT doc_id, c, list_position(list_transform(c, lambda x: x <> '' AND NOT {_JUNK_CELL}), true) AS k FROM c),
      r AS (SELECT doc_id, c[k] AS name, list_filter(c[k + 1:], lambda x: x <> '' AND NOT {_JUNK_CELL} AND NOT {_IS_AMOUNT})[1] AS address, list_filter(c, lambda x: {_IS_AMOUNT})[-1] AS amount FROM k WHERE k > 0)
      SELECT doc_id, name, address, CAST(regexp_replace(amount, '[^0-9.]', '', 'g') AS DECIMAL(15,2)) AS claim_amount FROM r"""


def sheets(t):
    """Each row of ``sheet_rows`` as a document with one table."""
    parts = lambda c: F.split(c, r"\|", -1)
    return t.sheet_rows.select("doc_id", F.array(F.array(parts("head"), parts("cells"))).alias("tables"))


@query("t5_table_creditors", _sheet_sql("regexp_matches(lower(replace(head, '|', ' ')), 'creditor|name')"))
def _(t):
    return extraction.table_creditors(sheets(t)).select("doc_id", "name", "address", "claim_amount")


@query("t6_schedule_creditors", _sheet_sql("regexp_matches(lower(head), 'schedule e') OR (contains(lower(head), 'creditor') AND regexp_matches(lower(head), 'claim|amount'))"))
def _(t):
    return extraction.schedule_creditors(sheets(t)).select("doc_id", "name", "address", "claim_amount")


@query("t7_extracted_creditors")
def _(t):
    docs = t.notices.select(F.col("filing_id").alias("doc_id"), "text")
    return extraction.extract_creditors(docs, sheets(t).where("doc_id % 10 = 1").select(F.floor(F.col("doc_id") / 10).alias("doc_id"), "tables"))


@query(
    "t8_document_links",
    r"""WITH a AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*href=["'']([^"'']+)["''][^>]*>(.*?)</a>', 1)) AS href, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*href=["'']([^"'']+)["''][^>]*>(.*?)</a>', 2)) AS text,
       unnest(range(len(regexp_extract_all(html, '(?is)<a\s[^>]*href=["'']([^"'']+)["''][^>]*>(.*?)</a>', 1)))) AS pos FROM pages),
      f AS (SELECT page_id, arg_min(href, pos) AS href, arg_min(url, pos) AS url, arg_min(trim(regexp_replace(text, '<[^>]+>', '', 'g')), pos) AS text FROM a WHERE regexp_matches(trim(regexp_replace(text, '<[^>]+>', '', 'g')), '(?i)^t') GROUP BY page_id)
      SELECT page_id, CASE WHEN starts_with(href, 'http') THEN href WHEN starts_with(href, '/') THEN regexp_extract(url, '^(https?://[^/]+)', 1) || href ELSE regexp_extract(url, '^(https?://[^/]+/[^?#]*/|https?://[^/]+/)', 1) || href END AS document_url, text FROM f""",
)
def _(t):
    return extraction.document_links(t.pages, pattern="(?i)^t")


@query(
    "t9_feed_events",
    r"""WITH b AS (SELECT event_id, trim(regexp_replace(coalesce(title, ''), '\s+', ' ', 'g')) AS t, coalesce(content, '') AS c, trim(regexp_replace(regexp_replace(coalesce(content, ''), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS x,
       coalesce(link, '') AS l, coalesce(guid, link, '') AS g, strftime(published_at, '%Y-%m-%dT%H') AS iso FROM rss),
      k AS (SELECT *, nullif(regexp_extract(t, '(?i)([0-9]{2}-[0-9]{4,6}(?:-[a-z0-9]+)*)', 1), '') AS case_number FROM b),
      d AS (SELECT *, trim(regexp_replace(CASE WHEN case_number IS NOT NULL THEN left(t, strpos(t, case_number) - 1) || substr(t, strpos(t, case_number) + length(case_number)) ELSE t END, '\s+', ' ', 'g')) AS debtor, nullif(lower(regexp_extract(lower(l), 'ecf\.([a-z]+)\.uscourts\.gov', 1)), '') AS court_id FROM k),
      f AS (SELECT *, regexp_matches(lower(debtor), 'llc|inc|corp|corporation|ltd|lp|holdings|company|co\.|group|enterprises') AS is_business, regexp_matches(lower(x), 'proof of claim|meeting of creditors') AS excluded,
       CASE WHEN contains(lower(x), 'voluntary petition') THEN 40 ELSE 0 END + CASE WHEN contains(lower(x), 'petition filed') THEN 30 ELSE 0 END + CASE WHEN regexp_matches(lower(x), 'chapter\s*11') THEN 20 ELSE 0 END + CASE WHEN regexp_matches(lower(x), 'schedule f|schedule e/f|unsecured claims|list of creditors|creditor matrix|form 204|20 largest') THEN 15 ELSE 0 END AS signal FROM d)
      SELECT event_id, case_number, nullif(debtor, '') AS debtor_name, nullif(regexp_extract(lower(x), 'chapter[:\s]+([0-9]+)', 1), '') AS chapter, court_id, coalesce(nullif(regexp_extract(c, '(?i)href=[''"]([^''" ]*doc1[^''" ]+)[''"]', 1), ''), nullif(regexp_extract(c, '(?i)(https://ecf\.[^'' ]+/doc1/[^'' ]+)', 1), '')) AS document_url, left(iso, 10) AS filing_date,
       coalesce(court_id, '') || ':' || coalesce(case_number, '') || ':' || g AS unique_key, CASE WHEN excluded THEN 0 ELSE signal END AS signal_score, is_business, regexp_matches(debtor, '^[A-Z][a-z]+ [A-Z][a-z]+') AND NOT is_business AS is_person,
       signal >= 40 AND NOT (regexp_matches(debtor, '^[A-Z][a-z]+ [A-Z][a-z]+') AND NOT is_business) AND case_number IS NOT NULL AND NOT excluded AS is_qualified FROM f""",
)
def _(t):
    items = t.rss.withColumn("isoDate", F.date_format("published_at", "yyyy-MM-dd'T'HH")).withColumn("pubDate", F.lit("never")).withColumn("description", F.lit("never"))
    return extraction.feed_events(items).drop("published_at")


@query(
    "t10_company_responses",
    "SELECT creditor_id, CAST(0 AS INT) AS place, 'c' || CAST(candidate_id AS STRING) AS company_id, CAST(candidate_id AS DOUBLE) AS revenue, confidence FROM candidates",
)
def _(t):
    attrs = F.struct(F.col("confidence").alias("matchScore"), F.col("candidate_id").alias("annualRevenue"))
    body = F.to_json(F.struct(F.array(F.struct(F.concat(F.lit("c"), F.col("candidate_id").cast("string")).alias("id"), attrs.alias("attributes"))).alias("data")))
    return extraction.company_responses(t.candidates.select("creditor_id", body.alias("body"))).select("creditor_id", "place", "company_id", "revenue", "confidence")


CONTACT_SQL = """SELECT l_suppkey AS creditor_id, l_orderkey * 10 + l_linenumber AS contact_id, CASE l_partkey % 3 WHEN 0 THEN 'Ann ' || l_partkey WHEN 1 THEN 'Bo Li' ELSE 'Full ' || l_partkey END AS full_name,
  'title' || (l_partkey % 9) AS title, CASE WHEN l_partkey % 3 = 0 THEN CAST(l_partkey % 50 AS DOUBLE) WHEN l_partkey % 3 = 1 THEN 0 ELSE CAST(l_partkey % 70 AS DOUBLE) END AS engagement
  FROM lineitem WHERE l_partkey % 7 > 1 AND l_suppkey % 10 <> 3"""


def _contact_bodies(t):
    """One body for each line of an order, in different shapes and spellings, some with an error or without a name."""
    k, text = F.col("part_id"), F.col("part_id").cast("string")
    title = F.concat(F.lit("title"), (k % 9).cast("string"))
    inner = F.struct(F.lit("Ann").alias("firstName"), text.alias("last_name"), (k % 50).cast("string").alias("engagementScore"), title.alias("jobTitle"))
    flat = F.to_json(F.struct(F.lit("Bo").alias("first_name"), F.lit("Li").alias("lastName"), F.lit("").alias("score"), title.alias("primaryTitle")))
    full = F.struct(F.concat(F.lit("Full "), text).alias("fullName"), (k % 70).alias("contactAccuracyScore"), title.alias("title"))
    body = F.when(k % 3 == 0, F.to_json(F.struct(F.array(F.struct(inner.alias("attributes"))).alias("data")))).when(k % 3 == 1, flat).otherwise(F.to_json(F.struct(full.alias("results"))))
    body = F.when(k % 7 == 0, '{"message": "no such person"}').when(k % 7 == 1, '{"data": [{"title": "nobody"}]}').otherwise(body)
    status = F.when(F.col("creditor_id") % 10 == 3, 429).otherwise(200)
    return t.claims.select("creditor_id", (F.col("filing_id") * 10 + F.col("line_number")).alias("contact_id"), body.alias("body"), status.alias("http_status"))


@query("t10b_contact_responses", f"SELECT contact_id AS creditor_id, CAST(0 AS INT) AS place, full_name, title, engagement FROM ({CONTACT_SQL})")
def _(t):
    return extraction.contact_responses(_contact_bodies(t).withColumn("creditor_id", F.col("contact_id"))).select("creditor_id", "place", "full_name", "title", "engagement")


@query(
    "w4b_contact_outcomes",
    f"""WITH n AS (SELECT creditor_id, least(count(*), 3) AS n FROM ({CONTACT_SQL}) GROUP BY creditor_id)
      SELECT creditor_id, CASE WHEN creditor_id % 10 = 3 THEN 'rate_limited' WHEN n IS NULL AND creditor_id % 4 > 0 THEN 'no_contact_found' WHEN creditor_id % 4 > 0 THEN 'matched' ELSE 'no_match' END AS match_status,
        CAST(coalesce(n, 0) AS INT) AS contacts_saved FROM creditors LEFT JOIN n USING (creditor_id)""",
)
def _(t):
    from claimforge.operators import ranking

    status = F.when(F.col("creditor_id") % 4 > 0, "matched").otherwise("no_match")
    lookups = t.creditors.select("creditor_id", status.alias("match_status"), F.when(F.col("creditor_id") % 10 == 3, 429).otherwise(200).alias("http_status"))
    found = extraction.contact_responses(_contact_bodies(t)).withColumn("contact_id", F.struct("full_name", "place"))
    return ranking.contact_outcomes(lookups, ranking.top_contacts(found))


@query("s4_docket_payloads", "SELECT filing_id, CAST(0 AS INT) AS place, document_number AS docket_number, filed_on FROM docket_docs")
def _(t):
    entry = F.struct(F.col("document_number").alias("number"), F.date_format("filed_on", "yyyy-MM-dd").alias("date_filed"))
    payload = F.when(F.col("document_id") % 2 == 0, F.to_json(F.array(F.array(entry)))).otherwise(F.to_json(F.array(entry)))
    return extraction.docket_entries(t.docket_docs.select("filing_id", payload.alias("payload"))).select("filing_id", "place", "docket_number", "filed_on")


@query("s5_import_rows", "SELECT s_suppkey AS import_id, s_name AS name FROM supplier")
def _(t):
    rows = F.struct(F.array(F.struct(F.col("s_name").alias("name"))).alias("rows"))
    body = F.when(F.col("s_suppkey") % 2 == 0, F.to_json(rows)).otherwise(F.to_json(F.struct(rows.alias("body"))))
    return feeds.expand_import(t.supplier.select(F.col("s_suppkey").alias("import_id"), body.alias("body")), "struct<name:string>").select("import_id", "row.name")


@query("s5_import_rejects", "SELECT s_suppkey AS import_id, 'no rows' AS rejected_for FROM supplier WHERE s_suppkey % 5 < 3")
def _(t):
    k = F.col("s_suppkey") % 5
    body = F.when(k == 0, "{}").when(k == 1, '{"rows":[]}').when(k > 2, F.to_json(F.struct(F.array(F.struct(F.col("s_name").alias("name"))).alias("rows"))))
    return feeds.import_rejects(t.supplier.select(F.col("s_suppkey").alias("import_id"), body.alias("body")), "struct<name:string>")


@query("c18_claim_amounts", "SELECT filing_id, part_id, line_number, TRY_CAST(nullif(regexp_replace(loss, '[^0-9.]', '', 'g'), '') AS DECIMAL(15,2)) AS amount FROM (SELECT case_key AS filing_id, part_id, line_number, loss FROM feed)")
def _(t):
    from claimforge.functions import money

    return t.feed.select(F.col("case_key").alias("filing_id"), "part_id", "line_number", money.safe_numeric(F.col("loss")).alias("amount"))


@query("t11_document_cache", "SELECT doc_id, content_sha256 IN (SELECT content_sha256 FROM metas WHERE doc_id % 4 = 0) AS cached FROM metas")
def _(t):
    known = t.metas.where("doc_id % 4 = 0").select("content_sha256").distinct().withColumn("hit", F.lit(True))
    return t.metas.join(known, "content_sha256", "left").select("doc_id", F.coalesce("hit", F.lit(False)).alias("cached"))


def _fuzzy_rows(t):
    """Claim rows with names that vary by spelling, thirty or so to a filing, of which there are more in larger tables."""
    spell = F.when(F.col("part_id") % 3 == 0, " Corp").when(F.col("part_id") % 3 == 1, " Corporation").otherwise("")
    return (
        t.claims.join(t.supplier.select(F.col("s_suppkey").alias("creditor_id"), "s_name"), "creditor_id")
        .groupBy("filing_id", "creditor_id", "part_id").agg(F.max("amount").alias("claim_amount"), F.max("line_number").alias("line_number"), F.max("s_name").alias("s_name"))
        .select(
            (F.col("filing_id") * 1000000000 + F.col("creditor_id") * 100000 + F.col("part_id")).alias("row_id"), F.floor(F.col("filing_id") / 8).alias("filing_id"), F.concat("s_name", spell).alias("name"),
            F.concat((F.col("creditor_id") % 9).cast("string"), F.lit(" Main St")).alias("address"), "claim_amount", (F.col("part_id") % 7 / 10).alias("confidence"), "line_number",
        )
    )


FUZZY_SQL = r"""SELECT filing_id * 1000000000 + creditor_id * 100000 + part_id AS row_id, CAST(floor(filing_id / 8) AS BIGINT) AS filing_id, s_name || CASE part_id % 3 WHEN 0 THEN ' Corp' WHEN 1 THEN ' Corporation' ELSE '' END AS name,
  CAST(creditor_id % 9 AS STRING) || ' Main St' AS address FROM claims JOIN supplier ON creditor_id = s_suppkey GROUP BY filing_id, creditor_id, part_id, s_name"""


@query(
    "d2b_token_pairs",
    rf"""WITH r AS (SELECT *, list_distinct(string_split(trim(regexp_replace(regexp_replace(lower(name || ' ' || address), '[^\w\s]', ' ', 'g'), '\s+', ' ', 'g')), ' ')) AS w FROM ({FUZZY_SQL}))
      SELECT a.row_id AS left_id, b.row_id AS right_id FROM r a JOIN r b ON a.filing_id = b.filing_id AND a.row_id < b.row_id WHERE len(list_intersect(a.w, b.w)) * 1.0 / len(list_distinct(a.w || b.w)) >= 0.99""",
)
def _(t):
    return fuzzy.jaccard_pairs(fuzzy.keyed(_fuzzy_rows(t)))


@query("j16_candidate_pairs", f"SELECT a.filing_id, a.row_id AS left_id, b.row_id AS right_id FROM ({FUZZY_SQL}) a JOIN ({FUZZY_SQL}) b ON a.filing_id = b.filing_id AND a.row_id < b.row_id")
def _(t):
    return fuzzy.candidate_pairs(_fuzzy_rows(t))


@query("d2_scored_pairs")
def _(t):
    return fuzzy.all_scored_pairs(fuzzy.keyed(_fuzzy_rows(t)))


@query("n9_token_scores")
def _(t):
    """Each creditor's key against that of the creditor with the next id, whatever the score."""
    keys = t.creditors.select("creditor_id", fuzzy.names.dedup_key(F.col("name"), F.col("address")).alias("key"))
    after = keys.select((F.col("creditor_id") - 1).alias("row_id"), F.col("creditor_id").alias("other"), F.col("key").alias("b"))
    both = keys.select(F.col("creditor_id").alias("row_id"), F.col("key").alias("a")).join(after, "row_id")
    return both.select("row_id", "other", fuzzy.token_set_scores("a", "b").alias("score"))


@query(
    "d3_clusters",
    """WITH RECURSIVE e AS (SELECT s_suppkey AS a, (s_suppkey * 7 + 3) % 60 AS b FROM supplier WHERE s_suppkey % 4 > 0), s AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
      r AS (SELECT DISTINCT a AS node, a AS m FROM s UNION SELECT s.b, r.m FROM r JOIN s ON s.a = r.node) SELECT node, min(m) AS component FROM r GROUP BY node HAVING count(DISTINCT m) > 1""",
)
def _(t):
    from claimforge.operators.components import connected_components

    edges = t.supplier.where("s_suppkey % 4 > 0").select(F.col("s_suppkey").alias("u"), ((F.col("s_suppkey") * 7 + 3) % 60).alias("v"))
    return connected_components(edges)


@query(
    "d4_merged_clusters",
    """SELECT filing_id, creditor_id AS cluster_id, CAST(sum(amount) AS DECIMAL(15,2)) AS claim_amount, count(*) AS n_rows, array_to_string(list_sort(list(DISTINCT line_number)), ',') AS line_numbers, max(CAST(part_id % 7 AS DOUBLE)) AS confidence
      FROM claims GROUP BY filing_id, creditor_id""",
)
def _(t):
    rows = t.claims.select(
        "filing_id", F.col("creditor_id").alias("cluster_id"), F.col("part_id").alias("row_id"), F.concat(F.lit("n"), F.col("part_id").cast("string")).alias("name"),
        F.lit("a").alias("address"), F.col("amount").alias("claim_amount"), (F.col("part_id") % 7).cast("double").alias("confidence"), "line_number",
    )
    out = fuzzy.merge_clusters(rows)
    return out.select("filing_id", "cluster_id", "claim_amount", "n_rows", F.concat_ws(",", F.col("line_numbers").cast("array<string>")).alias("line_numbers"), "confidence")


# Names of one token set in several spellings; clusters are the keys that have the same tokens.
SPELLED_SQL = r"""SELECT row_id, filing_id, CASE CAST(row_id % 4 AS INT) WHEN 0 THEN upper(name) WHEN 1 THEN replace(name, '#', ' # ') WHEN 2 THEN name || '.' ELSE name END AS name, address, claim_amount, line_number, confidence
  FROM (SELECT filing_id * 1000000000 + creditor_id * 100000 + part_id AS row_id, CAST(floor(filing_id / 8) AS BIGINT) AS filing_id, s_name || CASE part_id % 3 WHEN 0 THEN ' Corp' WHEN 1 THEN ' Corporation' ELSE '' END AS name,
    CAST(creditor_id % 9 AS STRING) || ' Main St' AS address, max(amount) AS claim_amount, max(line_number) AS line_number, CAST(part_id % 7 AS DOUBLE) / 10 AS confidence
    FROM claims JOIN supplier ON creditor_id = s_suppkey GROUP BY filing_id, creditor_id, part_id, s_name) b"""
CLUSTER_SQL = rf"""k AS (SELECT *, list_sort(list_distinct(string_split(trim(regexp_replace(regexp_replace(lower(name || ' ' || address), '[^\w\s]', ' ', 'g'), '\s+', ' ', 'g')), ' '))) AS w FROM ({SPELLED_SQL})),
  c AS (SELECT *, min(row_id) OVER (PARTITION BY filing_id, w) AS cluster_id FROM k)"""


def _spelled_clusters(t):
    """Pairs of equal token sets, as links of each row with the least of its filing and tokens, to clusters."""
    rows = fuzzy.keyed(_fuzzy_rows(t).withColumn("name", F.expr("CASE CAST(row_id % 4 AS INT) WHEN 0 THEN upper(name) WHEN 1 THEN replace(name, '#', ' # ') WHEN 2 THEN name || '.' ELSE name END")))
    return fuzzy.jaccard_clusters(rows)


@query("d3b_token_clusters", f"WITH {CLUSTER_SQL} SELECT row_id, cluster_id FROM c")
def _(t):
    return _spelled_clusters(t).select("row_id", "cluster_id")


@query(
    "d4b_merged_spellings",
    f"""WITH {CLUSTER_SQL},
      o AS (SELECT *, row_number() OVER (PARTITION BY filing_id, cluster_id ORDER BY confidence DESC, length(name) DESC, row_id) AS place FROM c),
      g AS (SELECT filing_id, cluster_id, min(CASE WHEN place = 1 THEN name END) AS name, CAST(sum(claim_amount) AS DECIMAL(15,2)) AS claim_amount, max(confidence) AS confidence, count(*) AS n_rows,
        array_to_string(list_sort(list(DISTINCT line_number)), ',') AS line_numbers, list(DISTINCT name) AS names FROM o GROUP BY filing_id, cluster_id),
      m AS (SELECT filing_id, cluster_id, string_agg(x, '|' ORDER BY lower(x), x) AS rest FROM (SELECT filing_id, cluster_id, name, unnest(names) AS x FROM g) WHERE x <> name GROUP BY filing_id, cluster_id)
      SELECT g.* EXCLUDE (names), CASE WHEN n_rows > 1 THEN concat_ws('|', name, rest) END AS merged_names FROM g LEFT JOIN m USING (filing_id, cluster_id)""",
)
def _(t):
    out = fuzzy.merge_clusters(_spelled_clusters(t))
    return out.select("filing_id", "cluster_id", "name", "claim_amount", "confidence", "n_rows", F.concat_ws(",", F.col("line_numbers").cast("array<string>")).alias("line_numbers"), "merged_names")


@query("a4b_spelling_stats", f"WITH {CLUSTER_SQL} SELECT filing_id, count(*) AS original_count, count(DISTINCT cluster_id) AS deduped_count, count(*) - count(DISTINCT cluster_id) AS duplicates_removed FROM c GROUP BY filing_id")
def _(t):
    return fuzzy.dedup_stats(_spelled_clusters(t))


@query("d_deduplicated_creditors")
def _(t):
    return fuzzy.deduplicate(_fuzzy_rows(t))


@query("a4_dedup_stats", "SELECT filing_id, count(*) AS original_count, count(DISTINCT creditor_id) AS deduped_count, count(*) - count(DISTINCT creditor_id) AS duplicates_removed FROM claims GROUP BY filing_id")
def _(t):
    return fuzzy.dedup_stats(t.claims.withColumn("cluster_id", F.col("creditor_id")))


@query("i1_next_window", "SELECT max(CAST(o_orderdate AS DATE)) AS since, max(CAST(o_orderdate AS DATE)) - 3 AS query_from FROM orders")
def _(t):
    config = t.filings.agg(F.max("filing_date").cast("string").alias("value")).select(F.lit("last_date").alias("key"), "value")
    return incremental.next_window(config, "2001-09-01")


@query(
    "i2_advanced_watermarks",
    """WITH r AS (SELECT filing_id % 50 AS run_id, filing_date AS until, filing_date - 7 AS since, filing_id % 400 > 3 AS complete, filing_id % 900 = 7 AS oob, CAST(filing_id % 700 = 9 AS INT) AS errors FROM filings)
      SELECT run_id, bool_and(complete) AND NOT bool_or(oob) AND sum(errors) = 0 AS advance, CASE WHEN bool_and(complete) AND NOT bool_or(oob) AND sum(errors) = 0 THEN max(until) ELSE min(since) END AS last_date FROM r GROUP BY run_id""",
)
def _(t):
    k = F.col("filing_id")
    runs = t.filings.select(
        (k % 50).alias("run_id"), F.col("filing_date").alias("until"), F.date_sub("filing_date", 7).alias("since"), (k % 400 > 3).alias("complete"), (k % 900 == 7).alias("out_of_budget"),
        (k % 700 == 9).cast("int").alias("errors"),
    )
    return incremental.advance(runs)


LEDGER_SQL = "SELECT case_number, filing_date AS filed, CASE WHEN filing_id % 5 = 0 THEN 'x' ELSE CAST(filing_id % 4 AS STRING) END AS attempts, filing_date + 30 AS last_date FROM filings WHERE filing_id % 3 = 0"


def _ledger(t):
    return t.filings.where("filing_id % 3 = 0").select(
        "case_number", F.col("filing_date").alias("filed"), F.when(F.col("filing_id") % 5 == 0, "x").otherwise((F.col("filing_id") % 4).cast("string")).alias("attempts"), F.date_add("filing_date", 30).alias("last_date")
    )


@query("i3_known_misses", f"SELECT case_number FROM filings WHERE case_number NOT IN (SELECT case_number FROM ({LEDGER_SQL}) WHERE coalesce(TRY_CAST(attempts AS INT), 0) >= 2 OR last_date = DATE '1999-05-05')")
def _(t):
    return incremental.skip_known_misses(t.filings.select("case_number"), _ledger(t), "1999-05-05")


@query(
    "i4_recorded_misses",
    f"""WITH l AS (SELECT case_number, filed, CASE WHEN attempts = 'x' THEN 0 ELSE CAST(attempts AS INT) END AS attempts, last_date FROM ({LEDGER_SQL})), m AS (SELECT case_number, filing_date AS f FROM filings WHERE filing_id % 2 = 0)
      SELECT case_number, coalesce(filed, f) AS filed, coalesce(attempts, 0) + CAST(f IS NOT NULL AS INT) AS attempts, CASE WHEN f IS NOT NULL THEN DATE '2001-08-08' ELSE last_date END AS last_date FROM l FULL JOIN m USING (case_number)""",
)
def _(t):
    ledger = _ledger(t).withColumn("attempts", F.when(F.col("attempts") == "x", "0").otherwise(F.col("attempts")))
    return incremental.record_misses(ledger, t.filings.where("filing_id % 2 = 0").select("case_number", F.col("filing_date").alias("filed")), "2001-08-08")


@query("w11_pruned_ledger", f"SELECT case_number, filed FROM ({LEDGER_SQL}) WHERE filed >= DATE '2001-07-01' - 45 ORDER BY filed DESC, case_number LIMIT 100")
def _(t):
    return incremental.prune_ledger(_ledger(t), "2001-07-01", most=100).select("case_number", "filed")


@query(
    "a20_intake_results",
    "SELECT job_type, count(*) AS found, count(*) FILTER (WHERE status = 'completed') AS uploaded, count(*) FILTER (WHERE status = 'failed') AS skipped, count(*) FILTER (WHERE status = 'running') AS known_missing, count(*) FILTER (WHERE status = 'queued') AS unattempted FROM jobs GROUP BY job_type",
)
def _(t):
    names = F.create_map(*map(F.lit, ("completed", "uploaded", "failed", "skipped", "running", "known_missing", "queued", "unattempted")))
    return incremental.intake_result(t.jobs.withColumn("action", F.element_at(names, F.col("status"))), "job_type")


@query("i6_unprocessed_events", "SELECT job_id FROM jobs WHERE status <> 'completed' AND message IS NULL")
def _(t):
    return t.jobs.where("status <> 'completed' AND message IS NULL").orderBy("created_at").select("job_id")


@query(
    "i9_complete_windows",
    "SELECT filing_id AS window_id, NOT (bool_or(status = 'failed') OR bool_or(job_id % 40 >= 38 AND seconds > 60)) AS complete, count(*) AS n_pages FROM jobs GROUP BY filing_id",
)
def _(t):
    pages = t.jobs.select(F.col("filing_id").alias("window_id"), (F.col("status") == "failed").alias("failed"), (F.col("job_id") % 40).alias("page"), (F.col("seconds") > 60).alias("has_next"))
    return incremental.complete_windows(pages, 38)


@query("i7_current_status", "SELECT filing_id, job_type, arg_max(status, (created_at, job_id)) AS status, count(*) AS n_updates FROM jobs GROUP BY filing_id, job_type")
def _(t):
    return streams.current_status(t.jobs)


JOB_STREAM = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def _job_stream(t):
    raw = t.spark.readStream.schema(JOB_STREAM).option("pathGlobFilter", "events.parquet").parquet(t.sf_dir)
    return raw.select(F.col("event_type").alias("job_type"), F.when(F.col("value").between(50, 80), "failed").otherwise("ok").alias("status"), F.col("ts").cast("timestamp").alias("created_at"), F.col("event_type").alias("worker"))


@query(
    "i7_hourly_jobs",
    "SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type AS job_type, count(*) AS n, count(*) FILTER (WHERE value BETWEEN 50 AND 80) AS failed FROM events GROUP BY ALL",
)
def _(t):
    out = streams.run_available(streams.job_counts(_job_stream(t)), "hourly-jobs", "complete")
    return out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query(
    "i7_sliding_jobs",
    "SELECT strftime(b + CAST(k AS INT) * INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_start, event_type AS job_type, count(*) AS n, count(*) FILTER (WHERE value BETWEEN 50 AND 80) AS failed "
    "FROM (SELECT *, time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL 23 HOUR AS b FROM events), (SELECT unnest(range(24)) AS k) GROUP BY ALL",
)
def _(t):
    out = streams.run_available(streams.job_counts(_job_stream(t), "24 hours", "1 hour"), "sliding-jobs", "complete")
    return out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query(
    "i7_worker_sessions",
    """WITH g AS (SELECT event_type AS worker, ts, CAST(ts - lag(ts) OVER (PARTITION BY event_type ORDER BY ts) >= INTERVAL 10 MINUTE AS INT) AS new FROM events),
      s AS (SELECT worker, ts, sum(coalesce(new, 0)) OVER (PARTITION BY worker ORDER BY ts) AS k FROM g)
      SELECT worker, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS started, count(*) AS n FROM s GROUP BY worker, k""",
)
def _(t):
    out = streams.run_available(streams.worker_sessions(_job_stream(t)), "sessions", "complete")
    return out.select("worker", F.date_format("started", "yyyy-MM-dd HH:mm:ss").alias("started"), "n")


@query(
    "i4b_streamed_ledger",
    """WITH m AS (SELECT DISTINCT 'c' || user_id AS case_number, DATE '2023-11-20' + CAST(user_id % 60 AS INT) AS filed, CAST(ts AS DATE) AS day FROM events)
      SELECT case_number, filed, CAST(count(*) AS INT) AS attempts, max(day) AS last_date FROM m GROUP BY case_number, filed HAVING filed >= (SELECT max(day) FROM m) - 45""",
)
def _(t):
    """Misses of a stream, kept as state by case; cases filed over 45 days before the last day are gone."""
    path = shared_folder(t.spark, "ledger")
    raw = t.spark.readStream.schema(JOB_STREAM).option("pathGlobFilter", "events.parquet").parquet(t.sf_dir)
    filed = F.date_add(F.lit("2023-11-20").cast("date"), (F.col("user_id") % 60).cast("int"))
    misses = raw.select(F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("case_number"), filed.alias("filed"), F.date_trunc("day", F.col("ts").cast("timestamp")).alias("missed_on"))
    return ledger.miss_ledger(misses, path)


ARRIVAL = "least(6, CAST(floor((day(created_at) - 1) / 5) AS INT)) + CASE WHEN job_id % 13 = 0 THEN 2 WHEN job_id % 11 = 0 THEN 1 ELSE 0 END"


@query(
    "i7_late_jobs",
    f"""WITH j AS (SELECT *, {ARRIVAL} AS b FROM jobs), m AS (SELECT b, max(created_at) AS top FROM j GROUP BY b),
      w AS (SELECT j.*, date_trunc('hour', created_at) AS h, (SELECT max(top) FROM m WHERE m.b <= j.b - 2) - INTERVAL 2 DAY AS mark FROM j)
      SELECT h AS window_start, job_type, count(*) AS n, count(*) FILTER (status = 'failed') AS failed FROM w
      WHERE mark IS NULL OR h + INTERVAL 1 HOUR > mark GROUP BY ALL HAVING h + INTERVAL 1 HOUR <= (SELECT max(top) FROM m) - INTERVAL 2 DAY""",
)
def _(t):
    """Hourly counts in append mode over nine batches in order of arrival, with rows one and two batches late.

    A row is left out if its window was over by the watermark of the batch before, which is two days behind the newest row of the batches
    before that one; a window is written once, when the watermark has passed it.
    """
    path = shared_folder(t.spark, "late-jobs")
    rows = t.jobs.withColumn("b", F.expr(ARRIVAL)).select("job_type", "status", "created_at", "b")
    for number in range(9):  # the order of arrival is that of the files
        rows.where(F.col("b") == number).drop("b").coalesce(1).write.mode("append").parquet(path)
    stream = streams.file_stream(t.spark, rows.drop("b").schema, path, 1)
    return streams.run_available(streams.job_counts(stream, delay="2 days"), "late-jobs")


@query("i5_feed_stream", "SELECT DISTINCT ':24-' || (user_id + 10000) || ':g' || (event_id % 500) AS unique_key, '24-' || (user_id + 10000) AS case_number, true AS is_qualified FROM events")
def _(t):
    raw = t.spark.readStream.schema(JOB_STREAM).option("pathGlobFilter", "events.parquet").parquet(t.sf_dir)
    items = raw.select(
        "event_id", F.concat(F.lit("24-"), (F.col("user_id") + 10000).cast("string"), F.lit(" Acme LLC")).alias("title"), F.lit("Voluntary petition").alias("content"), F.lit("").alias("link"),
        F.concat(F.lit("g"), (F.col("event_id") % 500).cast("string")).alias("guid"), F.col("ts").cast("timestamp").alias("published_at"),
    )
    return streams.run_available(streams.feed_event_stream(items, "40 days"), "feed").select("unique_key", "case_number", "is_qualified")


def _feed_items(t, chosen: str):
    raw = t.spark.readStream.schema(JOB_STREAM).option("pathGlobFilter", "events.parquet").parquet(t.sf_dir).where(chosen)
    return raw.select(
        "event_id", F.concat(F.lit("24-"), (F.col("user_id") + 10000).cast("string"), F.lit(" Acme LLC")).alias("title"), F.lit("Voluntary petition").alias("content"), F.lit("").alias("link"),
        F.concat(F.lit("g"), (F.col("event_id") % 500).cast("string")).alias("guid"), F.col("ts").cast("timestamp").alias("published_at"),
    )


@query(
    "i5b_feed_store",
    """SELECT unique_key, arg_min(event_id, o) AS event_id FROM (SELECT ':24-' || (user_id + 10000) || ':g' || (event_id % 500) AS unique_key, event_id, row_number() OVER (ORDER BY ts, event_id) AS o FROM events) GROUP BY unique_key""",
)
def _(t):
    """The events of two feeds, of which the second repeats keys of the first, in one store; the first feed is followed twice."""
    path = shared_folder(t.spark, "feed-events")
    streams.feed_event_store(_feed_items(t, "event_id % 3 = 0"), path, "one")
    streams.feed_event_store(_feed_items(t, "event_id % 3 > 0"), path, "two")
    return streams.feed_event_store(_feed_items(t, "event_id % 3 = 0"), path, "one").select("unique_key", "event_id")


@query("i8_exposure_stream", "SELECT user_id, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(15,2))) AS DECIMAL(15,2)) AS total FROM events GROUP BY user_id")
def _(t):
    """Two streams into one store, the first of them followed twice."""
    path = shared_folder(t.spark, "exposure")

    def claims(chosen: str):
        raw = t.spark.readStream.schema(JOB_STREAM).option("pathGlobFilter", "events.parquet").parquet(t.sf_dir).where(chosen)
        return raw.select(F.col("event_id").alias("filing_id"), F.col("user_id").alias("creditor_id"), F.col("value").cast("decimal(15,2)").alias("amount"))

    for chosen, writer in (("event_id % 2 = 0", "even"), ("event_id % 2 = 1", "odd"), ("event_id % 2 = 0", "even")):
        out = streams.exposure_store(claims(chosen), path, writer)
    return out.select(F.col("creditor_id").alias("user_id"), F.col("filing_count").alias("n"), F.col("total_claims").alias("total"))


@query("s1_claim_feed", "SELECT count(*) AS n, count(DISTINCT nullif(case_number, '')) AS cases, count(DISTINCT debtor) AS debtors FROM feed")
def _(t):
    path = shared_folder(t.spark, "feed")
    names = {
        "filed": "Date Filed", "creditor": "Impacted Business", "city": "City", "state": "State", "case_number": "Case Number", "debtor": "Corporate Bankruptcy", "loss": "Loss",
    }
    t.feed.select(*(F.col(c).alias(n) for c, n in names.items())).write.option("header", True).csv(path)
    rows = feeds.read_claim_feed(t.spark, path)
    return rows.where(F.col("line_number") > 1).agg(
        F.count("*").alias("n"), F.countDistinct(F.nullif("Case Number", F.lit(""))).alias("cases"), F.countDistinct("Corporate Bankruptcy").alias("debtors")
    )
