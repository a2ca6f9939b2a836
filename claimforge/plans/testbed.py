"""Domain tables derived from the given star-schema tables.

Each view is one SQL text that Spark and DuckDB both run, so that a query and its
oracle start from the same rows. Real deployments pass their own tables to the
operators instead.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import DataFrame, SparkSession

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages")

# Two-letter codes by nation key.
STATES = "TXNYCAFLILOHPAGANCMIVAWAAZMATNINMOMDWICOMNSCALLAKY"


def _state(key: str) -> str:
    return f"substr('{STATES}', CAST({key} * 2 + 1 AS INT), 2)"


VIEWS = {
    "filings": f"""
        SELECT o_orderkey AS filing_id,
          substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 3, 2) || '-bk-' || CAST(o_orderkey AS STRING) AS case_number,
          c_custkey AS debtor_id, c_name AS debtor_name, CAST(o_orderdate AS DATE) AS filing_date,
          {_state('c_nationkey')} AS state,
          CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN '11' WHEN '2' THEN '7' WHEN '3' THEN '11-Subchapter-V' ELSE 'unknown' END AS chapter,
          CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN ' ' ELSE lower({_state('c_nationkey')}) || 'bk' END AS court_id,
          CAST(o_orderdate AS DATE) AS created_on, CAST(o_totalprice AS DECIMAL(15,2)) AS liabilities, o_orderstatus AS order_status
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "creditors": f"""
        SELECT s_suppkey AS creditor_id,
          CASE WHEN s_suppkey % 23 = 22 THEN 'Contact' WHEN s_suppkey % 29 = 28 THEN ' 12 ' WHEN s_suppkey % 31 = 30 THEN 'Official Form 204'
            ELSE s_name || CASE s_suppkey % 5 WHEN 0 THEN ' LLC' WHEN 1 THEN ', Inc.' WHEN 2 THEN ' Corp.' WHEN 3 THEN ' Bank & Trust' ELSE '' END END AS name,
          CASE WHEN s_suppkey % 11 = 0 THEN upper(s_name) WHEN s_suppkey % 13 = 0 THEN '  ' END AS original_name,
          CASE s_suppkey % 5 WHEN 0 THEN CAST(s_suppkey AS STRING) || ' Main St, Springfield, ' || {_state('s_nationkey')} || ' 0' || CAST(s_suppkey % 10 + 1230 AS STRING)
            WHEN 1 THEN 'Dayton, ' || {_state('s_nationkey')}
            WHEN 2 THEN CAST(s_suppkey AS STRING) || ' Oak Ave, Suite 5, Reno, ' || {_state('s_nationkey')} || ' 12345-6789'
            WHEN 3 THEN CAST(s_suppkey AS STRING) || ' Elm Rd,  Troy, ' || {_state('s_nationkey')} || ' and more' END AS address,
          {_state('s_nationkey')} AS home_state,
          CASE WHEN s_suppkey % 7 <> 0 THEN CAST(s_acctbal AS DECIMAL(15,2)) END AS claim_amount,
          s_suppkey % 6 <> 0 AS is_company,
          CASE WHEN s_suppkey % 4 = 1 THEN 'z' || CAST(s_suppkey AS STRING) WHEN s_suppkey % 4 = 2 THEN ' ' END AS company_id,
          CASE WHEN s_suppkey % 4 > 0 THEN CAST(s_suppkey % 4 AS INT) END AS company_tier,
          DATE '1996-01-01' + CAST(s_suppkey * 7 % 2000 AS INT) AS created_on,
          CASE WHEN s_suppkey % 9 = 0 THEN s_suppkey * 13 % 997 END AS source_filing_id
        FROM supplier""",
    "claims": """
        SELECT l_orderkey AS filing_id, l_suppkey AS creditor_id, l_partkey AS part_id, CAST(l_linenumber AS INT) AS line_number,
          CASE WHEN l_partkey % 10 > 0 THEN CAST(l_extendedprice AS DECIMAL(15,2)) END AS amount, l_returnflag AS flag,
          CAST(l_shipdate AS DATE) AS claim_date
        FROM lineitem""",
    "links": "SELECT DISTINCT l_orderkey AS filing_id, l_suppkey AS creditor_id FROM lineitem",
    "feed": """
        SELECT l_orderkey AS case_key, l_partkey AS part_id, CAST(l_linenumber AS INT) AS line_number,
          CASE WHEN l_partkey % 50 = 0 THEN '' ELSE '2:20' || CAST(l_orderkey % 30 AS STRING) || 'bk' || CAST(l_orderkey AS STRING) END AS case_number,
          CASE WHEN l_partkey % 61 = 0 THEN ' ' WHEN l_partkey % 3 = 0 THEN upper(s_name) ELSE s_name END AS creditor,
          CASE WHEN l_partkey % 5 = 0 THEN '' ELSE 'City' || CAST(l_suppkey % 40 AS STRING) END AS city,
          CASE l_partkey % 7 WHEN 0 THEN 'see petition' WHEN 1 THEN ' ny ' WHEN 2 THEN '' WHEN 3 THEN 'tx' ELSE 'CA' END AS state,
          'Debtor ' || CAST(l_orderkey AS STRING) AS debtor, CAST(CAST(l_shipdate AS DATE) AS STRING) AS filed,
          CASE l_partkey % 8 WHEN 0 THEN '$' WHEN 1 THEN 'n/a' WHEN 2 THEN '-$' || CAST(l_partkey AS STRING) || '.25' ELSE '$1,' || CAST(100 + l_partkey % 900 AS STRING) || '.50' END AS loss
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "jobs": """
        SELECT event_id AS job_id, user_id * 7 AS filing_id,
          CASE event_type WHEN 'view' THEN 'document_parse' WHEN 'signup' THEN 'company_lookup' WHEN 'purchase' THEN 'account_push'
            WHEN 'error' THEN 'company_lookup' ELSE 'docket_poll' END AS job_type,
          CASE WHEN value < 20 THEN 'queued' WHEN value < 40 THEN 'running' WHEN value < 50 THEN 'retrying' WHEN value < 80 THEN 'failed' ELSE 'completed' END AS status,
          CASE WHEN event_id % 4 = 0 THEN 'err ' || CAST(event_id AS STRING) END AS message,
          CASE event_type WHEN 'view' THEN 'a' WHEN 'error' THEN 'b' ELSE 'c' END AS worker, CAST(ts AS TIMESTAMP) AS created_at, value AS seconds
        FROM events""",
    "accounts": f"""
        SELECT c_custkey AS account_id, 'Supplier#' || substr(CAST(1000000000 + c_custkey % 120 AS STRING), 2) ||
            CASE c_custkey % 3 WHEN 0 THEN ' LLC' WHEN 1 THEN '' ELSE ' Corp.' END AS account_name,
          CASE WHEN c_custkey % 5 < 2 THEN {_state('c_nationkey')} WHEN c_custkey % 5 = 2 THEN ' ' END AS billing_state,
          CAST(c_acctbal AS DECIMAL(15,2)) AS balance, c_mktsegment AS segment
        FROM customer""",
    "firmographics": """
        SELECT s_suppkey AS creditor_id, CASE WHEN s_suppkey % 8 <> 0 THEN CAST(round(s_acctbal * 200000) AS BIGINT) END AS revenue,
          CASE WHEN s_suppkey % 6 <> 0 THEN CAST(s_suppkey * 97 % 9000 AS INT) END AS employees
        FROM supplier""",
    "candidates": """
        SELECT l_suppkey AS creditor_id, l_orderkey AS candidate_id, CAST(l_linenumber AS INT) AS place,
          CAST(round(l_discount * 10) / 10 AS DOUBLE) AS confidence, l_partkey AS name_key,
          CASE WHEN l_partkey % 4 = 0 THEN 'Austin, TX' WHEN l_partkey % 4 = 1 THEN 'ny' END AS headquarters
        FROM lineitem""",
    "courts": f"""
        SELECT lower({_state('n_nationkey')}) || 'bk' AS court_id, {_state('n_nationkey')} AS state, n_nationkey % 6 <> 5 AS active FROM nation""",
    "target_states": f"SELECT {_state('n_nationkey')} AS state, n_nationkey % 3 <> 2 AS active FROM nation",
    "territories": f"SELECT {_state('n_nationkey')} AS state, 'rep' || CAST(n_nationkey % 4 AS STRING) AS rep FROM nation WHERE n_nationkey % 5 > 0",
    "docket_docs": """
        SELECT l_orderkey AS filing_id, l_partkey AS document_id, l_suppkey AS source_id,
          CASE l_partkey % 9 WHEN 0 THEN '' WHEN 1 THEN 'x' ELSE CAST(l_partkey % 40 AS STRING) || CASE WHEN l_partkey % 2 = 0 THEN '.1' ELSE '' END END AS document_number,
          CASE WHEN l_partkey % 6 = 0 THEN 0 ELSE CAST(l_quantity AS INT) END AS page_count,
          CASE l_partkey % 5 WHEN 0 THEN 'List of 20 Largest Unsecured Claims' WHEN 1 THEN 'Motion re 20 largest' WHEN 2 THEN 'Petition'
            WHEN 3 THEN 'Creditors: 30 LARGEST' ELSE 'Notice of hearing' END AS description,
          l_returnflag <> 'R' AS is_available, CASE WHEN l_partkey % 13 > 0 THEN 'recap/' || CAST(l_partkey AS STRING) || '.pdf' END AS path,
          CAST(l_shipdate AS DATE) AS filed_on
        FROM lineitem""",
    "metas": """
        SELECT doc_id, doc_id % 700 AS filing_id, sha256_of AS content_sha256, source AS parser, n_chars, doc_id % 3 = 0 AS ocr, doc_id % 11 = 0 AS flagged,
          CAST(doc_id % 40 AS INT) AS valid_rows, CAST(doc_id % 45 AS INT) AS total_rows, CASE WHEN doc_id % 5 > 0 THEN doc_id % 300 END AS linked_filing,
          'cases/' || CAST(90 + doc_id % 9 AS STRING) || '-bk-' || CAST(doc_id % 900 AS STRING) || '/doc.pdf' AS path
        FROM (SELECT *, md5(coalesce(text, '')) AS sha256_of FROM documents) d""",
    "notices": """
        SELECT filing_id, string_lines AS text FROM (
          SELECT l_orderkey AS filing_id, 'List of Creditors' || chr(10) || chr(10) || CAST(max(l_linenumber) AS STRING) || '. ' || max(s_name) || ' LLC' || chr(9) || chr(10)
            || chr(9) || '12 Main St' || chr(13) || chr(10) || 'Reno, NV 89501' || chr(10) || '$1,2' || CAST(max(l_partkey) % 90 + 10 AS STRING) || '.50' || chr(10) || chr(10)
            || min(s_name) || chr(10) || CAST(count(*) AS STRING) || ' Oak Ave' || chr(10) || 'Total $' || CAST(min(l_partkey) AS STRING) AS string_lines
          FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_orderkey) n""",
    "petitions": """
        SELECT o_orderkey AS filing_id, 'Official Form 201' || chr(10) || CASE o_orderkey % 3 WHEN 0 THEN 'United States Bankruptcy Court, Northern District of Texas' WHEN 1 THEN 'District of Utah' ELSE '' END
          || chr(10) || CASE WHEN o_orderkey % 4 = 1 THEN 'Debtor 1: ' ELSE 'Debtor name: ' END || c_name || chr(10) || 'City: San Jose 5'
          || chr(10) || CASE WHEN o_orderkey % 5 > 0 THEN 'State: ' || substr('TXNYCA', CAST(o_orderkey % 3 * 2 + 1 AS INT), 2) ELSE 'Reno, NV 89501' END
          || chr(10) || CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderkey % 50 AS STRING) || '-' || CAST(o_orderkey % 50 + 49 AS STRING) || ' creditors' WHEN 1 THEN '100 or more creditors' WHEN 2 THEN 'less than 50 creditors' ELSE '' END
          || chr(10) || CASE o_orderkey % 7 WHEN 0 THEN '' WHEN 1 THEN 'Estimated assets: $' || CAST(o_orderkey % 90 + 1 AS STRING) || ',000 or more' WHEN 2 THEN 'Estimated assets: less than $5,000'
            ELSE 'Estimated assets: $' || CAST(o_orderkey % 90 + 1 AS STRING) || ',000 to $' || CAST(o_orderkey % 90 + 100 AS STRING) || ',000.50' END
          || chr(10) || repeat('x ', 450) || chr(10) || CASE WHEN o_orderkey % 6 > 0 THEN 'Estimated liabilities: $' || CAST(o_orderkey % 80 + 2 AS STRING) || ',000 - $900,000' ELSE '' END
          || chr(10) || CASE WHEN o_orderkey % 2 = 0 THEN 'NAICS: ' || CAST(100000 + o_orderkey % 9000 AS STRING) ELSE 'Nature of business: retail 445' || CAST(100 + o_orderkey % 900 AS STRING) END AS text
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "sheet_rows": """
        SELECT l_orderkey * 10 + l_linenumber AS doc_id, CASE WHEN l_partkey % 8 = 7 THEN 'Item|Amount|Claim' WHEN l_partkey % 4 = 0 THEN 'Schedule E/F: Creditors' ELSE 'No|Creditor Name|Mailing Address|Claim Amount' END AS head,
          CASE CAST(l_partkey % 11 AS INT) WHEN 0 THEN '1|' || s_name || '|Nature of claim|12 Main St|$9' WHEN 1 THEN s_name || ' Co|TX|5 Oak Ave' WHEN 2 THEN '$5|' || s_name || '|' || chr(9) || '7 Elm Rd' || chr(13)
            WHEN 3 THEN s_name || '|...|1.2.3|$ 1,234.50' WHEN 4 THEN 'Contact||' || s_name || '|$7.|3' WHEN 5 THEN '12|999|  ' WHEN 6 THEN s_name WHEN 7 THEN 'Total|' || CAST(l_partkey AS STRING) || '|' || s_name
            WHEN 8 THEN s_name || chr(10) || '|creditor name|Reno, NV 89501|9,000|$' || CAST(l_partkey AS STRING) || '.25' WHEN 9 THEN '' ELSE CAST(l_linenumber AS STRING) || '|' || s_name || ' LLC|1 Main St|$' || CAST(l_partkey AS STRING) END AS cells
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "rss": """
        SELECT event_id, CASE event_type WHEN 'view' THEN '24-' || CAST(10000 + user_id AS STRING) || ' Acme Holdings LLC' WHEN 'signup' THEN '24-' || CAST(20000 + event_id % 90 AS STRING) || ' John Smith'
            ELSE 'Docket update  ' || CAST(user_id AS STRING) END AS title,
          CASE event_type WHEN 'view' THEN '<p>Voluntary petition Chapter 11 <a href="https://ecf.txsb.uscourts.gov/doc1/' || CAST(event_id AS STRING) || '">x</a></p>'
            WHEN 'error' THEN 'Proof of claim' ELSE '<b>Petition filed</b> chapter: 7' END AS content,
          CASE WHEN event_id % 3 > 0 THEN 'https://ecf.txsb.uscourts.gov/cgi?' || CAST(event_id % 2000 AS STRING) ELSE '' END AS link,
          CASE WHEN event_id % 4 > 0 THEN 'g' || CAST(event_id % 3000 AS STRING) END AS guid, CAST(ts AS TIMESTAMP) AS published_at
        FROM events""",
    "calls": "SELECT event_id AS call_id, user_id % 5 AS account, CAST(ts AS TIMESTAMP) AS called_at FROM events",
}


@functools.cache
def needed(sql: str) -> tuple[str, ...]:
    """The views that a SQL text names, in an order in which each can be defined."""
    out: list[str] = []

    def add(text: str) -> None:
        for name in VIEWS:
            if name not in out and re.search(rf"\b{name}\b", text):
                add(VIEWS[name])
                if name not in out:
                    out.append(name)

    add(sql)
    return tuple(out)


def oracle(sql: str) -> str:
    """``sql`` for DuckDB, with the views that it names defined in front."""
    views = [f"{n} AS ({VIEWS[n]})" for n in needed(sql)]
    text = sql.strip()
    if not views:
        return text
    head = "WITH " + ",\n".join(views)
    if text[:5].upper() == "WITH ":
        return f"{head},\n{text[5:]}"
    return f"{head}\n{text}"


class Tables:
    """The views (and given tables) of one data folder as DataFrames, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name not in VIEWS:
            raise AttributeError(name)
        views = (*needed(VIEWS[name]), name)
        base = [b for b in BASE if any(re.search(rf"\b{b}\b", VIEWS[v]) for v in views)]
        parts = [f"{b} AS (SELECT * FROM parquet.`{self.sf_dir}/{b}.parquet`)" for b in base]
        parts += [f"{v} AS ({VIEWS[v]})" for v in views]
        return self.spark.sql(f"WITH {', '.join(parts)} SELECT * FROM {name}")
