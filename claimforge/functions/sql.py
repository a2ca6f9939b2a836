"""The column expressions as functions that SQL text can call.

Each function is defined once, as a Python function of columns; ``register`` lets Spark resolve
it over columns of the parameters' types and hands the resulting expression back as the body of a temporary SQL function. No
Python runs when such a function is called.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from claimforge.functions import money, names, places

AMOUNT = money.MONEY

# Name, parameters with types, expression.
SCALARS: dict[str, tuple[dict[str, str], Callable[..., Column]]] = {
    "creditor_state": ({"address": "string", "fallback": "string"}, places.address_state),
    "creditor_city": ({"address": "string"}, places.address_city),
    "state_code": ({"state": "string"}, places.state_code),
    "city_and_state": ({"city": "string", "state": "string"}, places.city_state),
    "docket_number": ({"case_number": "string"}, places.docket_number),
    "document_key": ({"case_number": "string"}, places.document_key),
    "court_base": ({"court_id": "string"}, places.court_base),
    "safe_numeric": ({"text": "string"}, money.safe_numeric),
    "loss_amount": ({"text": "string"}, money.loss_amount),
    "dollars": ({"amount": AMOUNT}, money.dollars),
    "midpoint": ({"low": AMOUNT, "high": AMOUNT}, money.midpoint),
    "tier_of_company": ({"revenue": "bigint", "employees": "int"}, lambda revenue, employees: money.tier_by_table(revenue, employees)[0]),
    "schedule_cost": ({"pages": "int"}, money.schedule_cost),
    "is_junk_name": ({"name": "string"}, names.is_junk_name),
    "company_name": ({"name": "string"}, names.company_name),
    "company_key": ({"name": "string", "address": "string"}, names.company_key),
    "entity_type": ({"name": "string"}, names.entity_type),
    "dedup_key": ({"name": "string", "address": "string"}, names.dedup_key),
}

# Functions that give tables: parameters, columns, query. They read views of these names, which the caller defines.
TABLES = {
    "repeat_exposure": (
        "since DATE, least INT",
        "creditor_id BIGINT, n_filings BIGINT, total DECIMAL(25,2), is_repeat BOOLEAN",
        "SELECT l.creditor_id, count(*), sum(c.claim_amount), count(*) >= repeat_exposure.least FROM links l JOIN creditors c ON l.creditor_id = c.creditor_id "
        "JOIN filings f ON l.filing_id = f.filing_id WHERE f.filing_date >= repeat_exposure.since GROUP BY l.creditor_id",
    ),
    "company_tiers": (
        "revenue BIGINT, employees INT",
        "tier INT, label STRING",
        "SELECT t.tier, t.label FROM VALUES {tiers} AS t(tier, label) WHERE t.tier = {prefix}tier_of_company(company_tiers.revenue, company_tiers.employees)",
    ),
}


def _body(spark: SparkSession, parameters: dict[str, str], expression: Callable[..., Column]) -> tuple[str, str]:
    """SQL text and type of the expression over columns named as the parameters."""
    empty = spark.createDataFrame([], ", ".join(f"{p} {t}" for p, t in parameters.items()))
    made = empty.select(expression(*map(F.col, parameters)).alias("value"))
    alias = made._jdf.queryExecution().analyzed().expressions().head()
    return alias.child().sql(), made.schema[0].dataType.simpleString()


def register(spark: SparkSession, prefix: str = "cf_") -> list[str]:
    """Define all functions for the session's SQL, each name after ``prefix``; returns the names.

    Table functions need views ``links, creditors, filings``; those that find no such view are left out.
    """
    done = []
    for name, (parameters, expression) in SCALARS.items():
        body, kind = _body(spark, parameters, expression)
        listed = ", ".join(f"{p} {t}" for p, t in parameters.items())
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({listed}) RETURNS {kind} RETURN {body}")
        done.append(prefix + name)
    tiers = ", ".join(f"({n}, '{label}')" for n, label, *_ in money.TIERS)
    for name, (parameters, columns, query) in TABLES.items():
        if name == "repeat_exposure" and not all(spark.catalog.tableExists(v) for v in ("links", "creditors", "filings")):
            continue
        query = query.replace(f"{name}.", f"{prefix}{name}.").format(tiers=tiers, prefix=prefix)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({parameters}) RETURNS TABLE ({columns}) RETURN {query}")
        done.append(prefix + name)
    return done
