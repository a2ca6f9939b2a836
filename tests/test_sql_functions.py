"""Functions called from SQL text against the column expressions."""

import pytest
from pyspark.sql import functions as F

from claimforge.functions import sql
from claimforge.plans.testbed import Tables

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def views(spark):
    t = Tables(spark, DIR)
    for name in ("creditors", "links", "filings", "feed", "firmographics"):
        getattr(t, name).createOrReplaceTempView(name)
    return t, sql.register(spark)


# Function, table, arguments.
CALLS = [
    ("creditor_state", "creditors", ("address", "home_state")), ("creditor_city", "creditors", ("address",)), ("is_junk_name", "creditors", ("name",)),
    ("company_name", "creditors", ("name",)), ("company_key", "creditors", ("name", "address")), ("entity_type", "creditors", ("name",)), ("dedup_key", "creditors", ("name", "address")),
    ("dollars", "creditors", ("claim_amount",)), ("state_code", "feed", ("state",)), ("city_and_state", "feed", ("city", "state")), ("loss_amount", "feed", ("loss",)), ("safe_numeric", "feed", ("loss",)),
    ("docket_number", "feed", ("case_number",)), ("document_key", "filings", ("case_number",)), ("court_base", "filings", ("court_id",)), ("midpoint", "filings", ("liabilities", "liabilities")),
    ("tier_of_company", "firmographics", ("revenue", "employees")), ("schedule_cost", "firmographics", ("employees",)),
]


@pytest.mark.parametrize(("name", "table", "args"), CALLS)
def test_function(spark, views, name, table, args):
    t, done = views
    assert f"cf_{name}" in done
    key = getattr(t, table).columns[:3]
    got = spark.sql(f"SELECT {', '.join(key)}, cf_{name}({', '.join(args)}) AS value FROM {table}")
    want = getattr(t, table).select(*key, sql.SCALARS[name][1](*map(F.col, args)).alias("value"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and "Python" not in got._jdf.queryExecution().toString()


def test_every_function_is_called():
    assert {c[0] for c in CALLS} == set(sql.SCALARS)


def test_table_functions(spark, views):
    got = spark.sql("SELECT * FROM cf_repeat_exposure(DATE '1998-01-01', 4)").collect()
    want = spark.sql(
        "SELECT l.creditor_id, count(*) AS n, sum(claim_amount) AS total, count(*) >= 4 AS often FROM links l JOIN creditors USING (creditor_id) JOIN filings f USING (filing_id) "
        "WHERE filing_date >= '1998-01-01' GROUP BY l.creditor_id"
    ).collect()
    assert got and sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert [tuple(r) for r in spark.sql("SELECT * FROM cf_company_tiers(2000000000, 3)").collect()] == [(1, "Enterprise")]
    assert spark.sql("SELECT cf_creditor_state('1 A St, Reno, NV 89501', 'x')").first()[0] == "NV"
