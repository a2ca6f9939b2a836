"""Patterns are looked for once for each text, and kinds are decided once for each document."""

from pyspark.sql import functions as F

from claimforge.operators import extraction
from claimforge.plans import flows


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_each_pattern_of_a_form_is_looked_for_once(spark):
    spark.conf.set("spark.sql.maxPlanStringLength", 10_000_000)
    docs = spark.createDataFrame([(1, "Debtor name: A\nState: \nReno, NV 89501\nEstimated assets: $1,000 or more"), (2, None)], "filing_id long, text string")
    tables = spark.createDataFrame([(2, [[["Liabilities", "less than $8,000"], ["Assets", None]]])], "filing_id long, tables array<array<array<string>>>")
    out = extraction.form_fields(docs, tables=tables)
    assert _plan(out).count("regexp_extract(") <= 10 + 4 * 5
    got = {r.filing_id: r for r in out.collect()}
    assert (got[1].debtor_name, got[1].state, got[1].least_assets, got[1].most_assets) == ("A", "NV", 1000, None)
    assert (got[2].debtor_name, got[2].least_liabilities, got[2].most_liabilities) == (None, None, 8000)


def test_kinds_are_decided_once(spark, monkeypatch):
    stored = []
    keep = flows.materialize
    monkeypatch.setattr(flows, "materialize", lambda df, name: stored.append(name) or keep(df, name))
    docs = spark.createDataFrame([(1, "Official Form 201")], "doc_id long, text string")
    tables = spark.createDataFrame([], "doc_id long, tables array<array<array<string>>>")
    out = flows.parse_documents(docs, docs.limit(0).select(F.sha2("text", 256).alias("content_sha256")), tables)
    assert "kinds" in stored and "RLIKE" not in _plan(out["kinds"])
    assert [r.kind for r in out["kinds"].collect()] == ["form_201"]


def test_amounts_on_the_line_after_their_sign(spark):
    docs = spark.createDataFrame([(1, "x\n1. Acme\n$\n 5.50\n2. Beta\n$\n3. Gamma\n Road\n $7\n$8")], "filing_id long, text string")
    got = [(r.block, r.name, r.address, r.claim_amount and float(r.claim_amount)) for r in extraction.numbered_creditors(docs).orderBy("block").collect()]
    assert got == [(1, "Acme", "$, 5.50", 5.5), (2, "Beta", "$", None), (3, "Gamma", "Road, $7", 7.0)]


def test_numbered_lines_are_not_shuffled(spark):
    docs = spark.createDataFrame([(1, "1. Acme\nRoad")], "filing_id long, text string")
    plan = extraction.numbered_creditors(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_junk_of_a_cell_is_told_once(spark):
    docs = spark.createDataFrame([(1, [[["creditor name"], ["Contact", "Acme", "$5", "Reno", "$7."]]])], "doc_id long, tables array<array<array<string>>>")
    out = extraction.table_creditors(docs)
    assert _plan(out).count("mailing address") == 1
    assert [(r.name, r.address, float(r.claim_amount)) for r in out.collect()] == [("Acme", "Reno", 7.0)]


def test_sources_are_read_once(spark):
    docs = spark.createDataFrame([(1, "Acme\nRoad\n\n1. Beta\nStreet"), (2, "1. Gamma")], "doc_id long, text string")
    tables = spark.createDataFrame([], "doc_id long, tables array<array<array<string>>>")
    out = extraction.extract_creditors(docs, tables)
    assert "regexp" not in _plan(out)
    assert sorted((r.doc_id, r.name) for r in out.collect()) == [(1, "Acme"), (1, "Beta"), (2, "Gamma")]


def test_bodies_are_parsed_once(spark):
    """Of a body's JSON, its person and the full name none is put into a filter again, also when a later step filters by the name."""
    bodies = ['{"data":[{"attributes":{"firstName":"A","last_name":"B","score":"2","title":"x"}},{"title":"y"}]}', '{"message":"none","name":"C"}', '{"fullName":" D "}', "null", "{", None]
    out = extraction.contact_responses(spark.createDataFrame(list(enumerate(bodies)), "creditor_id int, body string")).where("trim(full_name) <> ''")
    assert (_plan(out).count("parseJson"), _plan(out).count("$.attributes"), _plan(out).count("$.fullName")) == (1, 1, 1)
    assert sorted((r.creditor_id, r.place, r.full_name, r.title, r.engagement) for r in out.collect()) == [(0, 0, "A B", "x", 2.0), (2, 0, " D ", None, 0.0)]


def test_headings_come_from_first_lines(spark, tmp_path):
    from claimforge.sources import feeds

    for name, text in (("a", 'x,"y\nz"\n1,2\n'), ("b", '\n\nx,"y\nz"\n3,4\n5,6\n')):
        (tmp_path / f"{name}.csv").write_text(text)
    assert feeds.csv_records(spark, str(tmp_path), 3).count() == 3  # a: both records; b: a cut one
    for n in (1, 3, 1000):  # cut ones are read whole
        assert feeds._headings(spark, str(tmp_path), n) == ['x,"y\nz"']
    (tmp_path / "c.csv").write_text("other\n")
    assert sorted(feeds._headings(spark, str(tmp_path))) == ["other", 'x,"y\nz"']
