"""Cases with known answers: spellings, nulls, ties, empty tables."""

import pytest
from pyspark.sql import functions as F

from claimforge.functions import money, names, places
from claimforge.operators import aggregates, components, extraction, fuzzy, incremental, linking, merging, ranking
from claimforge.sources import feeds
from claimforge.streaming import feeds as streams


def values(spark, rows, column, kind="string"):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(rows)], f"k int, v {kind}")
    return [r[0] for r in df.orderBy("k").select(column(F.col("v"))).collect()]


def test_junk_names(spark):
    got = values(spark, ["contact", "name", "1", "999", "1234", "ab", "Official Form 204", "Name of creditor and complete mailing address", "Acme Corp", None, "  "], names.is_junk_name)
    assert got == [True, True, True, True, False, True, True, True, False, None, True]


def test_company_names(spark):
    got = values(spark, ["Acme, Inc.", "Smith & Sons LLC", "ibm", None, "  ", "A.B  c"], names.company_name)
    assert got == ["ACME", "SMITH AND SONS", "INTERNATIONAL BUSINESS MACHINES", "", "", "A B C"]


def test_entities(spark):
    assert values(spark, ["Acme LLC", "Ann Lee and Bob Lee", "John Smith", "acme tools", "", None], names.entity_type) == ["company", "individual", "individual", "company", "company", "company"]


def test_dedup_key(spark):
    df = spark.createDataFrame([("ABC Corp.", "123 Main St., NY"), ("!!!", None), ("Café Ü", "1")], "n string, a string")
    assert [r[0] for r in df.select(names.dedup_key(F.col("n"), F.col("a"))).collect()] == ["abc corp 123 main st ny", "", "café ü 1"]


def test_states_and_cities(spark):
    rows = ["1 Main St, Reno, NV 89501", "Edinburg, TX", "1 Main St, Troy, NY and more", None, "x, ny"]
    assert values(spark, rows, lambda c: places.address_state(c, F.lit("ca"))) == ["NV", "TX", "CA", "CA", "CA"]
    assert values(spark, rows, places.address_city) == ["Reno", None, "Troy", None, None]
    assert values(spark, ["tx", " NY ", "see petition", "", None], places.state_code) == ["TX", "NY", None, None, None]


def test_case_numbers(spark):
    got = values(spark, ["2:23-bk-13359", "1:26bk12345", "x 24-10001 y", "odd", None], places.docket_number)
    assert got == ["23-13359", "26-12345", "24-10001", "odd", ""]
    assert values(spark, ["nysbk", "maebk", None], places.court_base) == ["nysb", "mieb", None]


def test_amounts(spark):
    rows = ["$3,524", "$1,234.56", "$", "n/a", "", None, "-$5.00", "1.2.3"]
    assert [None if v is None else float(v) for v in values(spark, rows, money.loss_amount)] == [3524.0, 1234.56, None, None, None, None, -5.0, None]
    assert [None if v is None else float(v) for v in values(spark, rows, money.safe_numeric)] == [3524.0, 1234.56, None, None, None, None, 5.0, None]


def creditors(spark, rows):
    full = [(k, 1, n, a, c, f, k + 1) for k, (n, a, c, f) in enumerate(rows)]
    return spark.createDataFrame(full, "row_id long, filing_id long, name string, address string, claim_amount double, confidence double, line_number int").withColumn(
        "claim_amount", F.col("claim_amount").cast("decimal(15,2)")
    )


DEDUP = [
    ([("ABC Corp", "123 Main St", 100.0, None), ("ABC Corporation", "123 Main St", 50.0, None)], 85, [("ABC Corporation", 150.0, 2)]),
    ([("ABC Corp", "123 Main St", 1.0, None), ("ABC Corp", "456 Oak Ave", 1.0, None)], 85, [("ABC Corp", 1.0, 1), ("ABC Corp", 1.0, 1)]),
    ([("Acme LLC", "1 A St", 10.0, None), ("Acme L.L.C.", "1 A Street", 20.0, None), ("Acme Limited", "1 A St", 30.0, None)], 75, [("Acme Limited", 60.0, 3)]),
    ([("Foo Inc", "1 St", None, None), ("Foo, Inc.", "1 St", None, None)], 85, [("Foo, Inc.", None, 2)]),
    ([("!!!", None, 1.0, None), ("???", None, 2.0, None)], 85, [("!!!", 1.0, 1), ("???", 2.0, 1)]),
    ([("Low Confidence LLC", "1 Main St", 1.0, 0.4), ("High Confidence LLC", "1 Main St", 2.0, 0.95)], 85, [("High Confidence LLC", 3.0, 2)]),
]


@pytest.mark.parametrize("rows,threshold,want", DEDUP)
def test_fuzzy_dedup(spark, rows, threshold, want):
    out = fuzzy.deduplicate(creditors(spark, rows), threshold=threshold).collect()
    assert sorted((r.name, None if r.claim_amount is None else float(r.claim_amount), r.n_rows) for r in out) == sorted(want)


def test_fuzzy_blocking_of_large_groups(spark):
    rows = keyed = fuzzy.keyed(creditors(spark, [(f"Acme {k // 2} Corp{'oration' * (k % 2)}", "1 St", 1.0, None) for k in range(60)]))
    pairs = fuzzy.score_pairs(fuzzy.candidate_pairs(rows, most=10), keyed, threshold=90)
    every = fuzzy.score_pairs(fuzzy.candidate_pairs(rows, most=100), keyed, threshold=90)
    assert {tuple(r) for r in every.select("left_id", "right_id").collect()} == {tuple(r) for r in pairs.select("left_id", "right_id").collect()}


def test_scores():
    assert fuzzy.token_set_score("", "a") == 0 and fuzzy.token_set_score("a b", "b a c") == 100
    assert round(fuzzy.token_set_score("abc corp 123 main st", "abc corporation 123 main st"), 1) == 85.7


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 1)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100}
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "u long, v long"), few=0).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


BATCH = "filing_id long, arrival long, creditor_name string, address string, claim_amount double, original_name string, confidence double, entity_type string"
STORE = "name string, address string, claim_amount decimal(15,2), original_name string, confidence double, source_filing_id long, is_company boolean"


def merge(spark, rows, store=(), **how):
    batch = spark.createDataFrame(rows, BATCH).withColumn("claim_amount", F.col("claim_amount").cast("decimal(15,2)"))
    return sorted(merging.merge_creditors(spark.createDataFrame(list(store), STORE), batch, **how).collect())


def test_merge_creditors(spark):
    rows = [(1, 1, " Acme ", "1 St", 100.0, None, None, None), (1, 2, "ACME", "1 st", 50.0, "acme!", 0.5, "individual"), (1, 3, "contact", None, 9.0, None, None, None), (2, 4, "Solo", None, None, None, None, "individual")]
    a, b = merge(spark, rows)
    assert (a.name, float(a.claim_amount), a.original_name, a.is_company, a.source_filing_id) == ("Acme", 150.0, "acme!", True, 1)
    assert (b.name, b.claim_amount, b.is_company) == ("Solo", None, False)
    again = merge(spark, rows, [tuple(r)[2:] for r in (a, b)])
    assert [float(r.claim_amount) for r in again] == [300.0, 0.0]  # additive: a second run adds, and null and null is 0
    assert merge(spark, [])[:1] == []


def test_merge_once(spark):
    rows = [(1, 1, "Acme", "1 St", 100.0, None, None, None), (1, 2, "Acme", "1 St", 120.0, None, None, None)]
    assert float(merge(spark, rows, additive=False)[0].claim_amount) == 120.0


def test_upsert_policies(spark):
    store = spark.createDataFrame([(1, "a", "x", False), (2, "b", None, True)], "k int, p string, q string, r boolean")
    batch = spark.createDataFrame([(1, None, "y", True), (3, "c", "z", None)], "k int, p string, q string, r boolean")
    got = sorted(map(tuple, merging.upsert(store, batch, ["k"], {"p": "patch", "q": "keep", "r": "any"}).collect()))
    assert got == [(1, "a", "x", True), (2, "b", None, True), (3, "c", "z", False)]
    assert sorted(map(tuple, merging.upsert(store, batch, ["k"]).collect()))[0] == (1, None, "y", True)


def test_documents_keep_their_link(spark):
    kind = "content_sha256 string, parser string, linked_filing long"
    merged, rejected = merging.upsert_documents(spark.createDataFrame([("a", "1", 5), ("b", "1", None)], kind), spark.createDataFrame([("a", "1", 6), ("b", "1", 7), ("c", "1", None)], kind))
    assert sorted(tuple(r)[::2] for r in merged.collect()) == [("a", 5), ("b", 7), ("c", None)]
    assert [tuple(r) for r in rejected.collect()] == [("a", "1", 5, 6)]


def test_config_changes(spark):
    kind = "k int, v string"
    out = merging.config_changes(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], kind), spark.createDataFrame([(1, "a"), (2, "x"), (4, "d")], kind), "k")
    assert sorted((r.k, r.change) for r in out.collect()) == [(2, "UPDATE"), (3, "DELETE"), (4, "INSERT")]


def test_claim_feed(spark, tmp_path):
    head = "Date Added,Date Filed,Impacted Business,Feed Zone,City,State,Case Number,Corporate Bankruptcy,Loss\n"
    (tmp_path / "a.csv").write_text("﻿" + head + 'x,2026-08-03,HIDALGO COUNTY,z,Edinburg,TX,7:2026bk70239,"AGD, L.P.","$3,524"\nx,,A,z,,,1,D,$\n', encoding="utf-8")
    rows = sorted(feeds.read_claim_feed(spark, f"{tmp_path}/a.csv").collect(), key=lambda r: r.line_number)
    assert [r.line_number for r in rows] == [2, 3] and rows[0]["Corporate Bankruptcy"] == "AGD, L.P." and "Date Added" in rows[0]
    (tmp_path / "b.csv").write_text("name,amount\na,1\n")
    with pytest.raises(ValueError, match="lacks the columns"):
        feeds.read_claim_feed(spark, f"{tmp_path}/b.csv")


def test_imports(spark):
    rows = spark.createDataFrame([(1, '{"rows":[{"name":"a"},{"name":"b"}]}'), (2, '{"body":{"rows":[{"name":"c"}]}}'), (3, "{}"), (4, None)], "import_id int, body string")
    got = sorted((r.import_id, r.row and r.row.name) for r in feeds.expand_import(rows, "struct<name:string>").collect())
    assert got == [(1, "a"), (1, "b"), (2, "c"), (3, None), (4, None)]


def test_docket_payloads(spark):
    rows = [(1, '[{"docket_number":"5","date_filed":"2024-01-02","text":"x","url":"u"},7]'), (2, '[[{"number":6,"filed_at":"bad"}]]'), (3, "no json"), (4, None)]
    got = sorted((r.filing_id, r.docket_number, str(r.filed_on), r.description, r.document_url) for r in extraction.docket_entries(spark.createDataFrame(rows, "filing_id int, payload string")).collect())
    assert got == [(1, "5", "2024-01-02", "x", "u"), (2, "6", "None", None, None)]


def test_company_responses(spark):
    rows = [(1, '{"data":[{"id":"9","attributes":{"name":"A","revenue":5,"employeeCount":7}}]}'), (2, '{"results":{"companyId":"8","score":0.5}}'), (3, '{"data":[]}'), (4, None)]
    got = sorted((r.creditor_id, r.company_id, r.name, r.revenue, r.employees, r.confidence) for r in extraction.company_responses(spark.createDataFrame(rows, "creditor_id int, body string")).collect())
    assert got == [(1, "9", "A", 5.0, 7.0, None), (2, "8", None, None, None, 0.5)]


def test_tables(spark):
    head, rows = ["Creditor Name", "Mailing Address", "Claim Amount"], [["1", "Acme LLC", "1 Main St", "$1,200.50"], ["", None, "", ""], ["Total", "", "", "$5"]]
    tables = spark.createDataFrame([(1, [[head, *rows]]), (2, [[["Date", "Event"], ["x", "y"]]]), (3, None)], "doc_id int, tables array<array<array<string>>>")
    got = [(r.doc_id, r.row, r.name, r.address, float(r.claim_amount)) for r in extraction.table_creditors(tables).collect()]
    assert got == [(1, 1, "Acme LLC", "1 Main St", 1200.5)]


def test_cells_of_tables(spark):
    head = ["Creditor Name", "Mailing Address", "Claim Amount"]
    rows = [
        ["1", "Acme Tools LLC", "Nature of claim", "12 Main St", "$9"], ["Beta Co", "TX", "5 Oak Ave"], ["$5", "Gamma Inc", "\t7 Elm Rd\r"], ["Delta LLC", "...", "1.2.3", "$7."],
        ["2", "Epsilon Corp"], ["Total", "99"],
    ]
    tables = spark.createDataFrame([(1, [[head, *rows]]), (2, [[["Schedule E/F: Creditors", ""], head, rows[0]]]), (3, [[["Unsecured"]]])], "doc_id int, tables array<array<array<string>>>")
    show = lambda df: [(r.doc_id, r.row, r.name, r.address, r.claim_amount and float(r.claim_amount)) for r in df.orderBy("doc_id", "row").collect()]
    first = [(1, 1, "Acme Tools LLC", "12 Main St", 9.0), (1, 2, "Beta Co", "5 Oak Ave", None), (1, 3, "Gamma Inc", "7 Elm Rd", 5.0), (1, 4, "Delta LLC", "...", 7.0), (1, 5, "Epsilon Corp", None, 2.0)]
    title = (2, 2, "Acme Tools LLC", "12 Main St", 9.0)
    assert show(extraction.table_creditors(tables)) == [*first, title]
    assert show(extraction.schedule_creditors(tables)) == [*first, title]


def test_texts(spark):
    blocks = "List of Creditors\n\n1. Acme LLC\n12 Main St\nReno, NV\n$1,250.50\n\nSingle line\n\nBeta Inc\n5 Oak"
    flat = "heading\n1. Acme LLC\n12 Main St\n2. Beta Inc\n$7"
    docs = spark.createDataFrame([(1, blocks), (2, flat), (3, None), (4, "")], "filing_id int, text string")
    assert sorted((r.filing_id, r.name, r.line_number) for r in extraction.creditor_blocks(docs.where("filing_id <> 2")).collect()) == [(1, "Acme LLC", 1), (1, "Beta Inc", None)]
    assert sorted((r.filing_id, r.name, r.address) for r in extraction.numbered_creditors(docs.where("filing_id <> 1")).collect()) == [(2, "Acme LLC", "12 Main St"), (2, "Beta Inc", "$7")]


def test_kinds(spark):
    docs = spark.createDataFrame([(1, "Voluntary Petition Form 201"), (2, "creditor matrix"), (3, "SOFA"), (4, "nothing"), (5, None), (6, "Schedule A form 204")], "doc_id int, text string")
    assert {r.doc_id: r.kind for r in extraction.classify(docs).collect()} == {1: "form_201", 2: "creditor_matrix", 3: "sofa", 4: "unknown", 5: "unknown", 6: "creditor_matrix"}


def test_account_matches(spark):
    kind = "creditor_id int, name string, normalized_name string, state string"
    rows = [(1, "Acme LLC", "ACME", "TX"), (2, "Beta", "BETA", "NY"), (3, "Gamma Co", "GAMMA", None), (4, "New", "NEW", "TX"), (5, "Raw LLC", "RAW", "TX")]
    accounts = [(10, "acme", "NV"), (20, "Beta", "NY"), (21, "BETA", "TX"), (30, "gamma", "NY"), (31, "Gamma", "NY"), (50, "raw llc", None)]
    out = linking.match_accounts(spark.createDataFrame(rows, kind), spark.createDataFrame(accounts, "account_id int, account_name string, billing_state string"))
    assert {r.creditor_id: (r.action, r.account_id) for r in out.collect()} == {1: ("reuse", 10), 2: ("reuse", 20), 3: ("review", None), 4: ("create", None), 5: ("reuse", 50)}


def test_ledger(spark):
    kind = "case_number string, filed date, attempts string, last_date date"
    ledger = spark.createDataFrame([("a", None, "2", None), ("b", None, "1", None), ("c", None, "x", None)], kind)
    left = incremental.skip_known_misses(spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "case_number string"), ledger, "2026-01-01")
    assert sorted(r[0] for r in left.collect()) == ["b", "c", "d"]


def test_messages_split(spark):
    rows = [(k, k % 3, f"D{k % 3}", f"24-{k % 3}", None, f"C{k}", None, "TX", f"${k}.00", "New", "", None) for k in range(41)]
    kind = "creditor_id int, filing_id int, debtor_name string, case_number string, filing_date date, creditor string, city string, state string, claim string, status string, profile_url string, tier int"
    df = spark.createDataFrame(rows, kind).withColumn("filing_date", F.lit("2024-01-01").cast("date"))
    assert aggregates.report_messages(df.where("creditor_id < 40")).count() == 1
    texts = {r.case_number: r.text for r in aggregates.report_messages(df).collect()}
    assert len(texts) == 4 and texts[""] == "3 debtors, 41 creditors" and texts["24-0"].split("\n")[1].startswith("• C39 | TX | $39.00 | — | New")


def test_budget(spark):
    rows = spark.createDataFrame([(1, "2024-01-01", 3), (2, "2024-01-01", 3), (3, "2024-01-02", 3)], "filing_id int, filed_on string, cost int")
    assert {r.filing_id: r.outcome for r in ranking.budgeted(rows, 6).collect()} == {1: "attempted", 2: "attempted", 3: "unattempted"}


def test_streams_agree_with_batch(spark, tmp_path):
    rows = [(k, "p", "failed" if k % 3 else "ok", f"2024-01-01 0{k % 5}:00:0{k % 7}", "w") for k in range(50)]
    df = spark.createDataFrame(rows, "job_id int, job_type string, status string, created_at string, worker string").withColumn("created_at", F.to_timestamp("created_at"))
    df.repartition(6).write.parquet(f"{tmp_path}/in")
    stream = streams.file_stream(spark, df.schema, f"{tmp_path}/in", files_per_batch=2)
    got = streams.run_available(streams.job_counts(stream, delay="1 day"), "counts", "complete")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, streams.job_counts(df).collect()))


def test_many_words_by_one_automaton(spark):
    """50,000 rules over texts, against brute force; with the same texts the time hardly depends on their number."""
    import random
    import time

    from claimforge.functions import names

    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcdefghijkl") for _ in range(n))
    rules = list(dict.fromkeys(word(rng.randrange(5, 9)) for _ in range(60_000)))[:50_000]
    texts = [" ".join(word(rng.randrange(3, 9)) for _ in range(6)) for _ in range(2000)] + [rules[7].upper() + " x", "", None, "ÉCOLE"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(2).cache()
    df.count()
    took = []
    for known in (rules[:1000], rules):
        start = time.perf_counter()
        got = {r.i: r.hit for r in df.select("i", names.holds_any(F.col("t"), known).alias("hit")).collect()}
        took.append(time.perf_counter() - start)
        held = set(known)
        want = {i: t is not None and any(t.lower()[a : a + n] in held for n in range(5, 9) for a in range(len(t))) for i, t in enumerate(texts)}
        assert got == want and any(want.values())
    assert took[1] < 10 * took[0] + 5  # fifty times the rules
    few = {r.i: r.hit for r in df.select("i", names.holds_any(F.col("t"), rules[:50]).alias("hit")).collect()}
    assert few == {i: t is not None and any(w in t.lower() for w in rules[:50]) for i, t in enumerate(texts)}
    assert df.where(names.holds_any(F.col("t"), [""])).count() == len(texts) - 1
