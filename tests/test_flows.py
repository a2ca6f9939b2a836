"""Whole flows, write-back, versions, forms and feeds on small cases with known results."""

import itertools
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimforge.operators import extraction, fuzzy, merging, ranking
from claimforge.plans import flows
from claimforge.plans.queries import QUERIES
from claimforge.session import shared_folder
from claimforge.sources import feeds
from claimforge.streaming import feeds as streams

DIR = "/root/testdata/sf0.001"
MATRIX = (
    "List of Creditors\n\n1. Acme Corp\n12 Main St\nReno, NV 89501\n$1,200.00\n\n2. Acme Corporation\n12 Main St\nReno, NV 89501\n$300.00\n\n"
    "3. Beta Tools LLC\n5 Oak Ave\nTroy, NY 12180\n$5"
)


def test_parsed_documents(spark):
    docs = spark.createDataFrame([(1, MATRIX), (2, "nothing of note"), (3, MATRIX + " "), (4, None)], "doc_id long, text string")
    known = docs.where("doc_id = 3").select(F.sha2("text", 256).alias("content_sha256"))
    tables = spark.createDataFrame([], "doc_id long, tables array<array<array<string>>>")
    out = flows.parse_documents(docs, known, tables)
    assert {r.doc_id: r.kind for r in out["kinds"].collect()} == {1: "creditor_matrix", 2: "unknown", 4: "unknown"}
    got = sorted((r.doc_id, r.name, r.address, r.claim_amount, r.n_rows) for r in out["creditors"].collect())
    assert got == [
        (1, "Acme Corporation", "12 Main St, Reno, NV 89501", Decimal("1500.00"), 2), (1, "Beta Tools LLC", "5 Oak Ave, Troy, NY 12180", Decimal("5.00"), 1)
    ]
    assert [(r.doc_id, r.share, r.needs_review) for r in out["validation"].collect()] == [(1, 1.0, False)]


def test_extracted_creditors_take_the_first_source(spark):
    docs = spark.createDataFrame([(1, MATRIX), (2, MATRIX), (3, "x"), (4, "intro\n1. Gamma Inc\n9 Elm Rd\n2. Delta Co\n8 Elm Rd")], "doc_id long, text string")
    tables = spark.createDataFrame([(2, [[["Creditor Name", "Claim"], ["Omega LLC", "$7"]]])], "doc_id long, tables array<array<array<string>>>")
    got = sorted((r.doc_id, r.source, r.name) for r in extraction.extract_creditors(docs, tables).collect())
    want = [(1, 1, "Acme Corp"), (1, 1, "Acme Corporation"), (1, 1, "Beta Tools LLC"), (2, 0, "Omega LLC")]
    assert [g for g in got if g[0] < 4] == want and {g[0] for g in got} == {1, 2, 4}


def test_applied_corrections(spark):
    known = [("Alpha Tools LLC", "7 Oak Ave"), ("Northern Freight Inc", "77 River Rd"), ("Gamma Bank", "5 Elm Ct")]
    rows = [(1, k, n, a, Decimal(10), 0.9, k) for k, (n, a) in enumerate(known)]
    rows += [(1, 10, "Alpha Tools Limited LLC", "7 Oak Ave", Decimal(5), 0.5, 10), (2, 20, "", "", Decimal(1), None, 1)]
    corrected = spark.createDataFrame(rows, "doc_id long, row_id long, name string, address string, claim_amount decimal(15,2), confidence double, line_number int")
    kind = "name string, address string, claim_amount decimal(15,2), original_name string, confidence double, source_filing_id long, is_company boolean"
    store = spark.createDataFrame([("northern freight inc", "77 RIVER RD", Decimal(100), None, None, 7, True)], kind)
    merged, rejected = flows.apply_corrections(corrected, store)
    got = {r.name_key: (r.claim_amount, r.source_filing_id) for r in merged.collect()}
    # Alpha's tokens are a part of the longer name's, so both are one.
    assert got == {"northern freight inc": (Decimal("110.00"), 7), "gamma bank": (Decimal("10.00"), 1), "alpha tools llc": (Decimal("15.00"), 1)}
    assert [r.doc_id for r in rejected.collect()] == [2]


def fuzzy_rows(spark):
    from claimforge.plans import changes
    from claimforge.plans.testbed import Tables

    return fuzzy.keyed(changes._fuzzy_rows(Tables(spark, DIR))).collect()


def test_fuzzy_queries_against_brute_force(spark):
    rows = fuzzy_rows(spark)
    groups = defaultdict(list)
    for r in rows:
        groups[r.filing_id].append(r)
    pairs = [(a, b) if a.row_id < b.row_id else (b, a) for g in groups.values() for a, b in itertools.combinations(g, 2)]
    scored = {(a.row_id, b.row_id): fuzzy.token_set_score(a.key, b.key) for a, b in pairs}
    want = {k: round(v, 9) for k, v in scored.items() if v >= 85}
    assert {(r.left_id, r.right_id): round(r.score, 9) for r in QUERIES["d2_scored_pairs"](spark, DIR).collect()} == want
    up = {r.row_id: r.row_id for r in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in want:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    clusters = defaultdict(list)
    for r in rows:
        clusters[root(r.row_id)].append(r)
    sums = Counter((m[0].filing_id, k, len(m), sum((x.claim_amount for x in m if x.claim_amount is not None), Decimal(0))) for k, m in clusters.items())
    got = QUERIES["d_deduplicated_creditors"](spark, DIR).collect()
    assert Counter((r.filing_id, r.cluster_id, r.n_rows, r.claim_amount or Decimal(0)) for r in got) == sums


def test_token_scores_query(spark):
    from claimforge.plans.testbed import Tables

    t = Tables(spark, DIR)
    key = {r[0]: r[1] for r in t.creditors.select("creditor_id", fuzzy.names.dedup_key(F.col("name"), F.col("address"))).collect()}
    got = {r.row_id: r.score for r in QUERIES["n9_token_scores"](spark, DIR).collect()}
    assert got == {k: fuzzy.token_set_score(key[k], key[k + 1]) for k in key if k + 1 in key}


def test_write_back(spark):
    creditors = spark.createDataFrame([(k, "old", 3) for k in range(1, 6)], "creditor_id int, company_id string, company_tier int")
    contacts = spark.createDataFrame([(1, "old", "Ann", "person"), (1, "old", "Bob", "person"), (2, "old", "Cy", "person")], "creditor_id int, company_id string, full_name string, kind string")
    kind = "creditor_id int, status string, company_id string, name string, revenue long, employees int"
    results = spark.createDataFrame([(1, "full", " 77 ", "One Inc", 2_000_000, None), (2, "limit", "78", "Two", 1, 1), (3, "part", "79", "Three", 1, 1), (4, "full", None, None, None, None)], kind)
    out, left = merging.write_back(creditors, contacts, results)
    got = {r.creditor_id: (r.company_id, r.company_tier, r.canonical_name, r.outcome) for r in out.collect()}
    assert got == {
        1: ("77", 1, "One Inc", "matched"), 2: ("old", 3, None, "failed"), 3: ("old", 3, None, "no_match"), 4: ("old", 3, None, "matched"), 5: ("old", 3, None, None)
    }
    assert sorted((r.creditor_id, r.kind, r.full_name) for r in left.where("creditor_id < 3").collect()) == [(1, "company", "One Inc"), (2, "person", "Cy")]


def test_versions(spark):
    path = shared_folder(spark, "store")
    for k in (1, 2):
        merging.write_version(spark.range(k), path)
    spark.range(9).write.parquet(f"{path}/v{10**19}")  # written by one that did not come to its end
    assert merging.read_version(spark, path).count() == 2


def test_poll_candidates_need_a_limit(spark):
    filings = spark.createDataFrame([(1, "a", "TX", 1), (2, "b", "NY", 2), (3, " ", "TX", 3)], "filing_id int, case_number string, state string, created_on int")
    checks = spark.createDataFrame([], "filing_id int, checked_on date")
    for limit in (None, 0):
        with pytest.raises(ValueError, match="limit"):
            ranking.poll_candidates(filings, checks, limit)
    targets = spark.createDataFrame([("TX",), ("TX",)], "state string")
    assert [r.filing_id for r in ranking.poll_candidates(filings, checks, 5, targets).collect()] == [1]


def test_form_fields(spark):
    texts = [
        "Debtor 1: Acme LLC\nCity: San Jose\nState: CA\nDistrict of Utah\nNAICS: 445110\nestimated assets $1,000 – $2,000.50\n" + "x" * 900 + "\nestimated liabilities: less than $500\n10 to 49 creditors",
        "Reno, NV 89501\nNature of business: shop 445120\n$9 or more\n200 or more creditors", "less than 50 creditors", None,
    ]
    out = extraction.form_fields(spark.createDataFrame(list(enumerate(texts)), "filing_id int, text string"))
    got = [tuple(r)[1:] for r in sorted(out.collect())]
    d = Decimal
    assert got[0] == ("Acme LLC", "San Jose", "CA", "District of Utah", "445110", d("1000.00"), d("2000.50"), None, d("500.00"), 10, 49)
    assert got[1] == (None, None, "NV", None, "445120", d("9.00"), None, d("9.00"), None, 200, None)
    assert got[2] == (None,) * 5 + (None, d("50.00"), None, d("50.00"), None, 50) and got[3] == (None,) * 11


def test_form_ranges_from_tables(spark):
    """Only a range that the text lacks altogether is looked for in the tables."""
    docs = spark.createDataFrame([(1, "estimated assets $3,000,000 or more"), (2, "no ranges"), (3, "none"), (4, "no ranges")], "filing_id int, text string")
    cells = [["Form", None], ["Total ASSETS", "$5 to $6"], ["Liabilities", "less than $8"]]
    tables = spark.createDataFrame([(1, [cells]), (2, [cells]), (4, [[["Other", "$1 or more"]]])], "filing_id int, tables array<array<array<string>>>")
    got = {r.filing_id: (r.least_assets, r.most_assets, r.least_liabilities, r.most_liabilities) for r in extraction.form_fields(docs, tables=tables).collect()}
    d = Decimal
    assert got == {1: (d(3_000_000), None, d(3_000_000), None), 2: (d(5), d(6), None, d(8)), 3: (None,) * 4, 4: (d(1), None, d(1), None)}


def test_parsed_forms_with_tables(spark):
    docs = spark.createDataFrame([(1, "Official Form 201\nDebtor name: Acme LLC")], "doc_id long, text string")
    tables = spark.createDataFrame([(1, [[["Assets", "$5 or more"]]])], "doc_id long, tables array<array<array<string>>>")
    out = flows.parse_documents(docs, spark.createDataFrame([], "content_sha256 string"), tables)
    assert [(r.least_assets, r.most_assets) for r in out["forms"].collect()] == [(Decimal(5), None)]


def test_white_space_of_every_kind(spark):
    text = "List of Creditors\n\n\u00a01.\tAcme Tools LLC\t\r\n\t12 Main St\r\nReno, NV \x0b$ 1,200\n\n2. Beta Inc\u2028 5 Oak Ave"
    docs = spark.createDataFrame([(1, text)], "filing_id int, text string")
    want = [(1, "Acme Tools LLC", "12 Main St, Reno, NV", Decimal(1200)), (2, "Beta Inc", "5 Oak Ave", None)]
    for rows in (extraction.creditor_blocks(docs), extraction.numbered_creditors(docs)):
        assert sorted((r.line_number, r.name, r.address, r.claim_amount) for r in rows.collect()) == want


def test_numbered_lines_in_many_ranges(spark):
    """A long document whose blocks cross the ranges, with an amount on the line after its sign, against a plain reading."""
    lines, want = ["before"], []
    for k in range(1, 400):
        more = k % 5
        lines += [f"{k}. Firm {k} LLC", *[f"{k} Street {j}" for j in range(more)], *(["due $", f"{k},000"] if k % 3 == 0 else []), *([f"${k}.50"] if k % 2 else [])]
        own = [f"{k} Street {j}" for j in range(more)] + (["due $", f"{k},000"] if k % 3 == 0 else []) + ([f"${k}.50"] if k % 2 else [])
        amount = Decimal(k * 1000) if k % 3 == 0 else Decimal(f"{k}.50") if k % 2 else None
        want.append((k, k, f"Firm {k} LLC", ", ".join(own[:2]) or None, amount))
    docs = spark.createDataFrame([(1, "\n".join(lines)), (None, "1. Only Inc"), (3, None)], "filing_id int, text string")
    got = extraction.numbered_creditors(docs, range_lines=7).collect()
    assert sorted((r.block, r.line_number, r.name, r.address, r.claim_amount) for r in got if r.filing_id == 1) == want
    assert [(r.block, r.name) for r in got if r.filing_id is None] == [(1, "Only Inc")]


def test_feed_items_with_other_spellings(spark):
    rows = [(1, None, "Form 204 voluntary petition see https://ecf.nysb.uscourts.gov/doc1/55 now", "24-12345 Acme LLC", None, "i1", "2024-05-06T01:02", "l")]
    kind = "event_id int, content string, contentSnippet string, title string, guid string, id string, isoDate string, link string"
    r = extraction.feed_events(spark.createDataFrame(rows, kind).withColumn("published_at", F.lit(None).cast("timestamp"))).first()
    assert (r.signal_score, r.is_qualified, r.filing_date, r.unique_key) == (55, True, "2024-05-06", ":24-12345:i1")
    assert r.document_url == "https://ecf.nysb.uscourts.gov/doc1/55"


def test_import_rejects(spark):
    rows = spark.createDataFrame([(1, '{"rows":[{"name":"a"}]}'), (3, "{}"), (4, None), (5, '{"rows":[]}')], "import_id int, body string")
    assert sorted(r.import_id for r in feeds.import_rejects(rows, "struct<name:string>").collect()) == [3, 4, 5]


def test_hints(spark):
    docs = spark.createDataFrame([(1, "form 201", "sofa"), (2, "form 201", "other"), (3, "", "SCHEDULE")], "doc_id int, text string, hint string")
    assert {r.doc_id: r.kind for r in extraction.classify(docs, hint_col="hint").collect()} == {1: "sofa", 2: "form_201", 3: "schedule"}


CLAIM = "filing_id long, creditor_id long, amount decimal(15,2)"


def claim_files(spark, source, parts):
    for part in parts:
        spark.createDataFrame(part, CLAIM).coalesce(1).write.mode("append").parquet(source)
    return streams.file_stream(spark, spark.createDataFrame([], CLAIM).schema, source, 1)


def exposure(rows):
    return {r.creditor_id: (r.filing_count, r.total_claims) for r in rows.collect()}


def test_exposure_store_of_a_stream(spark):
    """Claims that arrive in several files, one of them again, against one pass over all; a second run and a second stream add."""
    claims = [(f, c, Decimal(10 * c + f)) for f in range(6) for c in range(3)]
    source, other, store = (shared_folder(spark, n) for n in ("claims", "claims", "exposure"))
    stream = claim_files(spark, source, [[c for c in claims if c[0] % 3 == k] for k in range(3)] + [claims[:4]])
    all_of = lambda rows: {c: (len(m), sum(m.values())) for c in {r[1] for r in rows} for m in [{f: a for f, d, a in rows if d == c}]}
    assert exposure(streams.exposure_store(stream, store)) == all_of(claims)
    more = [(90, 1, Decimal(5)), (91, 7, Decimal(6))]
    assert exposure(streams.exposure_store(claim_files(spark, source, [more]), store)) == all_of(claims + more)
    assert exposure(streams.exposure_store(claim_files(spark, other, [claims[:2], [(92, 0, Decimal(1))]]), store, "other")) == all_of([*claims, *more, (92, 0, Decimal(1))])


@pytest.mark.parametrize("where", ["before", "ready", "done"])
def test_exposure_store_that_is_killed(spark, monkeypatch, where):
    """A run that ends in its second batch (before the merge, between merge and overwrite, before Spark notes the batch) and is begun again."""
    from claimforge.operators import keyed_store

    claims = [(f, c, Decimal(10 * c + f)) for f in range(6) for c in range(5)]
    source, store = shared_folder(spark, "claims"), shared_folder(spark, "exposure")
    stream = claim_files(spark, source, [[c for c in claims if c[0] % 3 == k] for k in range(3)])
    calls, merge, overwrite = [], keyed_store.merge, keyed_store._overwrite

    def failing_merge(*args):
        calls.append(1)
        if where == "before" and len(calls) == 2:
            raise RuntimeError("killed")
        out = merge(*args)
        if where == "done" and len(calls) == 2:
            raise RuntimeError("killed")
        return out

    def failing_overwrite(*args):
        if where == "ready" and len(calls) == 2:
            raise RuntimeError("killed")
        overwrite(*args)

    monkeypatch.setattr(keyed_store, "merge", failing_merge)
    monkeypatch.setattr(keyed_store, "_overwrite", failing_overwrite)
    with pytest.raises(Exception, match="killed"):
        streams.exposure_store(stream, store)
    monkeypatch.undo()
    got = exposure(streams.exposure_store(claim_files(spark, source, []), store))
    assert got == {c: (6, Decimal(sum(10 * c + f for f in range(6)))) for c in range(5)}


def test_store_writes_only_touched_buckets(spark):
    from pathlib import Path

    from claimforge.operators import keyed_store

    path, kind = shared_folder(spark, "store"), "k long, v long"
    newest = lambda rows: rows.groupBy("k").agg(F.max("v").alias("v"))
    batch = lambda rows: spark.createDataFrame(rows, kind)
    assert keyed_store.read(spark, path, batch([]).schema).count() == 0
    assert keyed_store.merge(path, batch([(k, 1) for k in range(50)]), ["k"], newest, "w", 0, 8)
    files = lambda: {f: f.stat().st_mtime_ns for f in Path(path.removeprefix("file:")).glob("rows/bucket=*/*.parquet")}
    before = files()
    assert keyed_store.merge(path, batch([(3, 2)]), ["k"], newest, "w", 1) and not keyed_store.merge(path, batch([(3, 9)]), ["k"], newest, "w", 1)
    assert keyed_store.merge(path, batch([]), ["k"], newest, "w", 2)
    assert len({f.parent for f in files().keys() ^ before.keys()}) == 1
    assert sorted(map(tuple, keyed_store.read(spark, path, batch([]).schema).collect())) == [(k, 2 if k == 3 else 1) for k in range(50)]


def test_second_key_of_feed_items(spark):
    kind = "event_id int, content string, title string, guid string, link string, published_at timestamp, event_number string"
    rows = [(1, "x", "24-12345 Acme", "a", "https://ecf.nysb.uscourts.gov/1", "9"), (2, "x", "24-12345 Acme", "b", "https://ecf.nysb.uscourts.gov/2", "9"), (3, "x", "24-12345 Acme", "c", "https://ecf.nysb.uscourts.gov/3", "10"), (4, "x", "no case", "d", "l", None), (5, "x", "no case", "e", "l", None)]
    path = shared_folder(spark, "items")
    spark.createDataFrame([(*r[:5], None, r[5]) for r in rows], kind).withColumn("published_at", F.lit("2024-01-01").cast("timestamp")).write.parquet(path)
    out = streams.run_available(streams.feed_event_stream(streams.file_stream(spark, spark.read.parquet(path).schema, path)), "events")
    assert sorted(r.unique_key.rpartition(":")[2] for r in out.collect()) in (["a", "c", "d", "e"], ["b", "c", "d", "e"])


FORM = (
    "Official Form 201\nDistrict of Utah\nDebtor name: Acme LLC\nCity: Reno\nState: NV\nNAICS: 445110\nEstimated assets: $1,000 to $2,000\n"
    "Estimated liabilities: $3,000 or more\n10-49 creditors"
)


def test_parsed_documents_of_every_kind(spark):
    """A form, a weak form, a schedule, an empty list, a text with too many pages and one of no kind."""
    texts = {1: FORM, 2: "Official Form 201\nDebtor name: Beta Inc", 3: "Schedule E/F", 4: "List of Creditors", 5: MATRIX, 6: "hello", 7: MATRIX + "\n"}
    docs = spark.createDataFrame([(k, v, 70 + k if k != 3 else None) for k, v in texts.items()], "doc_id long, text string, filing_id long")
    table = [[["Schedule E/F: Creditors", ""], ["Creditor", "Amount"], ["Omega LLC", "$7"]]]
    tables = spark.createDataFrame([(3, table)], "doc_id long, tables array<array<array<string>>>")
    known = spark.createDataFrame([], "content_sha256 string")
    pages = spark.createDataFrame([(k, "x" * 60) for k in texts] + [(7, "x")] * 500, "doc_id long, text string")
    kind = "name string, address string, claim_amount decimal(15,2), original_name string, confidence double, source_filing_id long, is_company boolean"
    store = spark.createDataFrame([("beta tools llc", "5 Oak Ave, Troy, NY 12180", Decimal(10), None, None, 1, True)], kind)
    out = flows.parse_documents(docs, known, tables, pages, store)
    assert {r.doc_id: r.reason for r in out["reviews"].collect()} == {
        2: "city,state,court_district,industry_code,estimated_assets,estimated_liabilities,estimated_creditor_count", 4: "creditors", 6: "unknown_filing_type", 7: "too_many_pages"
    }
    assert {(r.doc_id, r.name) for r in out["creditors"].collect()} == {(3, "Omega LLC"), (5, "Acme Corporation"), (5, "Beta Tools LLC")}
    assert {r.doc_id: (r.debtor_name, r.least_creditors) for r in out["forms"].collect()} == {1: ("Acme LLC", 10), 2: ("Beta Inc", None)}
    merged = {r.name_key: (r.claim_amount, r.source_filing_id) for r in out["store"].collect()}
    assert merged == {"beta tools llc": (Decimal("15.00"), 1), "acme corporation": (Decimal("1500.00"), 75)}  # the schedule has no filing


def test_call_audit_against_brute_force(spark):
    """Ties, gaps of some hours and calls just on the limits of a minute and an hour."""
    seconds = [0, 0, 14, 15, 59, 60, 75, 3599, 3600, 3601, 7199, 7200, 20_000, 20_000, 23_600]
    rows = [(k, a, s) for a in (1, 2) for k, s in enumerate(seconds[:: a], 100 * a)]
    calls = spark.createDataFrame(rows, "call_id long, account long, s long").withColumn("called_at", F.timestamp_seconds("s")).drop("s")
    got = {r.call_id: (r.last_minute, r.last_hour, r.gap_us) for r in ranking.call_audit(calls).collect()}
    want = {}
    for k, a, s in rows:
        mine = sorted((t, i) for i, b, t in rows if b == a)
        at = mine.index((s, k))
        want[k] = (sum(s - 60 < t <= s for t, _ in mine), sum(s - 3600 < t <= s for t, _ in mine), (s - mine[at - 1][0]) * 1_000_000 if at else None)
    assert got == want


def test_deduped_store_moves_contacts_and_accounts(spark):
    creditors = spark.createDataFrame([(1, "A", None, 2), (2, "a ", "", 1), (3, "b", None, 1)], "creditor_id long, name string, address string, created_on int")
    links = spark.createDataFrame([(9, 1), (9, 2), (8, 3)], "filing_id long, creditor_id long")
    contacts = spark.createDataFrame([(1, "x"), (2, "y"), (7, "z")], "creditor_id long, full_name string")
    accounts = spark.createDataFrame([(1, 50, "one"), (2, 50, "two"), (1, 51, "one"), (3, 50, "b")], "creditor_id long, account_id long, note string")
    kept, moved, contacts, accounts = merging.dedupe_store(creditors, links, contacts, accounts)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert [r.creditor_id for r in kept.orderBy("creditor_id").collect()] == [2, 3]
    assert rows(moved) == [(8, 3), (9, 2)] and rows(contacts) == [(2, "x"), (2, "y"), (7, "z")]
    assert rows(accounts) == [(2, 50, "two"), (2, 51, "one"), (3, 50, "b")]


def test_contact_bodies_of_odd_shapes(spark):
    bodies = ['{"name":"A","score":"2"}', '{"results":[{"first_name":"B"},{"title":"x"}]}', '{"error":"e","name":"C"}', "[1]", "not json", None, "{}"]
    rows = spark.createDataFrame(list(enumerate(bodies)), "creditor_id int, body string")
    assert sorted((r.creditor_id, r.place, r.full_name, r.engagement) for r in extraction.contact_responses(rows).collect()) == [(0, 0, "A", 2.0), (1, 0, "B", 0.0)]
