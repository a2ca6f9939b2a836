"""The maintained reports after each batch against the same reports from all rows so far."""

import random

import pytest
from pyspark.sql import functions as F

from claimforge.operators import aggregates, keyed_store
from claimforge.operators import maintained_report as kept
from claimforge.session import shared_folder

FILINGS = "filing_id long, debtor_name string, case_number string, filing_date date, state string, created_on date"
CREDITORS = (
    "creditor_id long, name string, original_name string, address string, claim_amount decimal(15,2), is_company boolean, company_id string, company_tier int, "
    "created_on date, source_filing_id long"
)
JOBS = "job_id long, filing_id long, job_type string, status string, created_at timestamp"
IDS = "creditor_id long"
SCHEMAS = {"filings": FILINGS, "creditors": CREDITORS, "links": "filing_id long, creditor_id long", "jobs": JOBS, "synced": IDS, "contacts": IDS}


def some_changes(batches, seed=5):
    """Batches in which ties come before their filings and creditors, jobs change, days are missing and rows repeat."""
    import datetime

    rng = random.Random(seed)
    day = lambda: rng.choice([None, *(datetime.date(2024, 1, 1) + datetime.timedelta(days=k) for k in range(20))])
    out = [{t: [] for t in SCHEMAS} for _ in range(batches)]
    for f in range(30):
        row = (f, f"Debtor {f % 7}", f"24-{f}", day(), rng.choice(["TX", " ", None]), day())
        for b in {rng.randrange(batches), rng.randrange(batches)}:
            out[b]["filings"] += [row]
    for c in range(40):
        name, address = rng.choice(["Contact", f"Acme {c} LLC", f"Acme {c} LLC"]), rng.choice([None, "1 Main St, Reno, NV 89501", "Dayton, OH"])
        row = (c, name, None, address, None, rng.choice([True, True, False, None]), rng.choice([None, f"z{c}"]), rng.choice([None, 1, 3]), day(), rng.choice([None, rng.randrange(33)]))
        out[rng.randrange(batches)]["creditors"] += [row]
    for _ in range(160):  # creditor 0 has many; some filings and creditors never come
        out[rng.randrange(batches)]["links"] += [(rng.randrange(33), rng.choice([0, rng.randrange(44)]))]
    out[0]["links"] += [(None, 1), (1, None)]
    for j in range(50):
        filing, kind = rng.randrange(33), rng.choice(["company_lookup", "company_lookup", "docket_poll"])
        for step, b in enumerate(sorted(rng.sample(range(batches), min(batches, rng.choice([1, 2, 3]))))):
            out[b]["jobs"] += [(j, filing, kind, rng.choice(["queued", "running", "failed", "completed"]), datetime.datetime(2024, 1, 1 + step))]
    for t in ("synced", "contacts"):
        for _ in range(6):
            out[rng.randrange(batches)][t] += [(rng.randrange(44),)]
    return out


def frames(spark, batch):
    return {t: spark.createDataFrame(rows, SCHEMAS[t]) for t, rows in batch.items() if rows}


def of_all(spark, batches, since):
    all_rows = {t: spark.createDataFrame([r for b in batches for r in b[t]], SCHEMAS[t]) for t in SCHEMAS}
    filings, creditors = all_rows["filings"].distinct(), all_rows["creditors"]
    jobs = all_rows["jobs"].groupBy("job_id", "filing_id", "job_type").agg(F.max_by("status", "created_at").alias("status"))
    links = all_rows["links"].where("filing_id IS NOT NULL AND creditor_id IS NOT NULL").distinct()
    status = aggregates.pipeline_status(creditors, links, jobs, all_rows["synced"], all_rows["contacts"])
    reports = (aggregates.report_rows, aggregates.report_flat)
    return [sorted(map(str, status.collect())), *(sorted(map(str, r(creditors, links, filings, status, since).collect())) for r in reports)]


def of_store(spark, path, since):
    dfs = (kept.status(spark, path), kept.report_rows(spark, path, since), kept.report_flat(spark, path, since))
    return [sorted(map(str, df.collect())) for df in dfs]


def test_each_of_five_batches(spark):
    path, batches = shared_folder(spark, "kept"), some_changes(5)
    assert of_store(spark, path, "2024-01-12") == [[], [], []]
    for k, batch in enumerate(batches):
        kept.apply(spark, path, k, frames(spark, batch), buckets=3)
        want = of_all(spark, batches[: k + 1], "2024-01-12")
        assert of_store(spark, path, "2024-01-12") == want
    assert all(len(w) > 5 for w in want)
    kept.apply(spark, path, 4, frames(spark, batches[4]), buckets=3)  # repeated
    kept.apply(spark, path, 7, {}, buckets=3)  # nothing new
    assert of_store(spark, path, "2024-01-12") == want
    assert of_store(spark, path, "2030-01-01")[1:] == [[], []]
    with pytest.raises(ValueError):
        kept.apply(spark, path, 6, {})


@pytest.mark.parametrize("fails_at", [0, 2, 7])
def test_stopped_at_a_note(spark, monkeypatch, fails_at):
    """The second of two batches stops where its plan or a step of a store would be noted; the next call goes on."""
    path, batches = shared_folder(spark, "kept"), some_changes(2, seed=fails_at)
    kept.apply(spark, path, 0, frames(spark, batches[0]), buckets=2)
    steps, note = [0], keyed_store.note

    def failing(*args, **settings):
        steps[0] += 1
        if steps[0] == fails_at + 1:
            raise RuntimeError("stopped")
        return note(*args, **settings)

    monkeypatch.setattr(keyed_store, "note", failing)
    with pytest.raises(RuntimeError):
        kept.apply(spark, path, 1, frames(spark, batches[1]), buckets=2)
    monkeypatch.setattr(keyed_store, "note", note)
    kept.apply(spark, path, 1, frames(spark, batches[1]), buckets=2)
    assert of_store(spark, path, "2024-01-12") == of_all(spark, batches, "2024-01-12")


def test_stream_of_changes(spark):
    """Files of changes followed in two runs; a report's plan reads no folder of months before the window."""
    source, path, batches = shared_folder(spark, "changes"), shared_folder(spark, "kept"), some_changes(2, seed=9)
    schema = spark.createDataFrame([], ", ".join(f"{t} struct<{s}>" for t, s in SCHEMAS.items())).schema
    for batch in batches:
        rows = [tuple(r if t == u else None for u in SCHEMAS) for t in SCHEMAS for r in batch[t]]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        kept.follow(spark.readStream.schema(schema).parquet(source), path, buckets=2)
    assert of_store(spark, path, "2024-01-12") == of_all(spark, batches, "2024-01-12")
    plan = kept.report_rows(spark, path, "2024-01-12")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "PushedFilters: [IsNotNull(entered), GreaterThanOrEqual(entered" in plan and "/ties" not in plan


def test_a_batch_leaves_earlier_rows_alone(spark):
    """Files of filings, ties and entries of earlier batches stay as they are, and each row of them is stored once outside the plans."""
    from pathlib import Path

    path, batches = shared_folder(spark, "kept"), some_changes(3, seed=4)
    kept.apply(spark, path, 0, frames(spark, batches[0]), buckets=2)
    files = lambda: {f: f.stat().st_mtime_ns for t in ("filings", "ties", "entries") for f in Path(path.removeprefix("file:"), t).rglob("*.parquet")}
    before = files()
    kept.apply(spark, path, 1, frames(spark, batches[1]), buckets=5)  # the first number of buckets counts
    after = files()
    assert before and all(after.get(f) == at for f, at in before.items())
    assert {p.name for p in Path(path.removeprefix("file:")).glob("ties/batch=*/bucket=*")} <= {"bucket=0", "bucket=1"}
    kept.apply(spark, path, 2, frames(spark, batches[2]))
    assert of_store(spark, path, "2024-01-12") == of_all(spark, batches, "2024-01-12")


def test_newest_filing_of_equal_and_missing_dates(spark):
    rows = [(1, 5, "2024-01-02"), (1, 7, "2024-01-02"), (1, 9, None), (2, -3, None), (2, -8, None), (3, 2**63 - 1, "1950-01-01"), (3, -(2**63), "1950-01-01")]
    got = kept._newest_filing(spark.createDataFrame(rows, "creditor_id long, filing_id long, created_on string").withColumn("created_on", F.to_date("created_on")))
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, got.collect())) == [(1, 7), (2, -3), (3, 2**63 - 1)]
