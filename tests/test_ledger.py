"""The streamed ledger of misses against the batch rule, day by day, for several ways to cut the stream."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from claimforge.operators import incremental
from claimforge.session import shared_folder
from claimforge.streaming import feeds, ledger

START = datetime.date(2024, 1, 1)
DAYS = [START + datetime.timedelta(days=k) for k in range(120)]


def by_day(rows, through=DAYS, days=45):
    """Each day's misses recorded, then entries pruned that are over."""
    held = {}
    for day in through:
        for case in sorted({c for c, _, d in rows if d == day}):
            filed = min((f for c, f, d in rows if c == case and d == day and f), default=None)
            old = held.get(case, (None, 0, None))
            held[case] = (old[0] or filed, old[1] + 1, day)
        held = {c: e for c, e in held.items() if (e[0] or e[2]) >= day - datetime.timedelta(days=days)}
    return held


def some_misses():
    rng = random.Random(8)
    rows = [("end", None, DAYS[-1])]
    for k in range(25):
        filed = rng.choice([None, START + datetime.timedelta(days=rng.randrange(-60, 100))])
        rows += [(f"c{k}", rng.choice([filed, filed, None]), d) for d in rng.sample(DAYS, rng.choice([1, 2, 5])) for _ in range(rng.choice([1, 1, 2]))]
    rows += [("gap", None, DAYS[3]), ("gap", None, DAYS[50]), ("gap", None, DAYS[49]), ("kept", None, DAYS[3]), ("kept", None, DAYS[49]), ("kept", None, DAYS[80])]
    return sorted(rows, key=lambda r: r[2])


@pytest.mark.parametrize("cuts", [[], [40, 41, 90], [10, 60]])
def test_stream_against_the_batch_rule(spark, cuts):
    rows = some_misses()
    source, store = shared_folder(spark, "misses"), shared_folder(spark, "ledger")
    edges = [0, *[next(i for i, r in enumerate(rows) if r[2] >= DAYS[c]) for c in cuts], len(rows)]
    kind = "case_number string, filed date, missed date"
    for n, (a, b) in enumerate(zip(edges, edges[1:])):
        part = spark.createDataFrame(rows[a:b], kind).select("case_number", "filed", F.col("missed").cast("timestamp").alias("missed_on"))
        part.coalesce(1).write.mode("append").parquet(source)
        if n % 2 or b == len(rows):  # some batches in a run of their own, some together
            out = ledger.miss_ledger(feeds.file_stream(spark, part.schema, source, 1), store)
    got = {r.case_number: (r.filed, r.attempts, r.last_date) for r in out.collect()}
    assert got == by_day(rows) and len(got) > 5


def test_batch_operators_follow_the_same_rule(spark):
    rows = [r for r in some_misses() if r[2] < DAYS[4]]
    held = spark.createDataFrame([], "case_number string, filed date, attempts int, last_date date")
    for day in DAYS[:4]:
        misses = spark.createDataFrame([r[:2] for r in rows if r[2] == day], "case_number string, filed date")
        held = incremental.prune_ledger(incremental.record_misses(held, misses.where(F.lit(True)), str(day)), str(day))
    want = by_day(rows, DAYS[:4])
    assert {r.case_number: r.last_date for r in held.collect() if r.filed is not None} == {c: e[2] for c, e in want.items() if e[0] is not None}

