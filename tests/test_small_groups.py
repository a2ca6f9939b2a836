"""Groups that are solved where their rows meet, against the scalar definition and against the way of large groups."""

import itertools
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from claimforge.operators import fuzzy
from tests.test_fuzzy_index import some_keys


def _keys():
    rng = random.Random(4)
    long = [" ".join(f"word{rng.randrange(30)}" for _ in range(14)) for _ in range(12)]
    return [*some_keys(rng, 150), "", "", "a b", "b a", "中" * 64, "中" * 63 + "é", *long]


@pytest.mark.parametrize("sort", [lambda k: True, lambda k: len(k) <= 64, lambda k: len(k) > 60])
def test_links_of_lists_against_the_scalar(sort):
    keys = [k for k in _keys() if sort(k)]
    lists = [keys[at : at + n] for at, n in ((0, 0), (0, 1), (0, 40), (40, 60), (100, 80))]
    texts = [[" ".join(sorted(set(k.split()))) for k in x] for x in lists]
    flat = [k for x in texts for k in x]
    group = [g for g, x in enumerate(texts) for _ in x]
    pairs = [(i, j) for i, j in itertools.combinations(range(len(flat)), 2) if group[i] == group[j]]
    for at_once in (50, 200_000):
        got = {(int(i), int(j)): s for a, b, c in fuzzy._group_links(pa.array(texts, pa.list_(pa.string())), False, 70.0, at_once) for i, j, s in zip(a, b, c)}
        want = {(i, j): fuzzy.token_set_score(flat[i], flat[j]) for i, j in pairs}
        assert got == pytest.approx({k: v for k, v in want.items() if v >= 70}, abs=1e-9)
    share = lambda a, b: len(a & b) / max(len(a | b), 1)
    got = {(int(i), int(j)) for a, b, _ in fuzzy._group_links(pa.array(texts, pa.list_(pa.string())), True, 0.4) for i, j in zip(a, b)}
    assert got == {(i, j) for i, j in pairs if share(set(flat[i].split()), set(flat[j].split())) >= 0.4}


def test_small_and_large_groups_agree(spark):
    keys = _keys()
    rows = [(1000 - i, None if i % 9 == 0 else i % 4, k, "x", i, 0.5, i) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "row_id long, filing_id int, name string, address string, claim_amount int, confidence double, line_number int").repartition(3)
    df = df.withColumn("claim_amount", F.col("claim_amount").cast("decimal(15,2)"))
    shown = lambda x: sorted(map(repr, x.collect()))
    assert shown(fuzzy.deduplicate(df)) == shown(fuzzy.deduplicate(df, small=1))
    keyed = fuzzy.keyed(df)
    assert shown(fuzzy.all_scored_pairs(keyed).select("left_id", "right_id", F.round("score", 9))) == shown(fuzzy.all_scored_pairs(keyed, small=1).select("left_id", "right_id", F.round("score", 9)))
    assert shown(fuzzy.jaccard_pairs(keyed, threshold=0.6).where("left_id < right_id")) == shown(fuzzy.jaccard_pairs(keyed, threshold=0.6, small=1))
    assert shown(fuzzy.jaccard_clusters(keyed).select("row_id", "cluster_id")) == shown(fuzzy.jaccard_clusters(keyed, small=1).select("row_id", "cluster_id"))


def test_pairs_of_small_groups_are_not_shuffled(spark):
    """Rows are dealt by group once, and merged rows by cluster; no join by a row's identity."""
    rows = spark.range(1000).selectExpr("id AS row_id", "id DIV 10 AS filing_id", "concat('acme ', id % 7) AS name", "'x' AS address", "1.0BD AS claim_amount", "0.5D AS confidence", "1 AS line_number")
    for out in (fuzzy.deduplicate(rows), fuzzy.all_scored_pairs(fuzzy.keyed(rows)), fuzzy.jaccard_clusters(fuzzy.keyed(rows)), fuzzy.jaccard_pairs(fuzzy.keyed(rows))):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") <= 2 and "Join" not in plan
