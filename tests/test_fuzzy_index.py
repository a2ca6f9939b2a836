"""The index of likely pairs and the columnar scores against the scalar definition."""

import itertools
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimforge.operators import fuzzy

KEYS = st.text(st.sampled_from("abcdeé ß中0 1"), max_size=90).map(lambda x: " ".join(x.split()))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(KEYS, KEYS), min_size=1, max_size=30))
def test_common_lengths_against_the_scalar(pairs):
    one, two = (pd.Series([p[k] for p in pairs], dtype=object) for k in (0, 1))
    assert fuzzy.common_lengths(one, two).tolist() == [fuzzy._common(a, b) for a, b in pairs]


def test_common_lengths_over_several_words():
    rng = random.Random(1)
    make = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    pairs = [(make(a), make(b)) for a in (0, 1, 63, 64, 65, 128, 129, 300) for b in (0, 1, 15, 16, 17, 64, 200)]
    got = fuzzy.common_lengths(pd.Series([a for a, _ in pairs]), pd.Series([b for _, b in pairs]))
    assert got.tolist() == [fuzzy._common(a, b) for a, b in pairs]


def test_scores_against_the_scalar(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcé中") for _ in range(rng.randrange(1, 8)))
    pool = [word() for _ in range(30)]
    keys = [" ".join(rng.choice(pool) for _ in range(rng.randrange(0, 7))) for _ in range(300)]
    rows = [(i, a, b) for i, (a, b) in enumerate(zip(keys, rng.sample(keys, len(keys))))] + [(900, None, "a"), (901, "", ""), (902, "a", "a")]
    df = spark.createDataFrame(rows, "i int, a string, b string")
    got = {r.i: r.score for r in df.select("i", fuzzy.token_set_scores("a", "b").alias("score")).collect()}
    assert got == pytest.approx({i: fuzzy.token_set_score(a or "", b or "") for i, a, b in rows}, abs=1e-9)


def misspelled(rng, text):
    at = rng.randrange(len(text))
    return text[:at] + rng.choice(["", rng.choice("abcdefghij"), text[at] + rng.choice("xyz ")]) + text[at + 1 :]


def some_keys(rng, n):
    """Names with addresses; a third are misspelled, cut or extended forms of earlier ones."""
    letters = "etaoinshrdlucmfwypvbgkjqxz"
    word = lambda: "".join(rng.choices(letters, [30 - k for k in range(26)], k=rng.randrange(3, 11)))
    pool = [word() for _ in range(1500)]
    out = []
    for _ in range(n):
        kind = rng.random()
        if out and kind < 0.33:
            text = rng.choice(out)
            for _ in range(rng.randrange(1, 5)):
                text = misspelled(rng, text) or "a"
            if kind < 0.08:
                text = " ".join(rng.sample(text.split(), max(1, len(text.split()) - 1))) if text.split() else "a"
            out.append(" ".join(text.split()) or "a")
        else:
            out.append(f"{' '.join(rng.sample(pool, rng.randrange(1, 4)))} {rng.choice(['llc', 'inc', 'corp', 'bank'])} {rng.randrange(1, 999)} {rng.choice(pool)} {rng.choice(['st', 'ave', 'rd'])} {rng.choice(pool[:40])} tx")
    return out + ["a", "b", "ab", "abc", "a b", "é", "中", "zz"]


@pytest.mark.parametrize("threshold", [85.0, 70.0])
def test_likely_pairs_lose_none(spark, threshold):
    rng = random.Random(int(threshold))
    texts = sorted(set(some_keys(rng, 700)))
    rows = [(i, i % 2, k) for i, k in enumerate(texts)]
    df = spark.createDataFrame(rows, "row_id long, filing_id int, key string").repartition(3)
    likely = {(r.left_id, r.right_id) for r in fuzzy.likely_pairs(df, threshold=threshold, small=10, most=20, block=60).collect()}
    pairs = [(a, b) for g in (0, 1) for a, b in itertools.combinations([r for r in rows if r[1] == g], 2)]
    assert likely <= {(a[0], b[0]) for a, b in pairs}
    lost = [(a[2], b[2]) for a, b in pairs if (a[0], b[0]) not in likely and fuzzy.token_set_score(a[2], b[2]) >= threshold]
    assert lost == []


def test_few_pairs_of_a_large_filing_are_examined(spark):
    """2,500 rows of one filing: all matches, from under a twentieth of the pairs."""
    texts = sorted(set(some_keys(random.Random(9), 2500)))
    n = len(texts)
    df = spark.createDataFrame([(i, 1, k) for i, k in enumerate(texts)], "row_id long, filing_id int, key string").repartition(4)
    likely = fuzzy.likely_pairs(df).cache()
    assert likely.count() < 0.05 * n * (n - 1) / 2
    got = {(r.left_id, r.right_id): r.score for r in fuzzy.score_pairs(likely, df).collect()}
    # Every pair in numpy, by blocks: what lengths of common tokens and counts of letters leave open is scored by the scalar definition.
    tokens = [set(k.split()) for k in texts]
    size = np.array([len(" ".join(sorted(t))) for t in tokens])
    letters = sorted(set("".join(texts)))
    bags = np.array([[" ".join(sorted(t)).count(c) for c in letters] for t in tokens], np.int16)
    vocabulary = {w: i for i, w in enumerate(sorted(set().union(*tokens)))}
    holds = np.zeros((n, len(vocabulary)), np.float32)
    for i, t in enumerate(tokens):
        holds[i, [vocabulary[w] for w in t]] = 1
    lengths = np.array([len(w) + 1 for w in vocabulary], np.float32)
    want = {}
    for i in range(n):
        far = np.abs(bags[i + 1 :] - bags[i]).sum(axis=1)
        common = (holds[i + 1 :] * lengths) @ holds[i]
        least = np.minimum(size[i], size[i + 1 :])
        for j in np.flatnonzero((far <= 0.15 * (size[i] + size[i + 1 :]) + 1e-6) | (common >= 0.73 * least)) + i + 1:
            if (score := fuzzy.token_set_score(texts[i], texts[j])) >= 85:
                want[i, int(j)] = score
    assert got == pytest.approx(want, abs=1e-9) and len(want) > 500


def test_equal_keys_and_frequent_tokens(spark):
    rows = [(k, 1, "acme llc 1 main st") for k in range(400)] + [(500 + k, 1, f"{chr(97 + k % 26)}{k} llc {k} main st") for k in range(300)] + [(900, 1, ""), (901, 1, ""), (902, None, "acme llc 1 main st")]
    df = spark.createDataFrame(rows, "row_id long, filing_id int, key string")
    got = {(r.left_id, r.right_id) for r in fuzzy.all_scored_pairs(df).collect()}
    text = {i: k for i, f, k in rows if f == 1}
    assert got == {(a, b) for a, b in itertools.combinations(sorted(text), 2) if fuzzy.token_set_score(text[a], text[b]) >= 85}
    pairs, members = fuzzy.scored_links(df)
    assert members.where("first_id = 0").count() == 400 and pairs.where(F.col("left_id") < 400).select("left_id").distinct().count() <= 1
