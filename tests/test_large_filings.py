"""Fuzzy dedup of a filing of over 500 rows against brute force."""

import itertools

from claimforge.operators import fuzzy


def test_pairs_of_a_large_filing(spark):
    # Groups of 601 rows and of few; the rows 900 and 901 share no token and no first letters.
    keys = [(k, 1, f"creditor number n{k} of main street") for k in range(599)]
    keys += [(900, 1, "westfalenhuettenwerke"), (901, 1, "vestfalenhuettenwerke"), (902, 2, "one"), (903, 2, "one two"), (904, None, "one")]
    rows = spark.createDataFrame(keys, "row_id long, filing_id long, key string").repartition(3)
    found = [tuple(r) for r in fuzzy.candidate_pairs(rows).select("left_id", "right_id").collect()]
    large = sorted(i for i, f, _ in keys if f == 1)
    assert sorted(found) == sorted([*itertools.combinations(large, 2), (902, 903)])
    scored = {(r.left_id, r.right_id) for r in fuzzy.score_pairs(fuzzy.candidate_pairs(rows), rows).collect()}
    assert (900, 901) in scored
    text = {i: key for i, _, key in keys}
    assert scored == {(a, b) for a, b in found if fuzzy.token_set_score(text[a], text[b]) >= 85}
