"""op11: weights, noise and ranks against a brute-force version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from claimforge.llm import resampling

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def feature_list(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(lowered)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def bucket(feature, buckets):
    return zlib.crc32(feature.encode()) % buckets


def brute(docs, target, percent=25, least=20, buckets=10_000, seed=7):
    s = Counter(bucket(f, buckets) for _, t in docs for f in feature_list(t)[1])
    t = Counter(bucket(f, buckets) for text in target for f in feature_list(text)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = lambda k: math.floor(1000 * math.log((t[k] + 1) * (n_s + buckets) / ((s[k] + 1) * (n_t + buckets))))
    rows = []
    for id_, text in docs:
        words, found = feature_list(text)
        weight = sum(gain(bucket(f, buckets)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if id_ is None else id_}".encode()).hexdigest()[:8], 16)
        rows.append((id_, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words) >= least))
    order = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = percent * len(order) // 100
    return Counter([(*r[:4], k + 1 if k < drawn else None) for k, r in enumerate(order)] + [(*r[:4], None) for r in rows if not r[4]])


def test_awkward_rows(spark, documents, awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()] + [(20 + i % 7, f"Some words {i % 3} of no great length é " * 3) for i in range(40)]
    docs = documents(rows)
    target = spark.createDataFrame([(1, "some words of one two three", 0), (2, None, 0), (3, "", 0)], "item_id long, text string, weight int")
    for percent, least in ((25, 20), (100, 0)):
        got = Counter(map(tuple, resampling.resample(docs, target, percent=percent, least_words=least, buckets=50).collect()))
        assert got == brute(rows, ["some words of one two three"], percent, least, 50)
    assert resampling.resample(docs, target.limit(0), least_words=3).count() == len(rows)
    none = resampling.resample(nothing, target)
    assert none.count() == 0 and none.columns == ["doc_id", "n_features", "weight", "score", "rank"]


@pytest.mark.parametrize("slice_bytes", [16, 1 << 20])
def test_long_texts_in_pieces(monkeypatch, slice_bytes):
    monkeypatch.setattr(resampling, "SLICE_BYTES", slice_bytes)
    rng = random.Random(3)
    for text in ["", "  ", "x" * 500, " ".join(rng.choice(["a", "Bc", "é" * 9, "w" * 70, "7"]) for _ in range(200)), "a" * 40 + " " * 40 + "b " + "c" * 90]:
        data = np.frombuffer(text.encode(), np.uint8)
        runs = list(resampling.features(data, np.array([0, len(data)]), 1000))
        words, found = feature_list(text)
        assert sum(int(w.sum()) for w, *_ in runs) == len(words)
        assert Counter(np.concatenate([b for *_, b in runs] or [[]]).tolist()) == Counter(bucket(f, 1000) for f in found)


def test_features_of_many_rows():
    texts = ["a b", "", "b", "c\tD é", "-", "z" * 65 + " y"]
    data = b"".join(t.encode() for t in texts)
    ends = np.cumsum([0, *(len(t.encode()) for t in texts)])
    ((words, row, found),) = resampling.features(np.frombuffer(data, np.uint8), ends, 997)
    assert words.tolist() == [len(feature_list(t)[0]) for t in texts]
    assert Counter(zip(row.tolist(), found.tolist())) == Counter((i, bucket(f, 997)) for i, t in enumerate(texts) for f in feature_list(t)[1])


@pytest.mark.parametrize("digit_bits", [7, 11])
def test_radix_ranks(spark, digit_bits):
    rng = random.Random(digit_bits)
    wide = [None, -(1 << 63), (1 << 63) - 1, 0, -1, 5]
    for ids in ([rng.randrange(-40, 900) for _ in range(1500)] + [None] * 3 + [7] * 5, [rng.choice(wide) for _ in range(600)], [None], []):
        rows = [(rng.choice([-9, 0, 0, 0, 12_345]), i, k) for k, i in enumerate(ids)]
        df = spark.createDataFrame(rows, "s long, id long, block long").repartition(5)
        got = resampling.radix_ranks(df, "s", "id", digit_bits).collect()
        assert sorted(r["block"] for r in got) == list(range(len(rows)))
        assert [r["rank"] for r in sorted(got, key=lambda r: (-r.s, r.id is None, r.id or 0, r["rank"]))] == list(range(1, len(rows) + 1))


def test_equal_keys_keep_their_order(spark):
    rows = spark.range(0, 2000, 1, 6).selectExpr("-(id % 2) as s", "id % 3 as key", "id as place")
    got = resampling.radix_ranks(rows, "s", "key", 4, 256).collect()
    assert [r.place for r in sorted(got, key=lambda r: r["rank"])] == sorted(range(2000), key=lambda i: (i % 2, i % 3))


def test_query_against_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    expected = Counter(con.sql(resampling.OP11_SQL).fetchall())
    got = resampling.op11_resample(spark, "/root/testdata/sf0.001")
    assert Counter(map(tuple, got.select("doc_id", "n_features", "weight", "score", "rank").collect())) == expected
