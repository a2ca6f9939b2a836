"""op13: digests, trees and proofs against a brute-force version and SQL."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from claimforge.llm import merkle

sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
lower = lambda t: None if t is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def leaf_of(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """Root, and for each node its path of (place, run)."""
    paths = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for k, p in enumerate(paths):
            run = nodes[at[k] // 16 * 16 : at[k] // 16 * 16 + 16]
            p.append((at[k] % 16, run))
            at[k] //= 16
        nodes = [sha("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
    return nodes[0], paths


def brute(rows):
    """Rows of (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append((r[0], leaf_of(r), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    climbed = {}
    for s in order:
        groups[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        climbed[s] = climb([x[1] for x in groups[s]])
    root, over = climb([climbed[s][0] for s in order])
    out = []
    for s, top in zip(order, over):
        for (id_, leaf, r), path in zip(groups[s], climbed[s][1]):
            path = path + top
            chosen = id_ is not None and zlib.crc32(str(id_).encode()) % 5 == 0
            value = leaf_of((*r[:4], lower(r[4]))) if chosen else leaf
            for place, run in path:
                value = sha("".join([*run[:place], value, *run[place + 1 :]]))
            proof = sha("".join(d for place, run in path for i, d in enumerate(run) if i != place))
            out.append((id_, leaf, climbed[s][0], root, proof, value, value == root))
    return Counter(out)


def digests(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, path string, rank int").repartition(3)
    leaves = merkle.tampered_leaves(docs, "doc_id", ["doc_id", "source", "lang", "n_chars", "text"], "text", 5)
    made = merkle.manifest(leaves, "id", "source_key", "leaf")
    folded = merkle.fold(merkle.F.coalesce("tampered", "leaf"), merkle.F.col("path"))
    return Counter((r.id, r.leaf, r.subroot, r.root, r.proof, r.folded, r.folded == r.root) for r in made.withColumn("proof", merkle.proof_digest(merkle.F.col("path"))).withColumn("folded", folded).collect())


@pytest.mark.parametrize("levels", [1, 2])
def test_against_brute_force(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 16**levels)
    rng = random.Random(levels)
    sizes = {None: 3, "": 16, "a": 17, "B": 1, "é": 257, "hot": 700} | {f"s{i}": 2 for i in range(20)}
    ids = iter(rng.sample(range(-1000, 5000), 2000))
    rows = [(next(ids), s, rng.choice(["en", None]), rng.choice([None, 0, 77]), rng.choice([None, "", "Some TEXT é", "no capitals", "X" * 5000])) for s, n in sizes.items() for _ in range(n)]
    rows += [(None, "a", None, None, None), (None, "a", None, None, None), (8, "a", "en", 1, "Tied"), (8, "a", "en", 1, "Other"), (8, "a", "en", 1, "Tied")]
    rng.shuffle(rows)
    assert digests(spark, rows) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 16])
def test_few_rows(spark, n):
    rows = [(i, "s", "en", 1, f"Text {i}") for i in range(n)]
    assert digests(spark, rows) == (brute(rows) if rows else Counter())


def test_one_id_in_many_parts(spark):
    rows = [(7, "s", None, None, "same")] * 900 + [(8, "s", None, None, "other")]
    assert digests(spark, rows) == brute(rows)


def test_null_is_told_from_empty_and_fields_from_each_other(spark):
    rows = [(None, "1:a"), ("", "a"), ("a", ""), ("1", ":a"), ("-", None), (None, "-")]
    df = spark.createDataFrame(rows, "x string, y string").select(merkle.digest_of(merkle.F.col("x"), merkle.F.col("y")))
    assert len({r[0] for r in df.collect()}) == len(rows)


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    expected = con.sql(merkle.OP13_SQL)
    assert Counter(map(tuple, merkle.op13_merkle(spark, sf).select(expected.columns).collect())) == Counter(expected.fetchall())
