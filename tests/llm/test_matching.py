"""op4, op8, op10 and the pipeline against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from claimforge.llm import decontaminate, exact_dedup, jaccard_join

from .conftest import AWKWARD

WHITE = re.compile(r"[\x20\x09-\x0D]")


def brute_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[WHITE.sub("", t or "")].append((-len(t or ""), i is None, i or 0))
    out = Counter()
    for norm, members in groups.items():
        best = min(members)
        for k, m in enumerate(sorted(members)):
            ident = lambda x: None if x[1] else x[2]
            out[ident(m), ident(best), len(members), k == 0, hashlib.sha256(norm.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("budget", [1, 48 << 20])
def test_exact(documents, budget):
    rng = random.Random(3)
    rows = AWKWARD + [(100 + i, rng.choice(["same text", "same  text ", "other", f"own {i}"])) for i in range(200)]
    out = exact_dedup.exact_duplicates(documents(rows), task_budget=budget).collect()
    assert Counter(tuple(r) for r in out) == brute_exact(rows)


def test_exact_of_nothing(nothing):
    assert exact_dedup.exact_duplicates(nothing).count() == 0


def test_grace_compares_contents():
    records = [(b"\0" * 32, c, (k,)) for k, c in enumerate([b"a", b"b", b"a", b"c"])]  # one digest for all
    for budget in (1, 1 << 20):
        groups = {c: [m[0] for m in members] for _, c, members in exact_dedup.grace_groups(iter(records), budget)}
        assert groups == {b"a": [0, 2], b"b": [1], b"c": [3]}


def shingles(text, width=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(zip(*(words[k:] for k in range(width)))) if len(words) >= width else frozenset([tuple(words)])


def brute_components(rows, width=4, percent=85):
    sets = [(i, shingles(t, width)) for i, t in rows]
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, u in sets[:a]:
            if s and u and None not in (i, j) and 100 * len(s & u) >= percent * len(s | u):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return Counter((i, len(s), None if i is None else find(i)) for i, s in sets)


def near_rows():
    rng = random.Random(5)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmnop")
    rows = list(AWKWARD)
    for g in range(12):
        base = [word() for _ in range(rng.choice([3, 8, 40, 90]))]
        for k in range(rng.choice([1, 2, 12])):
            mine = list(base)
            for _ in range(rng.randint(0, 3)):
                mine[rng.randrange(len(mine))] = word()
            rows.append((1000 + 50 * g + k, " ".join(mine)))
    return rows


@pytest.mark.parametrize("limits", [{}, {"cell_shingles": 150, "small_region": 2, "ranked_shingles": 3, "broadcast_rows": 0}, {"cell_docs": 3, "pivots": 2}, {"pivots": 0}])
def test_near(documents, limits):
    rows = near_rows()
    out = jaccard_join.jaccard_components(documents(rows), width=4, percent=85, **limits).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute_components(rows)


def test_near_ties_texts_of_one_id(documents):
    a, b = "a b c d e f g h", "p q r s t u v w"
    rows = [(1, a), (2, a), (2, b), (3, b)]
    assert {r.component_id for r in jaccard_join.jaccard_components(documents(rows)).collect()} == {1}


def test_near_of_nothing(nothing):
    assert jaccard_join.jaccard_components(nothing).count() == 0


def test_cells_that_pivots_do_not_split(spark, documents):
    rows = [(i, f"x{i} " + " ".join(f"w{k}" for k in range(30))) for i in range(40)]
    out = jaccard_join.jaccard_components(documents(rows), cell_shingles=200)
    assert {r.component_id for r in out.collect()} == {0}


def items(spark, rows):
    return spark.createDataFrame([(i, t, "extra") for i, t in rows], "item_id long, text string, words string")


BENCH = [(1, "A b c d e f g h i j k l"), (2, "one, TWO three"), (3, None), (4, ""), (5, "x y z"), (6, "a b c d e f g h i j k l"), (None, "no id here")]


@pytest.mark.parametrize("limits", [{}, {"literal_fingerprints": 0, "broadcast_bytes": 0}, {"k": 10}, {"k": 1}])
def test_contamination(spark, documents, limits):
    rng = random.Random(9)
    rows = AWKWARD + [(200 + k, " ".join(rng.choice("a b c d e f g h i j k l m") for _ in range(rng.randint(0, 60)))) for k in range(60)]
    rows += [(300, "zz a-b-c d e f g h i j zz"), (301, "b c d e f g h i j"), (302, "É b c d e f g h i j"), (303, "one two.three one two")]
    docs, bench = documents(rows), items(spark, BENCH)
    got = Counter(tuple(r)[:6] for r in decontaminate.contamination(docs, bench, **limits).collect())
    con = duckdb.connect()
    con.register("d0", docs.select("doc_id", "text").toPandas().astype({"doc_id": "Int64"}))
    con.register("b0", bench.where("item_id IS NOT NULL").select("item_id", "text").toPandas())
    con.sql("CREATE TABLE documents AS SELECT CAST(doc_id AS BIGINT) AS doc_id, text FROM d0")
    con.sql("CREATE TABLE benchmark AS SELECT CAST(item_id AS BIGINT) AS item_id, text FROM b0")
    assert got == Counter(con.sql(decontaminate.OP10_SQL).fetchall())
    assert got[303, 5, 3, 1, hashlib.sha256(b"2").hexdigest(), True] == 1


def test_contamination_of_and_by_nothing(spark, nothing, awkward):
    assert decontaminate.contamination(nothing, items(spark, BENCH)).count() == 0
    assert decontaminate.contamination(awkward, items(spark, [])).where("contaminated").count() == 0


def test_main_path_is_native(spark, awkward):
    plan = decontaminate.contamination(awkward, items(spark, BENCH))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ten_words(text):
    words = plain_words(text)
    return [tuple(words[k : k + 10]) for k in range(max(1, len(words) - 9))] if words else []


def has(words, window):
    return any(tuple(words[k : k + len(window)]) == window for k in range(len(words)))


@pytest.mark.parametrize("width, percent", [(5, 80), (3, 60), (1, 100)])
def test_near_at_other_thresholds(documents, width, percent):
    rows = near_rows()
    out = jaccard_join.jaccard_components(documents(rows), width=width, percent=percent, pivots=8).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute_components(rows, width, percent)


def test_pipeline(spark, tmp_path, documents):
    rows = near_rows() + [(900, "zz a b c d e f g h i j zz"), (901, "123"), (902, "clean text that stays as it is")]
    data = [(i, t, "en", "s", None) for i, t in rows]
    documents(rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    items(spark, BENCH).write.parquet(f"{tmp_path}/benchmark.parquet")
    got = Counter((r.doc_id, r.decoded_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    left = [(i, t) for i, t, *_ in data if t and re.search(r"[^\W\d_]", t)]
    by_text = defaultdict(list)
    for i, t in left:
        by_text[WHITE.sub("", t)].append((-len(t), i is None, i or 0, t))
    left = [(None if m[1] else m[2], m[3]) for m in map(min, by_text.values())]
    comp = {i: c for i, _, c in brute_components(left, 5, 80)}
    left = [(i, t) for i, t in left if i is None or comp[i] == i]
    windows = {w for i, t in BENCH if i is not None for w in ten_words(t)}
    held = {i for i, t in left if any(has(plain_words(t), w) for w in windows)}
    left = [(i, t) for i, t in left if i not in held]
    assert got == Counter((i, hashlib.sha256(t.encode()).hexdigest()) for i, t in left)
    assert 902 in {i for i, _ in got} and not {900, 901} & {i for i, _ in got}


def test_stage_columns(spark, documents):
    docs = documents([(1, "some words here"), (1, "some words here"), (2, None)]).select(corpus_pipeline.COLUMNS)
    for _, stage in corpus_pipeline.STAGES[:2]:
        docs = stage(spark, docs, "")
        assert docs.columns == corpus_pipeline.COLUMNS
    assert docs.agg(F.count("*")).first()[0] == 1


def test_near_copies_of_repeated_ids(spark, documents):
    """A text goes for its own links only, not for those of another text of its id."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(3, a), (5, a + " end"), (5, b), (5, c + " more"), (2, c), (None, a + " last"), (None, "of its own and nothing else"), (9, None)]
    got = corpus_pipeline.near_duplicates(spark, documents(rows), "")
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter([(3, a), (5, b), (2, c), (None, "of its own and nothing else"), (9, None)])
