"""op8: cells of many short documents."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimforge.llm import jaccard_join

from .test_matching import brute_components


def sets_of(texts):
    data = "".join(texts).encode()
    return jaccard_join.shingle_sets(np.frombuffer(data, np.uint8), np.append(0, np.cumsum([len(t) for t in texts])), 4)


def test_cell_of_many_short_texts():
    # Ten words apart in the last one share six of eight shingles; with one word more each, seven of eight with their own.
    texts = [f"a b c d e f g h i w{k // 2}" + " z" * (k % 2) for k in range(20_000)]
    sets = sets_of(texts)
    tracemalloc.start()
    root = jaccard_join.roots_within(sets, 85)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert root.tolist() == [k // 2 * 2 for k in range(20_000)]
    assert peak < 500 << 20


@pytest.mark.parametrize("pairs", [1, 500, 4_000_000])
def test_roots_within_is_exact(pairs):
    rng = random.Random(7)
    for n in (1, 2, 30, 150):
        base = [[rng.choice("abcdefgh") for _ in range(rng.randint(1, 60))] for _ in range(4)]
        texts = []
        for _ in range(n):
            own = list(rng.choice(base))
            for _ in range(rng.randint(0, 2)):
                own[rng.randrange(len(own))] = rng.choice("abcdefghij")
            texts.append(" ".join(own))
        want = Counter((i, c) for i, _, c in brute_components(list(enumerate(texts))))
        assert Counter(enumerate(jaccard_join.roots_within(sets_of(texts), 85, pairs).tolist())) == want


def test_voronoi_windows_lose_no_link():
    rng = random.Random(11)
    sets = [np.unique(np.array(rng.sample(range(40), rng.randint(1, 30)), np.uint64)) for _ in range(300)]
    near = lambda a, b: 100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b))
    for limit in (None, 0.3, 0.45):
        chosen = [sets[k] for k in jaccard_join.thinned(sets[:40], 0.3, 40)]
        row, cell = jaccard_join.voronoi(jaccard_join.Pivots(chosen).distances(sets), 0.15, limit)
        of = [set(cell[row == k].tolist()) for k in range(len(sets))]
        own = [int(cell[row == k][0]) for k in range(len(sets))]
        for a in range(len(sets)):
            for b in range(a):
                if near(sets[a], sets[b]):
                    assert max(own[a], own[b]) in of[a] & of[b]


@pytest.mark.parametrize("most", [1, 50, 2_000_000])
def test_distances_to_pivots(most):
    rng = random.Random(12)
    sets = [np.unique(np.array([rng.randrange(30) for _ in range(rng.randint(0, 25))], np.uint64)) for _ in range(60)]
    got = jaccard_join.Pivots(sets[:20]).common(sets, most)
    assert got.tolist() == [[len(np.intersect1d(a, p)) for p in sets[:20]] for a in sets]


def test_every_run_has_cells_and_windows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(F.col("doc_id").alias("id"), "text")
    chosen, sizes = jaccard_join.first_pivots(docs, 4, 85, 32)
    out = jaccard_join.dealt_sets(docs, 4, 85, {}, chosen, sizes, 0.45)
    cells = out.select("id", F.posexplode("cells").alias("at", "cell")).collect()
    regions = out.select("id", F.posexplode("regions").alias("at", "region")).collect()
    assert len({r.cell for r in cells}) > 20 and len({r.region for r in regions}) > 2
    assert any(r.at for r in regions)
    # Who has no cell lies in the far region, and some lie in both.
    assert {r.id for r in cells} | {r.id for r in regions} == {r.id for r in out.where("n > 0").select("id").collect()}


@pytest.mark.parametrize("limits", [{"cell_docs": 100}, {"cell_docs": 40, "pivots": 3}])
def test_large_cells_are_parted(documents, monkeypatch, limits):
    rows = [(k, f"a b c d e f g h i w{k // 2}" + " z" * (k % 2)) for k in range(300)]
    rows += [(1000 + k, " ".join(f"v{j}" for j in range(60)) + f" x{k} y{k} z{k // 3}") for k in range(150)]
    asked = []
    part = jaccard_join._part
    monkeypatch.setattr(jaccard_join, "_part", lambda *a, **k: asked.append(1) or part(*a, **k))
    out = jaccard_join.jaccard_components(documents(rows), width=4, percent=85, **limits).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute_components(rows)
    assert asked


def test_dense_cells_without_a_core(documents):
    """Copies of which no two link, and some that do."""
    base = [f"v{j}" for j in range(40)]
    rows = []
    for k in range(60):
        mine = list(base)
        mine[k % 38] = f"o{k}"
        mine[(k * 7 + 5) % 38] = f"p{k}"
        rows.append((k, " ".join(mine)))
    rows += [(100, rows[5][1] + " end"), (101, rows[17][1] + " end")]
    out = jaccard_join.jaccard_components(documents(rows), width=4, percent=85, cell_docs=10, pivots=4).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute_components(rows)


def test_one_id_with_a_long_and_a_short_text(documents):
    near = " ".join(f"w{k}" for k in range(30))
    rows = [(5, " ".join(f"q{k}" for k in range(90))), (5, near), (9, near + " more")]
    out = jaccard_join.jaccard_components(documents(rows), width=4, percent=85).collect()
    assert {r.component_id for r in out} == {5}


def test_blocks_of_the_far_region_get_pivots_of_their_own(documents, monkeypatch):
    """A loose group of 80 near copies of which none is a pivot, and a chain that its own pivots part."""
    rng = random.Random(5)
    base = [f"v{j}" for j in range(70)]
    rows = []
    for k in range(80):
        mine = list(base)
        mine[rng.randrange(70)] = f"o{k}"
        rows.append((k, " ".join(mine)))
    chain = [f"c{j}" for j in range(200)]
    rows += [(200 + k, " ".join(chain[k : k + 90])) for k in range(0, 100, 2)]
    split, seen = jaccard_join._split, []
    monkeypatch.setattr(jaccard_join, "_split", lambda *a, **k: seen.append(1) or split(*a, **k))
    out = jaccard_join.jaccard_components(documents(rows), width=4, percent=85, pivots=0, part_docs=8).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute_components(rows)
    assert seen


@pytest.mark.parametrize("percent", [50, 80, 85, 100])
def test_linked_sets_share_a_part(percent):
    rng = random.Random(percent)
    sets = [np.unique(np.array(rng.sample(range(1 << 62), rng.choice([1, 2, 3, 7, 12, 30, 90])), np.uint64) * np.uint64(3)) for _ in range(60)]
    for s in list(sets):  # as far from it as a link allows, and equal in all but the high bits' even spread
        keep = max(1, -(-percent * len(s) // 100))
        sets += [s[:keep], s[-keep:], np.unique(np.append(s[: max(1, (len(s) + keep) // 2)], np.array([rng.randrange(1 << 63) for _ in range(max(0, (len(s) - keep) // 2))], np.uint64)))]
    sets += [np.arange(k, k + 40, dtype=np.uint64) for k in range(0, 12, 2)]  # all in the first part
    row, key = jaccard_join.part_keys(sets, percent, np.sort(np.concatenate(sets[:20])))
    of = [set(key[row == k].tolist()) for k in range(len(sets))]
    links = 0
    for a in range(len(sets)):
        for b in range(a):
            common = len(np.intersect1d(sets[a], sets[b]))
            if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                links += 1
                assert of[a] & of[b]
    assert links > 60 and len(key) < sum(map(len, sets)) * 2 + 4 * len(sets)


def test_crowds_that_share_shingles_are_not_one_cell(documents, monkeypatch):
    """Unlike documents, of which crowds share a phrase that is not known as common, are not compared with each other."""
    rng = random.Random(8)
    rows = []
    for k in range(240):
        own = [f"w{k}x{j}" for j in range(60)]
        for g in rng.sample(range(24), 3):  # each phrase is in some 30 documents
            at = rng.randrange(50)
            own[at : at + 4] = [f"p{g}a", f"p{g}b", f"p{g}c", f"p{g}d"]
        rows.append((k, " ".join(own)))
    rows += [(1000 + k, rows[7 * k][1] + " end") for k in range(20)]
    met = []
    join = jaccard_join._join_regions
    monkeypatch.setattr(jaccard_join, "_join_regions", lambda source, cells, *a: met.append(cells.groupBy("cell").count().agg(F.max("count")).first()[0]) or join(source, cells, *a))
    out = jaccard_join.jaccard_components(documents(rows), width=4, percent=85, pivots=0, ranked_shingles=0).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute_components(rows)
    assert met == [2]


def test_long_sets_are_told_apart_by_classes():
    rng = np.random.default_rng(3)
    some = lambda n: np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
    for n in (40, 1_000, 1_025, 4_000, 20_000):
        s = some(n)
        sets = [s, s[: -(-85 * len(s) // 100)], np.append(s[len(s) // 12 :], some(len(s) // 14)), some(n), some(n * 9 // 10)]
        sets.append(np.arange(n, dtype=np.uint64))  # all in one class
        counts = [jaccard_join.class_counts(x) for x in sets]
        for a, x in enumerate(sets):
            far = jaccard_join.class_distances([counts[a]] * len(sets), counts)
            for b, y in enumerate(sets):
                assert far[b] <= len(np.setxor1d(x, y))
                if a != b and n > 100 and max(a, b) > 2:  # unlike sets can't link
                    assert 185 * far[b] > 15 * (len(x) + len(y))
    assert jaccard_join.class_distances([], []).tolist() == []
