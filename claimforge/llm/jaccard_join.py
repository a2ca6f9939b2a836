"""Exact n-gram Jaccard self-join as a metric-space join.

Jaccard distance is a metric, so two sets within ``radius`` of each other obey the
triangle inequality around any pivot. Every run goes through these regions:

1. A bounded sample of documents, thinned until no two are within twice the radius,
   are the first pivots. Each set within ``near`` of a pivot belongs to the Voronoi
   cell of its nearest one; the others form the far region.
2. A set also enters the cell of each later pivot that is at most twice the radius
   farther than its own, and the far region if it is more than ``near - radius`` from
   its pivot. So two linked sets meet in the later one of their two cells.
3. The far region is parted by a second metric, the difference of the logarithms of
   set sizes, which is at most ``-log(threshold)`` for linked sets: Voronoi cells of
   sampled sizes, with windows by the same rule.
4. In a far cell all distances to pivots are nearly 1, where no triangle inequality
   parts anything. There, sets that can link share one of their first ranked shingles,
   distances to 64 or more fixed pivots (the classes of shingles by hash, more of them for
   larger sets) drop pairs, and
   what is left joins sets into sub-cells that no link crosses. Sets that meet only in
   crowds, as many share one of their first shingles, meet again by parts: the shingles
   are parted by hash into more parts than two linked sets can differ in.
5. A cell too large for a task, by shingles or by documents, gets pivots of its own
   and is parted again by rules 1 and 2. One that pivots don't part is dense: all sets
   that link with one pivot are one component already, and only the other sets are
   compared, with each other and with those, in slices.

Cells are joined exactly, and their results meet in connected components. Shingles are
compared by 64-bit hashes of their words.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimforge.llm import arrow
from claimforge.llm.pretokens import mix, span_hashes
from claimforge.llm.sampling import at_least, sample_ids
from claimforge.operators.components import connected_components
from claimforge.session import materialize

CLASSES = 64
_K = np.uint64(0xD6E8FEB86659FD93)
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
# What separates words.
_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def shingle_sets(data: np.ndarray, ends: np.ndarray, width: int) -> list[np.ndarray]:
    """Each text's distinct word shingles as sorted 64-bit hashes."""
    folded = _FOLD[data]
    blank = _BLANK[data]
    new = np.zeros(len(data) + 1, bool)
    new[ends[:-1]] = True
    solid = ~blank
    first = np.flatnonzero(solid & (new[:-1] | np.append(True, blank[:-1]))) if len(data) else np.zeros(0, np.int64)
    stop = np.flatnonzero(solid & (new[1:] | np.append(blank[1:], True))) + 1 if len(data) else first
    words = span_hashes(folded, first, stop)
    of = np.searchsorted(first, ends)
    runs = words
    for j in range(1, width):
        runs = mix(runs[: max(0, len(words) - j)] * _K + words[j:])
    out = []
    for a, b in zip(of[:-1].tolist(), of[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(runs[a : b - width + 1]))
        elif b > a:  # the whole sequence, apart from shingles of full width
            whole = words[a : a + 1]
            for j in range(a + 1, b):
                whole = mix(whole * _K + words[j : j + 1])
            out.append(mix(whole ^ np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _sets_of(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    for a, _, data, ends in arrow.slices(column, 1 << 20):
        for k, s in enumerate(shingle_sets(data, ends, width)):
            yield a + k, s


def _first_ranked(n: int, percent: int) -> int:
    """How many first shingles two sets at the threshold must share one of."""
    return n - -(-percent * n // 100) + 1 if n else 0


def linked(common: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    return 100 * common >= percent * (n + m - common)


class Pivots:
    """Pivot sets by shingle, to take what many sets have in common with each of them."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(p) for p in sets], np.int64)
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        self.kinds, kind = np.unique(flat, return_inverse=True)
        self.owner = np.repeat(np.arange(len(sets)), self.size)[np.argsort(kind, kind="stable")]
        self.start = np.append(0, np.cumsum(np.bincount(kind, minlength=len(self.kinds))))

    def common(self, sets: list[np.ndarray], most: int = 2_000_000) -> np.ndarray:
        """Sizes of intersections, sets by pivots. ``most`` bounds what is counted at a time."""
        k = len(self.size)
        out = np.zeros(len(sets) * k, np.int64)
        if not k or not sets:
            return out.reshape(len(sets), k)
        flat = np.concatenate(sets)
        row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        at = np.minimum(np.searchsorted(self.kinds, flat), len(self.kinds) - 1)
        hit = self.kinds[at] == flat
        row, at = row[hit], at[hit]
        times = self.start[at + 1] - self.start[at]
        done = np.cumsum(times)
        a = 0
        while a < len(at):
            b = max(a + 1, int(np.searchsorted(done, (done[a - 1] if a else 0) + most, "right")))
            n = times[a:b]
            pick = np.repeat(self.start[at[a:b]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            out += np.bincount(np.repeat(row[a:b], n) * k + self.owner[pick], minlength=len(out))
            a = b
        return out.reshape(len(sets), k)

    def distances(self, sets: list[np.ndarray]) -> np.ndarray:
        common = self.common(sets)
        n = np.array([len(x) for x in sets], np.int64)[:, None]
        return 1 - common / np.maximum(n + self.size - common, 1)


def thinned(sets: list[np.ndarray], apart: float, most: int) -> list[int]:
    """Places of up to ``most`` sets, each farther than ``apart`` from those before it."""
    d = Pivots(sets).distances(sets)
    kept: list[int] = []
    for k in range(len(sets)):
        if len(kept) < most and (d[k, kept] > apart).all():
            kept.append(k)
    return kept


def voronoi(distance: np.ndarray, radius: float, near: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Cells of each row of a matrix of distances to pivots: ``row, cell``, a row's own cell first.

    A row belongs to its nearest pivot, or to a far cell (numbered last) beyond ``near``. It
    enters later cells where the triangle inequality allows a partner within ``radius``.
    """
    m, k = distance.shape
    if not k:
        return np.arange(m), np.zeros(m, np.int64)
    own, least = distance.argmin(axis=1), distance.min(axis=1)
    window = (distance <= least[:, None] + 2 * radius + 1e-9) & (np.arange(k) >= own[:, None])
    if near is not None:
        window &= (least <= near)[:, None]
        window = np.column_stack([window, least > near - radius - 1e-9])
    return np.nonzero(window)


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 80,
    ranked_shingles: int = 50_000,
    small_region: int = 16,
    pivots: int = 256,
    near: float = 0.45,
    cell_shingles: int = 2_000_000,
    cell_docs: int = 2_000,
    part_docs: int = 2_000,
    broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """Per row ``n_shingles`` and ``component_id``: the least id reachable over links, its own included.

    Documents link when their sets' Jaccard similarity is at least ``percent`` / 100.
    Null and empty texts have no shingles and no links; their component is their own
    id. Rows that repeat an id count as one document with the links of each, rows with a null id
    have a null component and link nothing, other columns are ignored. Which documents are
    pivots (at most ``pivots``, of a sample of twice as many), which are ``near`` them, and how
    many of the commonest shingles are known (``ranked_shingles``) changes no result, nor does it from
    how many sets on (``part_docs``) a cell or block of the far region gets pivots of its own.
    """
    source = arrow.in_small_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    common = _common_shingles(source, width, percent, ranked_shingles)
    chosen, sizes = first_pivots(source, width, percent, pivots)
    sets = materialize(dealt_sets(source, width, percent, common, chosen, sizes, near), "sets")
    able = sets.where("n > 0 AND id IS NOT NULL")
    same = materialize(able.groupBy("print").agg(F.min("id").alias("rep")), "prints")
    reps = able.join(same.select("print", F.col("rep").alias("id")), ["print", "id"], "left_semi")
    pairs = materialize(_candidates(_first_rows(reps), percent, small_region), "pairs")
    crowded = materialize(pairs.where("sure").select(F.explode(F.array("u", "v")).alias("id")).distinct(), "crowded")
    parts = _part_rows(source, crowded, width, percent, common, broadcast_rows)
    pairs = pairs.where(~F.col("sure")).union(materialize(_candidates(parts, percent, small_region), "parts"))
    blocks = connected_components(materialize(_near(pairs, reps, percent), "near"))
    blocks = blocks.select(F.col("node").alias("id"), F.concat(F.lit("far/"), "component").alias("cell"))
    cells = reps.select("id", F.explode("cells").alias("k")).select("id", F.col("k").cast("string").alias("cell"))
    cells = materialize(cells.union(blocks).distinct(), "cells")
    links = _join_regions(source, cells, reps, width, percent, cell_shingles, cell_docs, min(part_docs, cell_docs), near, broadcast_rows)
    roots = materialize(connected_components(links), "roots")
    least = (
        same.join(roots, F.col("rep") == F.col("node"), "left")
        .select("print", F.coalesce("component", "rep").alias("component_id"))
    )
    joined = able.select("id", "n", "print").join(least, "print").select("id", "n", "component_id")
    rest = sets.where("n = 0 OR id IS NULL").select("id", "n", F.col("id").alias("component_id"))
    out = joined.union(rest)
    twice = materialize(able.groupBy("id").agg(F.countDistinct("print").alias("k")).where("k > 1").select("id"), "twice")
    if not twice.isEmpty():  # an id with several texts ties their components together
        out = materialize(out, "by-row")
        tied = out.join(twice, "id", "left_semi").where("n > 0").select(F.col("id"), "component_id")
        least = connected_components(tied, "id", "component_id").withColumnRenamed("component", "tied")
        out = (
            out.join(least, F.when(F.col("n") > 0, F.col("component_id")) == F.col("node"), "left")
            .select("id", "n", F.coalesce("tied", "component_id").alias("component_id"))
        )
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def first_pivots(source: DataFrame, width: int, percent: int, most: int, longest: int = 16_384) -> tuple[list[np.ndarray], np.ndarray]:
    """Pivot sets for the first cells, and logarithms of sizes for those of the far region.

    From ``2 * most`` documents of least id hash; a set of more than ``longest`` shingles gives
    only its size, so the driver holds a bounded number of bytes.
    """
    ids = sample_ids(source, "id", 2 * most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s for _, s in _sets_of(batch.column(1), width)]
            raw = [s.tobytes() if len(s) <= longest else None for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(raw, pa.binary())], ["id", "n", "set"])

    rows = source.where(F.col("id").isin(ids)).mapInArrow(run, "id long, n long, set binary").where("n > 0")
    found = rows.dropDuplicates(["id"]).orderBy("id").limit(2 * most).collect()
    radius = 1 - percent / 100
    sets = list({bytes(r.set): np.frombuffer(bytes(r.set), np.uint64) for r in found if r.set is not None}.values())
    chosen = [sets[k] for k in thinned(sets, 2 * radius, most)]
    sizes: list[float] = []
    for size in sorted({float(np.log(r.n)) for r in found}):
        if not sizes or size - sizes[-1] >= np.log(4):
            sizes.append(size)
    return chosen, np.array(sizes)


def _common_shingles(source: DataFrame, width: int, percent: int, most: int) -> dict[int, int]:
    """Document counts, over all documents, of up to ``most`` of the commonest shingles among the first by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            firsts = [s[: _first_ranked(len(s), percent)] for _, s in _sets_of(batch.column(0), width)]
            kinds, n = np.unique(np.concatenate(firsts) if firsts else np.zeros(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(n.astype(np.int64))], ["s", "n"])

    counts = source.select("text").mapInArrow(run, "s long, n long").groupBy("s").agg(F.sum("n").alias("n"))
    often = materialize(counts.where("n >= 8"), "common")
    top = often.where(F.col("n") >= at_least(often, "n", 8, most)).collect()
    return {r.s & 0xFFFFFFFFFFFFFFFF: r.n for r in top}


def dealt_sets(
    source: DataFrame, width: int, percent: int, common: dict[int, int], chosen: list[np.ndarray], sizes: np.ndarray, near: float
) -> DataFrame:
    """Per row: id, set size, a print of the set, its Voronoi cells, own first, and its cells in the far region.

    Sets in the far region have their first shingles by (count, hash) and counts by class as well.
    """
    keys = np.array(sorted(common), np.uint64)
    counts = np.array([common[k] for k in keys.tolist()], np.int64)
    shared = source.sparkSession.sparkContext.broadcast((keys, counts, chosen))
    radius, ratio = 1 - percent / 100, -np.log(percent / 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, chosen = shared.value
        pivots, k = Pivots(chosen), len(chosen)
        for batch in batches:
            for a, b, data, ends in arrow.slices(batch.column(1), 1 << 20):
                sets = shingle_sets(data, ends, width)
                n = np.array([len(s) for s in sets], np.int64)
                row, cell = voronoi(pivots.distances(sets), radius, near)
                is_far = np.isin(np.arange(len(sets)), row[cell == k]) & (n > 0)
                row, cell = row[cell < k], cell[cell < k]
                apart = np.abs(np.log(np.maximum(n, 1))[:, None] - sizes)
                by_size, region = voronoi(apart, ratio)
                by_size, region = by_size[is_far[by_size]], region[is_far[by_size]]
                prints, first, classes = [], [], []
                for s, ranked in zip(sets, is_far.tolist()):
                    prints.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    classes.append(class_counts(s) if ranked else b"")
                    if ranked and len(keys):
                        at = np.minimum(np.searchsorted(keys, s), len(keys) - 1)
                        rank = np.where(keys[at] == s, counts[at], 0)
                        s = s[np.argsort(rank, kind="stable")] if rank.any() else s
                    first.append(s[: _first_ranked(len(s), percent) if ranked else 0].view(np.int64))
                lists = [_lists(row, cell, len(sets), pa.int32()), _lists(by_size, region, len(sets), pa.int32())]
                owner = np.repeat(np.arange(len(sets)), [len(f) for f in first])
                lists.append(_lists(owner, np.concatenate(first), len(sets), pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n), pa.array(prints, pa.binary()), *lists, pa.array(classes, pa.binary())],
                    ["id", "n", "print", "cells", "regions", "first", "classes"],
                )

    kinds = "id long, n long, print binary, cells array<int>, regions array<int>, first array<long>, classes binary"
    return source.mapInArrow(run, kinds)


def class_counts(s: np.ndarray) -> bytes:
    """How many shingles of a set are in each class by hash: ``CLASSES``, doubled until a class has at most 16 on average."""
    bits = CLASSES.bit_length() - 1 + max(0, (len(s) - 1) // (16 * CLASSES)).bit_length()
    by = np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(by, 255).astype(np.uint8).tobytes()


def class_distances(x: list[bytes], y: list[bytes]) -> np.ndarray:
    """For pairs of sets by their ``class_counts``: in how many shingles they differ at least, by the classes of the smaller set."""
    out = np.zeros(len(x), np.int64)
    kinds = np.array([(len(a), len(b)) for a, b in zip(x, y)], np.int64).reshape(-1, 2)
    for kind in np.unique(kinds, axis=0):
        at = np.flatnonzero((kinds == kind).all(axis=1))
        # What was cut at 255 is 255 or more as a sum, and is cut there again.
        fewest = int(kind.min())
        p, q = (
            np.minimum(np.frombuffer(b"".join(c[k] for k in at.tolist()), np.uint8).reshape(len(at), fewest, -1).sum(axis=2, dtype=np.int64), 255)
            for c in (x, y)
        )
        out[at] = np.abs(p - q).sum(axis=1)
    return out


def _lists(row: np.ndarray, value: np.ndarray, n: int, kind: pa.DataType) -> pa.ListArray:
    """One list per row out of values in the order of their rows."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32()), pa.array(value, kind))


def _first_rows(reps: DataFrame) -> DataFrame:
    """``s, id, n, at``: a row for each first shingle of a set, in each of its cells of the far region."""
    return (
        reps.select("id", F.col("n").cast("int").alias("n"), "first", F.explode("regions").alias("region"))
        .select("id", "n", "region", F.posexplode("first").alias("at", "s"))
        .select(F.col("s").bitwiseXOR(F.xxhash64("region")).alias("s"), "id", "n", "at")
    )


@functools.lru_cache(maxsize=8)
def _size_cells(percent: int, longest: int) -> np.ndarray:
    """Least sizes of consecutive size cells, beyond ``longest``: linked sets lie in the same cell or in neighbouring ones."""
    least = [1]
    while len(least) < 3 or least[-3] <= longest:
        least.append(100 * least[-1] // percent + 1)
    return np.array(least, np.int64)


def part_keys(sets: list[np.ndarray], percent: int, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of which two linked sets share at least one: ``row, key``.

    A set is in its own cell of sizes and in the next one. Linked sets of a cell differ in at most ``apart`` shingles,
    so in at most that many parts; of the others the first one, in an order that depends on a part's own
    shingles only, is among the first ``apart + 1`` of either set. Parts of many shingles that are
    not ``common`` come first. A set with no more than ``apart`` parts that hold
    any gives a key for that as well, and two such sets meet by it.
    """
    size = np.array([len(s) for s in sets], np.int64)
    if not size.any():
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    rare = np.ones(len(flat), np.int64)
    if len(common):
        rare[common[np.minimum(np.searchsorted(common, flat), len(common) - 1)] == flat] = 0
    least = _size_cells(percent, 1 << int(size.max()).bit_length())
    rows, keys = [], []
    own = np.maximum(np.searchsorted(least, size, "right") - 1, 0)
    for cell in (own, own + 1):
        apart = 2 * (least[cell + 1] - 1) * (100 - percent) // (100 + percent)
        parts = apart + apart // 2 + 2
        part = ((flat >> np.uint64(32)) * parts[owner].astype(np.uint64)) >> np.uint64(32)
        begin = np.flatnonzero(np.append(True, (part[1:] != part[:-1]) | (owner[1:] != owner[:-1])))
        of = owner[begin]
        name = (cell[of].astype(np.uint64) << np.uint64(32)) | part[begin]
        key = mix(np.add.reduceat(flat, begin) ^ mix((name + np.uint64(1)) * _K))
        order = np.lexsort((key, -np.add.reduceat(rare, begin), of))
        place = np.arange(len(of)) - np.searchsorted(of, of)
        taken = place <= apart[of]
        rows.append(of[taken])
        keys.append(key[order][taken])
        full = np.bincount(of, minlength=len(sets))
        thin = np.flatnonzero((full > 0) & (full <= apart))
        rows.append(thin)
        keys.append(mix((cell[thin].astype(np.uint64) + np.uint64(1)) * _K))
    return np.concatenate(rows), np.concatenate(keys)


def _part_rows(source: DataFrame, crowded: DataFrame, width: int, percent: int, common: dict[int, int], broadcast_rows: int) -> DataFrame:
    """``s, id, n, at``, as of first shingles: a row for each of the ``part_keys`` of the documents ``crowded (id)``."""
    shared = source.sparkSession.sparkContext.broadcast(np.array(sorted(common), np.uint64))
    if crowded.count() <= broadcast_rows:
        crowded = F.broadcast(crowded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0))
            for a, _, data, ends in arrow.slices(batch.column(1), 1 << 20):
                sets = shingle_sets(data, ends, width)
                size = np.array([len(s) for s in sets], np.int32)
                row, key = part_keys(sets, percent, shared.value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(ids[a + row]), pa.array(size[row]), pa.array(np.zeros(len(row), np.int32))], ["s", "id", "n", "at"]
                )

    return source.join(crowded, "id").select("id", "text").mapInArrow(run, "s long, id long, n int, at int")


def _candidates(rows: DataFrame, percent: int, small: int) -> DataFrame:
    """Pairs of documents of a region, the ``rows (s, id, n, at)`` of one ``s``: ``u, v, sure``.

    ``at`` is the rank of a first shingle in its set. Small regions give all pairs that sizes and ranks allow. Larger ones give the
    chain of documents by size, cut where sizes differ too much: it holds the region
    together without its pairs, and ``sure`` tells that its pairs are not listed.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pairs(s: np.ndarray, doc: np.ndarray, n: np.ndarray, at: np.ndarray, chain: bool) -> tuple[np.ndarray, ...]:
        begin = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
        size = np.diff(np.append(begin, len(s)))
        few = np.repeat(size <= small, size) & (not chain)
        us, vs, sure = [], [], []
        for o in range(1, min(small, len(s))):
            i = np.flatnonzero((s[:-o] == s[o:]) & (few[:-o] if o > 1 else True) & (doc[:-o] != doc[o:]))
            j = i + o
            ok = 100 * n[i] >= percent * n[j]
            room = np.minimum(n[i] - at[i], n[j] - at[j])
            ok &= ~few[i] | ((100 + percent) * room >= percent * (n[i] + n[j]))
            us.append(doc[i[ok]])
            vs.append(doc[j[ok]])
            sure.append(~few[i[ok]])
        return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (us, vs, sure))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, cut = None, False
        for batch in batches:
            now = [np.asarray(c) for c in batch.columns]
            if not batch.num_rows:
                continue
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now)]
            last = int(np.searchsorted(now[0], now[0][-1]))
            done, held = [c[:last] for c in now], [c[last:] for c in now]
            if len(done[0]):
                yield _pairs_batch(*pairs(*done, cut))
                cut = False
            if len(held[0]) > 20_000:  # part of a very large region: its chain goes on from its last row
                yield _pairs_batch(*pairs(*held, True))
                held, cut = [c[-1:] for c in held], True
        if held is not None:
            yield _pairs_batch(*pairs(*held, cut))

    found = (
        rows.select("s", "id", "n", "at").repartition(n, "s").sortWithinPartitions("s", "n", "id")
        .mapInArrow(run, "u long, v long, sure boolean")
    )
    return found.groupBy(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).agg(F.max("sure").alias("sure"))


def _pairs_batch(u: np.ndarray, v: np.ndarray, sure: np.ndarray) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip((u, v, sure.astype(bool)), kinds)], ["u", "v", "sure"])


def _near(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs whose distances to the class pivots allow a link."""
    # An id with several texts is in here with each of them.
    side = lambda c: reps.where(F.size("first") > 0).select(
        F.col("id").alias(c), F.col("n").alias(f"n_{c}"), F.col("classes").alias(f"classes_{c}")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v, n, m, a, b = batch.columns
            apart = class_distances(a.to_pylist(), b.to_pylist())
            keep = pa.array((100 + percent) * apart <= (100 - percent) * (np.asarray(n) + np.asarray(m)))
            yield pa.RecordBatch.from_arrays([u.filter(keep), v.filter(keep)], ["u", "v"])

    tested = (
        pairs.where(~F.col("sure")).join(side("u"), "u").join(side("v"), "v")
        .select("u", "v", "n_u", "n_v", "classes_u", "classes_v").mapInArrow(run, "u long, v long")
    )
    return tested.union(pairs.where("sure").select("u", "v"))


def roots_within(sets: list[np.ndarray], percent: int, pairs: int = 4_000_000) -> np.ndarray:
    """For sets of one cell: the place of the first set of each one's link component. Exact, all pairs.

    Overlaps are counted for a slice of rows at a time, of at most ``pairs`` pairs or one row.
    """
    root = np.arange(len(sets))
    size = np.array([len(s) for s in sets], np.int64)
    _, kind, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(root, size)
    shared = n[kind] > 1
    # A set links to none unless others hold ``percent`` of its shingles.
    live = np.flatnonzero(100 * np.bincount(owner[shared], minlength=len(sets)) >= percent * size)
    place = np.full(len(sets), -1)
    place[live] = np.arange(len(live))
    shared &= place[owner] >= 0
    if not shared.any():
        return root
    owner, size, m = place[owner[shared]], size[live], len(live)
    _, kind, n = np.unique(kind[shared], return_inverse=True, return_counts=True)
    by = np.argsort(n, kind="stable")  # shingles by how many sets hold them
    rank = np.empty(len(n), np.int64)
    rank[by] = np.arange(len(n))
    kind, n = rank[kind], n[by]
    holders = owner[np.argsort(kind, kind="stable")]
    start = np.append(0, np.cumsum(n))
    rare = int(np.searchsorted(n, 33))
    few = kind < rare
    owner, kind = owner[few], kind[few]
    work = np.cumsum(m + np.bincount(owner, n[kind], m).astype(np.int64))
    label, a = np.arange(m), 0
    while a < m and (label[a:] != label[a]).any():
        b = max(a + 1, int(np.searchsorted(work, (work[a - 1] if a else 0) + pairs, "right")))
        mine = slice(*np.searchsorted(owner, [a, b]))
        # Rare shingles: count their pairs.
        times = n[kind[mine]]
        at = np.repeat(start[kind[mine]] - np.append(0, np.cumsum(times)[:-1]), times) + np.arange(times.sum())
        row, other = np.repeat(owner[mine] - a, times), holders[at] - a
        later = other >= 0
        common = np.bincount(row[later] * (m - a) + other[later], minlength=(b - a) * (m - a)).astype(np.float32).reshape(b - a, m - a)
        for c in range(rare, len(n), 512):  # frequent ones: count by matrix product, some columns at a time
            to = min(c + 512, len(n))
            held, col = holders[start[c] : start[to]] - a, np.repeat(np.arange(to - c), n[c:to])
            x = np.zeros((m - a, to - c), np.float32)
            x[held[held >= 0], col[held >= 0]] = 1
            common += x[: b - a] @ x.T
        row, other = np.nonzero(common)
        near = linked(common[row, other].astype(np.int64), size[a + row], size[a + other], percent)
        row, other = row[near], other[near] + a
        cuts = np.searchsorted(row, np.arange(b - a + 1))
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            own = label[other[cuts[k] : cuts[k + 1]]]
            if (own != label[a + k]).any():
                own = np.unique(np.append(own, label[a + k]))
                label[np.isin(label, own)] = own[0]
        a = b
    root[live] = live[label]
    return root


def _too_large(most: int, docs: int) -> Column:
    """Of cells (``total, docs``): whether one task can not hold the sets, or compare all their pairs."""
    return (F.col("total") > most) | (F.col("docs") > docs)


def _join_regions(
    source: DataFrame, cells: DataFrame, reps: DataFrame, width: int, percent: int, most: int, docs: int, part: int, near: float, broadcast_rows: int
) -> DataFrame:
    """Edges ``u, v`` that connect exactly the documents linked inside each of ``cells (id, cell)``."""
    sized = cells.join(reps.groupBy("id").agg(F.max("n").alias("n")), "id")
    weight = materialize(sized.groupBy("cell").agg(F.sum("n").alias("total"), F.count("*").alias("docs")).where("docs > 1"), "weights")
    fits = cells.join(weight.where(~_too_large(most, part)).select("cell"), "cell", "left_semi")
    edges = _join_cells(_with_sets(source, fits, width, broadcast_rows), percent)
    large = weight.where(_too_large(most, part))
    if not large.isEmpty():
        held = materialize(_with_sets(source, cells.join(large.select("cell"), "cell", "left_semi"), width, broadcast_rows), "large")
        edges = edges.union(_part(held, percent, most, docs, part, near))
    return materialize(edges, "links")


def _with_sets(source: DataFrame, cells: DataFrame, width: int, broadcast_rows: int) -> DataFrame:
    """``cell, id, set`` (sorted hashes as bytes) of the documents in ``cells (id, cell)``."""
    wanted = cells.select("id", "cell")
    if wanted.count() <= broadcast_rows:
        wanted = F.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.tobytes() for _, s in _sets_of(batch.column(2), width)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sets, pa.binary())], ["cell", "id", "set"])

    return source.join(wanted, "id").select("cell", "id", "text").mapInArrow(run, "cell string, id long, set binary")


def _join_cells(held: DataFrame, percent: int) -> DataFrame:
    """Each document and the first of its link component in its cell. A cell's sets are held by one task."""
    n = int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def cell(ids: list[int], raw: list[bytes]) -> tuple[list[int], list[int]]:
        root = roots_within([np.frombuffer(b, np.uint64) for b in raw], percent).tolist()
        out = [(ids[k], ids[r]) for k, r in enumerate(root) if ids[k] != ids[r]]
        return [u for u, _ in out], [v for _, v in out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, raw = None, [], []
        for batch in batches:
            us, vs = [], []
            for name, number, held in zip(*(c.to_pylist() for c in batch.columns)):
                if name != now:
                    if len(ids) > 1:
                        u, v = cell(ids, raw)
                        us += u
                        vs += v
                    now, ids, raw = name, [], []
                ids.append(number)
                raw.append(held)
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])
        if len(ids) > 1:
            u, v = cell(ids, raw)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return held.repartition(n, "cell").sortWithinPartitions("cell", "id").mapInArrow(run, "u long, v long")


def _part(held: DataFrame, percent: int, most: int, docs: int, part: int, near: float, pivots: int = 32, rounds: int = 8) -> DataFrame:
    """Part cells ``cell, id, set`` of over ``part`` documents around pivots of their own, again and again, and join all of them exactly.

    A cell that its pivots don't part is joined as it is if one task can hold it, else as a dense one.
    """
    edges = None
    add = lambda more: more if edges is None else edges.union(more)
    for depth in range(rounds):
        cells = held.groupBy("cell").agg(F.count("*").alias("docs"), F.sum(F.octet_length("set") / 8).alias("total"))
        cells = materialize(cells.where("docs > 1"), "cells")
        ready = cells.where(~_too_large(most, part)).select("cell")
        edges = add(_join_cells(held.join(ready, "cell", "left_semi"), percent))
        large = cells.where(_too_large(most, part))
        if large.isEmpty():
            return edges
        edges = materialize(edges, "cell-links")
        parted = materialize(_split(held.join(large.select("cell"), "cell", "left_semi"), large, percent, most, docs, near, pivots, depth), "parted")
        size = F.octet_length("set")
        shrunk = (
            parted.groupBy("parent", "cell").agg(F.sum(size).alias("now"), F.sum(F.when(F.col("own"), size).otherwise(0)).alias("own"))
            .groupBy("parent").agg(F.max("now").alias("largest"), F.sum("now").alias("now"), F.sum("own").alias("was"))
        )
        stuck = materialize(shrunk.where("largest > 0.9 * was OR now > 8 * was").select("parent"), "stuck")
        heavy = cells.where(_too_large(most, docs)).select(F.col("cell").alias("parent"))
        whole = parted.where("own").join(stuck, "parent", "left_semi").select("parent", F.col("parent").alias("cell"), "id", "set", "links")
        edges = edges.union(_join_cells(whole.join(heavy, "parent", "left_anti").select("cell", "id", "set"), percent))
        if not (dense := whole.join(heavy, "parent", "left_semi").drop("parent")).isEmpty():
            edges = edges.union(_join_dense(dense, percent, most, docs))
        held = parted.join(stuck, "parent", "left_anti").select("cell", "id", "set")
    # What is still in many cells after all rounds: whole cells where they fit, slices where not.
    cells = held.groupBy("cell").agg(F.count("*").alias("docs"), F.sum(F.octet_length("set") / 8).alias("total"))
    cells = materialize(cells.where("docs > 1"), "cells")
    edges = add(_join_cells(held.join(cells.where(~_too_large(most, docs)).select("cell"), "cell", "left_semi"), percent))
    dense = held.join(cells.where(_too_large(most, docs)).select("cell"), "cell", "left_semi")
    return edges.union(_join_dense(dense.withColumn("links", F.lit(0).cast("long")), percent, most, docs))


def _split(
    held: DataFrame, large: DataFrame, percent: int, most: int, docs: int, near: float, pivots: int, depth: int
) -> DataFrame:
    """Deal each large cell's documents to the Voronoi cells and windows of its pivots.

    Rows ``parent, cell, id, set, own, links``: one for each cell, of which one is ``own``;
    ``links`` has a bit for each candidate pivot that the document links with. Candidates are
    up to ``pivots`` documents of least hash, as far as they have ``most`` shingles together. A
    cell is dealt to several tasks, each of which gets the candidates; none passes the driver.
    """
    n = int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    radius = 1 - percent / 100
    tasks = F.ceil(F.greatest(F.col("total") / most, F.col("docs") / docs)).cast("int")
    large = large.select("cell", "docs", tasks.alias("tasks"))
    mixed = F.xxhash64("id", F.lit(depth))
    few = held.join(large, "cell").where(F.pmod(mixed, F.col("docs")) < 4 * pivots)  # about that many rows a cell
    order = Window.partitionBy("cell").orderBy(mixed, "id", "set")
    few = few.withColumns({"k": F.row_number().over(order), "sum": F.sum(F.octet_length("set") / 8).over(order.rowsBetween(Window.unboundedPreceding, 0))})
    few = few.where((F.col("k") <= pivots) & ((F.col("sum") <= most) | (F.col("k") == 1)))
    leading = few.select("cell", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"), "k", "id", "set")
    own = held.join(large, "cell").select(
        "cell", F.pmod(F.xxhash64("id", "set"), F.col("tasks")).cast("int").alias("task"), F.lit(None).cast("int").alias("k"), "id", "set"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, leads, known, chosen = None, [], None, []
        for batch in batches:
            cells, tasks, ks, ids, raws = (c.to_pylist() for c in batch.columns)
            at = 0
            while at < len(cells):
                if (cells[at], tasks[at]) != now:
                    now, leads, known = (cells[at], tasks[at]), [], None
                if ks[at] is not None:
                    leads.append(np.frombuffer(raws[at], np.uint64))
                    at += 1
                    continue
                if known is None:
                    known, chosen = Pivots(leads), thinned(leads, 2 * radius, len(leads))
                to, size = at, 0
                while to < len(cells) and (cells[to], tasks[to]) == now and (to == at or size < 8 << 20):
                    size += len(raws[to])
                    to += 1
                yield _dealt(now[0], ids[at:to], raws[at:to], known, chosen, percent, near)
                at = to

    return (
        leading.union(own).repartition(n, "cell", "task").sortWithinPartitions("cell", "task", F.col("k").asc_nulls_last())
        .mapInArrow(run, "parent string, cell string, id long, set binary, own boolean, links long")
    )


def _dealt(parent: str, ids: list[int], raws: list[bytes], known: Pivots, chosen: list[int], percent: int, near: float) -> pa.RecordBatch:
    sets = [np.frombuffer(r, np.uint64) for r in raws]
    common = known.common(sets)
    n = np.array([len(s) for s in sets], np.int64)[:, None]
    row, cell = voronoi((1 - common / (n + known.size - common))[:, chosen], 1 - percent / 100, near)
    links = (linked(common, n, known.size, percent).astype(np.int64) << np.arange(len(known.size))).sum(axis=1)
    row_list = row.tolist()
    return pa.RecordBatch.from_arrays(
        [
            pa.array([parent] * len(row), pa.string()), pa.array([f"{parent}/{c}" for c in cell.tolist()], pa.string()),
            pa.array([ids[r] for r in row_list], pa.int64()), pa.array([raws[r] for r in row_list], pa.binary()),
            pa.array(np.append(True, row[1:] != row[:-1])[: len(row)]), pa.array(links[row]),
        ],
        ["parent", "cell", "id", "set", "own", "links"],
    )


def _join_dense(held: DataFrame, percent: int, most: int, docs: int) -> DataFrame:
    """Edges of cells ``cell, id, set, links`` that pivots don't part.

    The documents that link with the best pivot, the core, are linked through it. Slices of
    the others meet each other and slices of the core, two of half a task each in a cell.
    """
    bit = F.explode(F.sequence(F.lit(0), F.lit(62)))
    bits = held.where("links <> 0").select("cell", "links", bit.alias("bit")).where("(shiftright(links, bit) & 1) = 1")
    best = bits.groupBy("cell", "bit").agg(F.count("*").alias("n")).groupBy("cell").agg(F.max_by("bit", F.struct("n", "bit")).alias("bit"))
    rows = held.join(best, "cell", "left").withColumn("core", F.coalesce(F.expr("(shiftright(links, bit) & 1) = 1"), F.lit(False)))
    rows = materialize(rows.select("cell", "id", "set", "core"), "dense")
    share = lambda of: F.ceil(
        2 * F.greatest(F.sum(F.when(of, F.octet_length("set") / 8)) / most, F.count(F.when(of, 1)) / docs)
    )
    sizes = rows.groupBy("cell").agg(
        F.coalesce(share(~F.col("core")), F.lit(0)).cast("int").alias("others"), F.coalesce(share(F.col("core")), F.lit(0)).cast("int").alias("cores"),
        F.min(F.when(F.col("core"), F.col("id"))).alias("root"),
    )
    sizes = materialize(sizes, "slices")
    star = rows.where("core").join(sizes, "cell").where("id <> root").select(F.col("id").alias("u"), F.col("root").alias("v"))
    sliced = rows.join(sizes.where("others > 0"), "cell").withColumn(
        "k", F.pmod(F.xxhash64("id", "set"), F.when(F.col("core"), F.col("cores")).otherwise(F.col("others"))).cast("int")
    )
    count = lambda n: F.filter(F.sequence(F.lit(0), n), lambda j: j < n)  # noqa: E731  0 to n - 1, nothing for n = 0
    name = lambda kind, i, j: F.concat_ws("/", "cell", F.lit(kind), i.cast("string"), j.cast("string"))
    k, others, cores = F.col("k"), F.col("others"), F.col("cores")
    among = F.transform(F.filter(count(others), lambda j: (j != k) | ((others == 1) & (cores == 0))), lambda j: name("others", F.least(k, j), F.greatest(k, j)))
    across = F.transform(count(cores), lambda j: name("core", k, j))
    met = F.when(F.col("core"), F.transform(count(others), lambda i: name("core", i, k))).otherwise(F.concat(among, across))
    return star.union(_join_cells(sliced.select(F.explode(met).alias("cell"), "id", "set"), percent))


def op8_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), width=4, percent=85)
