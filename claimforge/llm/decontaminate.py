"""Benchmark decontamination by winnowing, in DataFrame functions only.

Of every text the minimum k-gram hash of each window of ``span - k + 1`` k-grams is
kept. Two texts that share ``span`` words share such a window and so its minimum,
which makes the join of fingerprints lossless for spans of that length. Each hit is
then extended: the windows of ``span`` words around it are compared word by word.
Items shorter than ``span`` are one window of all their words, found by the hash of
that many words.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimforge.session import materialize

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# What is not part of a word, after lower-casing A-Z.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _grams(hashes: Column, k: int) -> Column:
    """The hash of each run of ``k`` words, in order."""
    runs = F.slice(hashes, 1, F.greatest(F.size(hashes) - (k - 1), F.lit(0)))
    if k == 1:
        return runs
    return F.transform(runs, lambda x, i: F.xxhash64(x, *(F.get(hashes, i + j) for j in range(1, k))))


def _minima(grams: Column, window: int) -> Column:
    """The minimum of each full window of ``window`` values, by doubling."""
    if window == 1:
        return grams

    def later(a: Column, n: int) -> Column:
        return F.slice(a, n + 1, F.greatest(F.size(a) - n, F.lit(0)))

    def wider(a: Column, b: Column) -> Column:  # a missing value leaves the other
        return F.zip_with(a, b, lambda x, y: F.least(x, y))

    def grow(a: Column, have: int) -> Column:
        step = min(have, window - have)
        if step == 0:
            return F.slice(a, 1, F.greatest(F.size(a) - (window - 1), F.lit(0)))
        return _let(wider(a, later(a, step)), lambda b: grow(b, have + step))

    return grow(grams, 1)


def _fingerprints(hashes: Column, span: int, k: int) -> Column:
    return _let(_grams(hashes, k), lambda g: F.array_distinct(_minima(g, span - k + 1)))


def _hashed(words: Column) -> Column:
    return F.transform(words, lambda x: F.xxhash64(x))


def _printer(span: int, k: int) -> Callable[[Column], Column]:
    return lambda hashes: _fingerprints(hashes, span, k)


def _windows(words: Column, hashes: Column, span: int, k: int, known: Callable[[Column], Column]) -> Column:
    """The text's windows of ``span`` words around its k-grams that are ``known`` fingerprints."""
    n = F.size(words)
    none = F.array().cast("array<struct<start:int,size:int,key:string>>")

    def around(grams: Column, hits: Column) -> Column:
        at = F.filter(F.transform(grams, lambda g, i: F.when(F.array_contains(hits, g), i)), lambda i: i.isNotNull())
        near = F.transform(at, lambda p: F.sequence(F.greatest(p - (span - k), F.lit(0)), F.least(n - span, p)))
        return F.transform(
            F.array_distinct(F.flatten(near)),
            lambda s: F.struct(
                s.cast("int").alias("start"), F.lit(span).alias("size"), F.concat_ws(" ", F.slice(words, s + 1, span)).alias("key")
            ),
        )

    def search(grams: Column) -> Column:
        hits = F.filter(F.array_distinct(_minima(grams, span - k + 1)), known)
        return _let(hits, lambda h: F.when(F.size(h) == 0, none).otherwise(around(grams, h)))

    return F.when(n < span, none).otherwise(_let(_grams(hashes, k), search))


def _item_windows(items: DataFrame, span: int) -> DataFrame:
    size = F.size("words")
    first = F.when(size >= span, F.sequence(F.lit(0), size - span)).when(size > 0, F.array(F.lit(0)))
    return (
        items.select("item_id", "words", F.explode(first).alias("s"))
        .select("item_id", F.concat_ws(" ", F.slice("words", F.col("s") + 1, F.least(F.size("words"), F.lit(span)))).alias("key"))
        .distinct()
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    span: int = 10,
    k: int = 5,
    literal_fingerprints: int = 20_000,
    broadcast_bytes: int = 8 << 20,
) -> DataFrame:
    """Per row ``n_words, n_hit, n_items, items_sha256, contaminated, text_key``.

    ``n_hit`` counts the words inside any occurrence of a window of an item, ``n_items``
    the items with such windows; ``items_sha256`` is over their ids as sorted, comma-joined strings and
    ``text_key`` is ``xxhash64`` of the text. Null and empty texts have no words; null
    item ids are left out; null document ids and repeated rows are kept; other columns
    are ignored; an empty benchmark hits nothing. Up to ``literal_fingerprints`` distinct
    fingerprints are compared inside the scan, more by a shuffled join, and the items'
    windows are broadcast only up to ``broadcast_bytes``.
    """
    items = materialize(
        benchmark.where(F.col(item_col).isNotNull())
        .select(F.col(item_col).alias("item_id"), words_of(F.col(item_text_col)).alias("words")).distinct(),
        "items",
    )
    sizes = [r[0] for r in items.select(F.least(F.size("words"), F.lit(span)).alias("n")).where("n > 0").distinct().collect()]
    k_of = {n: k if n == span else n for n in sorted(sizes)}
    prints = {
        n: materialize(
            items.where(F.size("words") >= span if n == span else F.size("words") == n)
            .select(F.explode(_let(_hashed(F.col("words")), _printer(n, k_of[n]))).alias("fp")).distinct(),
            "fingerprints",
        )
        for n in k_of
    }
    few = sum(p.count() for p in prints.values()) <= literal_fingerprints
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def searched(rows: DataFrame, known: Callable[[int], Callable[[Column], Column]]) -> DataFrame:
        def body(words: Column) -> Column:
            found = [lambda h, n=n: _windows(words, h, n, k_of[n], known(n)) for n in k_of]
            none = F.array().cast("array<struct<start:int,size:int,key:string>>")
            all_of = lambda h: F.concat(*(f(h) for f in found)) if found else none
            return F.struct(F.size(words).cast("long").alias("n_words"), _let(_hashed(words), all_of).alias("windows"))

        return rows.select("row", "id", F.xxhash64("text").alias("text_key"), _let(words_of(F.col("text")), body).alias("s"))

    if few:
        values = {n: [r[0] for r in p.collect()] for n, p in prints.items()}
        made = searched(rows, lambda n: lambda f: f.isin(values[n]))
    else:
        made = _searched_by_join(materialize(rows, "texts"), prints, k_of, searched)
    found = materialize(made, "windows").select("row", "id", "text_key", "s.n_words", "s.windows")
    windows = materialize(_item_windows(items, span), "item-windows")
    size = windows.agg(F.sum(F.octet_length("key") + 40)).first()[0] or 0
    side = F.broadcast(windows) if size <= broadcast_bytes else windows
    hits = (
        found.select("row", F.explode("windows").alias("w")).select("row", "w.*").join(side, "key")
        .groupBy("row").agg(F.collect_set(F.struct("start", "size")).alias("spans"), F.collect_set("item_id").alias("items"))
        .select(
            "row",
            F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s.start, s.start + s.size - 1))))).alias("n_hit"),
            F.size("items").alias("n_items"),
            F.concat_ws(",", F.array_sort(F.transform("items", lambda i: i.cast("string")))).alias("named"),
        )
    )
    zero = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long"))
    return found.select("row", "id", "text_key", "n_words").join(hits, "row", "left").select(
        F.col("id").alias(id_col), "n_words", zero("n_hit").alias("n_hit"), zero("n_items").alias("n_items"),
        F.sha2(F.coalesce("named", F.lit("")), 256).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"), "text_key",
    )


def _searched_by_join(rows: DataFrame, prints: dict[int, DataFrame], k_of: dict[int, int], searched) -> DataFrame:
    """For benchmarks with many fingerprints: find each row's hits by a join, then search with the row's own list."""
    hits = None
    for n, p in prints.items():
        mine = rows.select("row", F.explode(_let(_hashed(words_of(F.col("text"))), _printer(n, k_of[n]))).alias("fp"))
        found = mine.join(p, "fp").groupBy("row").agg(F.collect_set("fp").alias(f"hits_{n}"))
        hits = found if hits is None else hits.join(found, "row", "full")
    full = rows.join(hits, "row", "left")
    none = F.array().cast("array<bigint>")
    return searched(full, lambda n: lambda f: F.array_contains(F.coalesce(F.col(f"hits_{n}"), none), f))


def op10_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return contamination(docs, items).drop("text_key")


OP10_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{SEPARATORS}'), lambda x: x <> '') AS w FROM documents),
i AS (
  SELECT item_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{SEPARATORS}'), lambda x: x <> '') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s + 1 : s + 10], ' ') AS key
  FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 9, least(len(w), 1)))) AS s FROM i)),
lens AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT r, n, s, array_to_string(w[s + 1 : s + n], ' ') AS key
  FROM (SELECT r, w, n, unnest(range(greatest(len(w) - n + 1, 0))) AS s FROM d, lens)),
h AS (SELECT r, dw.n, s, item_id FROM dw JOIN iw USING (key)),
c AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT r, n, s FROM h)) GROUP BY r),
t AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM h GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)
"""
