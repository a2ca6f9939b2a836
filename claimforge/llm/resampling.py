"""Draw documents towards a target distribution by importance weights and random keys.

A feature is a run of one or two words, and falls into the bucket of its hash. How much
more frequent a bucket is in the target than in the corpus is its gain, and the mean gain
of a document's features its weight. Weight plus Gumbel noise, a fixed function of the id,
is the score, and the documents of highest score are drawn.

Python tasks turn texts into arrays of buckets and sum gains there. Ranks come from a
distributed radix sort, least digit first, over the composite key (score, id). In each
pass blocks of bounded size count their digits, prefix sums over those counts give the
place where each block's run of a digit starts, and a stable counting sort inside
the block gives every row its place.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimforge.llm import arrow
from claimforge.session import materialize

SLICE_BYTES = 1 << 20
_SHORT = 64  # words of more bytes are hashed one by one


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()
_WORD_BYTE = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
_LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


def _crc_on(data: np.ndarray, state: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 states after the bytes ``data[start : start + size]``, all words a byte at a time."""
    order = np.argsort(size, kind="stable")[::-1]
    size, start, state = size[order], start[order], state[order]
    n_long = int(np.count_nonzero(size > _SHORT))
    for i in range(n_long):
        text = data[start[i] : start[i] + size[i]].tobytes()
        state[i] = zlib.crc32(text, int(state[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    steps = int(size[n_long]) if n_long < len(size) else 0
    ends = len(size) - np.searchsorted(size[::-1], np.arange(steps), "right")  # so many words have a byte at each step
    for j in range(steps):
        now = state[n_long : ends[j]]
        now[:] = _CRC[(now ^ data[start[n_long : ends[j]] + j]) & 255] ^ (now >> 8)
    out = np.empty_like(state)
    out[order] = state
    return out


def _pieces(data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes and offsets of the rows at once, or of a single long row in pieces of about ``SLICE_BYTES`` that part no word."""
    if len(ends) > 2 or len(data) <= 2 * SLICE_BYTES:
        yield data, ends
        return
    at = 0
    while at < len(data):
        to = min(len(data), at + SLICE_BYTES)
        while to < len(data):
            inside = _WORD_BYTE[data[to : to + 65_536]]
            to += len(inside) if inside.all() else int(inside.argmin())
            if not inside.all():
                break
        yield data[at:to], np.array([0, to - at])
        at = to


def features(data: np.ndarray, ends: np.ndarray, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of some rows: words of each row, row of each feature, bucket of each feature.

    A single long row comes in several parts, whose figures add up.
    """
    last = np.zeros(0, np.uint32)  # the state after the last word of a long row's piece before
    for part, bounds in _pieces(_LOWER[data], ends):
        inside = _WORD_BYTE[part]
        before, after = np.zeros_like(inside), np.zeros_like(inside)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        before[bounds[:-1][bounds[:-1] < len(part)]] = False
        after[bounds[1:][bounds[1:] > 0] - 1] = False
        start, stop = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        row = np.searchsorted(bounds, start, "right") - 1
        one = _crc_on(part, np.full(len(start), 0xFFFFFFFF, np.uint32), start, stop - start)
        second = np.flatnonzero(row[1:] == row[:-1]) + 1
        state = one[second - 1]
        if len(last) and len(start):
            second, state = np.append(0, second), np.append(last, state)
        spaced = _CRC[(state ^ 0x20) & 255] ^ (state >> 8)
        two = _crc_on(part, spaced, start[second], (stop - start)[second])
        if len(bounds) == 2 and len(start):
            last = one[-1:]
        hashes = np.concatenate([one, two]) ^ np.uint32(0xFFFFFFFF)
        yield np.bincount(row, minlength=len(bounds) - 1), np.concatenate([row, row[second]]), (hashes % np.uint32(buckets)).astype(np.int64)


def bucket_counts(texts: DataFrame, text_col: str, buckets: int) -> np.ndarray:
    """Features of all rows in each bucket; a task sends one row for each bucket it met."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, ends in arrow.slices(batch.column(0), SLICE_BYTES):
                for *_, bucket in features(data, ends, buckets):
                    total += np.bincount(bucket, minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["bucket", "n"])

    found = arrow.in_small_batches(texts).select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # ``buckets`` rows at most
        out[r.bucket] = r.n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed frequencies, rounded down."""
    k, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    ratio = [(float(t + 1) * float(s_all + k)) / (float(s + 1) * float(t_all + k)) for s, t in zip(corpus.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """Per row ``id, n_words, n_features, weight``: the mean gain of its features, rounded down, 0 without any."""
    buckets = len(gains)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            n_words, n_features, total = (np.zeros(n, np.int64) for _ in range(3))
            for at, to, data, ends in arrow.slices(batch.column(1), SLICE_BYTES):
                for words, row, bucket in features(data, ends, buckets):
                    rows = slice(at, to)
                    n_words[rows] += words
                    n_features[rows] += np.bincount(row, minlength=len(words))
                    by_row = np.zeros(len(words), np.int64)
                    np.add.at(by_row, row, gains[bucket])
                    total[rows] += by_row
            weight = total // np.maximum(n_features, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (n_words, n_features, weight))], ["id", "n_words", "n_features", "weight"])

    rows = arrow.in_small_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(score, "id long, n_words long, n_features long, weight long")


def gumbel(id_: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variable that the id and the seed fix, rounded down; a null id counts as no digits."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def _digits(bits: int, most: int) -> list[tuple[int, int]]:
    """(shift, width) of each digit of a key of so many bits, least first."""
    passes = -(-bits // most)
    width = -(-bits // passes) if passes else 0
    return [(i * width, min(width, bits - i * width)) for i in range(passes)]


def _counting_pass(rows: DataFrame, digit: Column, shift: int) -> DataFrame:
    """``rows`` with ``pos`` as after a stable sort by ``digit``, dense from 0; blocks are 2**shift values of ``pos``."""
    dealt = rows.withColumn("block", F.shiftright("pos", shift)).withColumn("digit", digit.cast("int"))
    counts = materialize(dealt.groupBy("digit", "block").agg(F.count("*").alias("n")), "digit-counts")
    totals = counts.groupBy("digit").agg(F.sum("n").alias("n")).collect()  # a row for each value of a digit
    below, bases = 0, []
    for r in sorted(totals, key=lambda r: r.digit):
        bases.append((r.digit, below))
        below += r.n
    base = rows.sparkSession.createDataFrame(bases, "digit int, base long")
    earlier = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(F.broadcast(base), "digit")
    starts = starts.select("block", "digit", (F.col("base") + F.col("before")).alias("start"))

    def scatter(block: pa.Table, start: pa.Table) -> pa.Table:
        places = np.zeros(1 + max(start["digit"].to_pylist(), default=0), np.int64)
        places[start["digit"].to_numpy()] = start["start"].to_numpy()
        block = block.take(pa.array(np.argsort(block["pos"].to_numpy(), kind="stable")))
        value = block["digit"].to_numpy().astype(np.uint16)
        order = np.argsort(value, kind="stable")  # a counting sort for two bytes
        first = np.searchsorted(value[order], np.arange(len(places)))
        pos = places[value[order]] + np.arange(len(order)) - first[value[order]]
        moved = block.take(pa.array(order)).drop_columns(["pos", "block", "digit"])
        return moved.append_column("pos", pa.array(pos))

    columns = [c for c in rows.columns if c != "pos"]
    schema = rows.select(*columns, "pos").schema
    moved = dealt.groupBy("block").cogroup(starts.groupBy("block")).applyInArrow(scatter, schema)
    return materialize(moved, "pass")


def radix_ranks(rows: DataFrame, score_col: str, id_col: str, digit_bits: int = 11, block_rows: int = 1 << 17) -> DataFrame:
    """``rows`` with ``rank``, 1 for the highest score, of equal ones the smaller id, null ids last.

    Both columns are whole numbers. A least-digit-first radix sort over as many bits as the
    values differ in. Rows go through Python tasks in blocks of at most ``block_rows``, smaller for
    small tables, so that no score, id or digit is met by one task alone. Each pass is written to the shared folder.
    """
    spark = rows.sparkSession
    whole = rows.select(F.struct("*").alias("row"), F.col(score_col).cast("long").alias("score"), F.col(id_col).cast("long").alias("id"))
    rows = materialize(whole.withColumn("pos", F.monotonically_increasing_id()), "unsorted")  # fixes the order that the first pass keeps
    least_most = [f(c).alias(f"{c}{k}") for c in ("score", "id") for k, f in enumerate((F.min, F.max))]
    b = rows.agg(F.count("*").alias("n"), F.count("id").alias("ids"), *least_most).first()
    if b.n == 0:
        return rows.select("row.*", F.lit(None).cast("long").alias("rank"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shift = max(8, min(block_rows.bit_length() - 1, (b.n // (2 * parts)).bit_length()))
    keys: list[tuple[Column, int, int]] = []
    if b.ids:
        span = b.id1 - b.id0
        if span < 1 << 62:
            key, bits = F.col("id") - F.lit(b.id0), span.bit_length()
        else:  # the whole range of a long: as unsigned numbers
            key, bits = F.col("id").bitwiseXOR(F.lit(-(1 << 63))), 64
        keys += [(F.coalesce(key, F.lit(0)), s, w) for s, w in _digits(bits, digit_bits)]
        if b.ids < b.n:
            keys.append((F.col("id").isNull().cast("long"), 0, 1))
    keys += [(F.lit(b.score1) - F.col("score"), s, w) for s, w in _digits((b.score1 - b.score0).bit_length(), digit_bits)]
    for key, s, w in keys or [(F.lit(0), 0, 1)]:
        rows = _counting_pass(rows, F.shiftrightunsigned(key.cast("long"), s).bitwiseAND(F.lit((1 << w) - 1)), shift)
    return rows.select("row.*", (F.col("pos") + 1).alias("rank"))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    percent: int = 25,
    least_words: int = 20,
    buckets: int = 10_000,
    seed: int = 7,
) -> DataFrame:
    """Per row of ``docs``: id, ``n_features, weight, score, rank``; ranks 1, 2, ... for the drawn, else null.

    Of the N documents of ``least_words`` words or more, floor(percent * N / 100) are drawn,
    those of highest score, of equal scores the smaller id. Null and empty texts have no features
    and weight 0; null ids are scored as if without digits and come after other ids of equal score;
    repeated rows are drawn each for itself, and rows of one id and score take their ranks in the order of the scan.
    An empty target or corpus leaves the smoothed frequencies. Ids are whole numbers;
    other columns are ignored. The gains (``buckets`` numbers) go to every task.
    """
    gains = bucket_gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_text_col, buckets))
    weighed = weigh(docs, gains, id_col, text_col).withColumn("score", F.col("weight") + gumbel(F.col("id"), seed))
    weighed = materialize(weighed, "weighed")
    enough = F.col("n_words") >= least_words
    columns = ["id", "n_features", "weight", "score"]
    ranked = radix_ranks(weighed.where(enough).select(columns), "score", "id")
    drawn = percent * ranked.count() // 100
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = weighed.where(~enough).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, "rank").union(rest).withColumnRenamed("id", id_col)


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return resample(docs, target)


# CRC-32 a byte at a time over each distinct feature, with the table made by eight shifts.
OP11_SQL = r"""
WITH tab AS (SELECT list(c ORDER BY i) AS t FROM (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
  FROM range(256) r(i))),
d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
df AS (SELECT r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM d),
bf AS (SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM b),
names AS (SELECT DISTINCT f FROM (SELECT f FROM df UNION ALL SELECT f FROM bf)),
crc AS (
  SELECT f, xor(list_reduce(
    list_prepend(4294967295, list_transform(range(0, octet_length(encode(f))), lambda i: ('0x' || hex(encode(f))[2 * i + 1 : 2 * i + 2])::BIGINT)),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS k
  FROM names, tab),
s AS (SELECT k, count(*) AS n FROM df JOIN crc USING (f) GROUP BY k),
t AS (SELECT k, count(*) AS n FROM bf JOIN crc USING (f) GROUP BY k),
g AS (
  SELECT q.k, floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE)
    / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM range(10000) q(k) LEFT JOIN s ON s.k = q.k LEFT JOIN t ON t.k = q.k),
m AS (SELECT r, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM df JOIN crc USING (f) JOIN g USING (k) GROUP BY r),
v AS (
  SELECT d.r, doc_id, len(w) AS words, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || sha256('7:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN m ON m.r = d.r),
o AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM v WHERE words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * n // 100 THEN place END AS rank FROM v LEFT JOIN o USING (r)
"""
