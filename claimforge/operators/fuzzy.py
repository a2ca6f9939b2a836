"""Near-duplicate creditors inside a filing: candidate pairs, scores, clusters, merging.

The score compares keys as sets of tokens. It reaches a threshold in three ways: one set holds
the other, nearly so, or the tokens that are not common are spelled alike. The first two
leave one of a key's rarest tokens common, the third most pairs of letters. Both bounds follow
from the threshold alone, so an index of rare tokens and a count of common pairs of letters, made for whole blocks
of texts of like length as a matrix product, together lose no pair; only what they leave is scored. Groups of few rows are solved
where their rows meet, by one shuffle: neither their pairs nor their links leave the task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimforge.functions import names
from claimforge.operators.components import connected_components
from claimforge.session import materialize

MONEY = "decimal(15,2)"


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    if not a or not b:
        return 0
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | 1 << i
    row, full = (1 << len(a)) - 1, (1 << len(a)) - 1
    for ch in b:
        hit = row & places.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def token_set_score(a: str, b: str) -> float:
    """Likeness of two keys as token sets, 0 to 100; 100 if one's tokens hold the other's."""
    if not a or not b:
        return 0.0
    left, right = set(a.split()), set(b.split())
    both = " ".join(sorted(left & right))
    one, two = " ".join(sorted(left - right)), " ".join(sorted(right - left))
    if both and (not one or not two):
        return 100.0
    s, p = len(both), int(bool(both))
    first, second = s + p + len(one), s + p + len(two)
    best = 1 - (len(one) + len(two) - 2 * _common(one, two)) / (first + second)
    if s:
        best = max(best, 1 - (p + len(one)) / (s + first), 1 - (p + len(two)) / (s + second))
    return 100 * best


def _codes(texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """All characters of the texts, and where each text begins (and the last ends)."""
    ends = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(x) for x in texts], out=ends[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), ends


def _padded(codes: np.ndarray, ends: np.ndarray, rows: np.ndarray, width: int, pad: int) -> np.ndarray:
    """The codes of each row in ``width`` places, ``pad`` after its end."""
    at = ends[rows, None] + np.arange(width)
    return np.where(at < ends[rows + 1, None], codes[np.minimum(at, len(codes) - 1)], codes.dtype.type(pad))


def common_lengths(one: pd.Series, two: pd.Series) -> np.ndarray:
    """The longest common subsequence's length for each pair of texts, all pairs a character at a time.

    The bit-parallel rows of Hyyroe (2004), in as many 64-bit words as the longer first texts need; pairs of like length go together.
    """
    (a, a_ends), (b, b_ends) = _codes(one), _codes(two)
    met = np.zeros(1 + max(int(a.max(initial=0)), int(b.max(initial=0))), bool)
    met[a] = met[b] = True
    n_known = int(np.count_nonzero(met))
    number = np.cumsum(met, dtype=np.uint32).astype(np.uint8 if n_known < 250 else np.uint32)  # from 1
    a, b = number[a], number[b]
    a_size, b_size = np.diff(a_ends), np.diff(b_ends)
    out = np.zeros(len(one), np.int64)
    words, steps = -(-a_size // 64), -(-b_size // 16)
    for w, k in sorted(set(zip(words.tolist(), steps.tolist()))):
        if not w or not k:
            continue
        for rows in np.array_split(np.flatnonzero((words == w) & (steps == k)), -(-int(np.count_nonzero((words == w) & (steps == k))) // 4096)):
            left = _padded(a, a_ends, rows, 64 * w, 0)
            right = _padded(b, b_ends, rows, int(b_size[rows].max()), n_known + 1)
            row = np.full((len(rows), w), ~np.uint64(0), np.uint64)
            for j in range(right.shape[1]):
                hit = np.packbits(left == right[:, j : j + 1], axis=1, bitorder="little").view(np.uint64) & row
                carry = np.zeros(len(rows), bool)
                for x in range(w):  # row + hit, with the carry from word to word
                    total = row[:, x] + hit[:, x]
                    more = total + carry
                    carry = (total < row[:, x]) | (more < total)
                    row[:, x] = more | (row[:, x] & ~hit[:, x])
            out[rows] = np.bitwise_count(~row).sum(axis=1)
    return out


@F.pandas_udf(T.DoubleType())
def _likeness(common: pd.Series, one: pd.Series, two: pd.Series) -> pd.Series:
    """The score from the length of the common tokens and the texts of the others of each side."""
    n_one, n_two = one.str.len().to_numpy(np.int64), two.str.len().to_numpy(np.int64)
    s = common.to_numpy(np.int64)
    p = np.minimum(s, 1)
    first, second = s + p + n_one, s + p + n_two
    best = 1 - (n_one + n_two - 2 * common_lengths(one, two)) / np.maximum(first + second, 1)
    shared = np.maximum(1 - (p + n_one) / np.maximum(s + first, 1), 1 - (p + n_two) / np.maximum(s + second, 1))
    best = np.where(s > 0, np.maximum(best, shared), best)
    return pd.Series(100 * np.where((s > 0) & ((n_one == 0) | (n_two == 0)), 1.0, best))


def _tokens(key: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.coalesce(key, F.lit("")), r"\s+"), lambda x: x != ""))


def _parts(left: Column, right: Column) -> Column:
    """Of two token sets: the length of the common tokens, and the texts of the others."""
    text = lambda words: F.array_join(F.sort_array(words), " ")
    return F.struct(
        F.length(text(F.array_intersect(left, right))).alias("s"), text(F.array_except(left, right)).alias("one"), text(F.array_except(right, left)).alias("two")
    )


def token_set_scores(a: str, b: str) -> Column:
    """The score of two key columns, 0 where one has no token."""
    left, right = _tokens(F.col(a)), _tokens(F.col(b))
    parts = F.transform(F.array(_parts(left, right)), lambda x: x)[0]
    return F.when((F.size(left) == 0) | (F.size(right) == 0), 0.0).otherwise(_likeness(parts["s"], parts["one"], parts["two"]))


def keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("key", names.dedup_key(F.col("name"), F.col("address")))


def candidate_pairs(rows: DataFrame, by: str = "filing_id", identity: str = "row_id", most: int = 500) -> DataFrame:
    """All pairs of rows of one group: ``left_id < right_id``.

    A group is dealt to slices of about ``most`` rows by hash of the identity, and each slice
    meets each under a key of its own, so a large group is not one task.
    """
    sized = rows.join(rows.groupBy(by).agg(F.ceil(F.count("*") / most).cast("int").alias("_n")), by)
    sliced = sized.select(by, identity, F.pmod(F.xxhash64(identity), F.col("_n")).cast("int").alias("_k"), F.sequence(F.lit(0), F.col("_n") - 1).alias("_all"))
    left = sliced.select(by, F.col(identity).alias("left_id"), F.col("_k").alias("_i"), F.explode("_all").alias("_j"))
    right = sliced.select(by, F.col(identity).alias("right_id"), F.explode("_all").alias("_i"), F.col("_k").alias("_j"))
    return left.join(right, [by, "_i", "_j"]).where("left_id < right_id").select(by, "left_id", "right_id")


def score_pairs(pairs: DataFrame, rows: DataFrame, identity: str = "row_id", threshold: float = 85.0) -> DataFrame:
    """Pairs of at least ``threshold``. Only those that spelling may bring there reach the Python scores.

    From the lengths of common and of own tokens alone, in built-in functions, follows what the
    score is at most: it is exact but for what the spelling of own tokens has in common.
    """
    keys = rows.select(F.col(identity).alias("_id"), _tokens(F.col("key")).alias("_t"))
    both = (
        pairs.join(keys.withColumnsRenamed({"_id": "left_id", "_t": "_l"}), "left_id")
        .join(keys.withColumnsRenamed({"_id": "right_id", "_t": "_r"}), "right_id")
    )
    # A generator, so that the parts are made once for each pair and not again in the filter.
    able = both.where((F.size("_l") > 0) & (F.size("_r") > 0)).select(*pairs.columns, F.explode(F.array(_parts(F.col("_l"), F.col("_r")))).alias("_n"))
    s, one, two = F.col("_n.s"), F.length("_n.one"), F.length("_n.two")
    p = F.least(s, F.lit(1))
    spelled = 1 - F.abs(one - two) / F.greatest(2 * (s + p) + one + two, F.lit(1))
    shared = F.when(s > 0, F.greatest(1 - (p + one) / (2 * s + p + one), 1 - (p + two) / (2 * s + p + two))).otherwise(0.0)
    most = F.when((s > 0) & ((one == 0) | (two == 0)), 1.0).otherwise(F.greatest(spelled, shared))
    able = able.where(100 * most >= threshold - 1e-9)
    return able.withColumn("score", _likeness("_n.s", "_n.one", "_n.two")).where(F.col("score") >= threshold).drop("_n")


def _bigrams(texts: pd.Series, dims: int = 256) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: which (hashed) pairs of letters its tokens hold, how many such pairs repeat, its length, its letters by (hashed) kind."""
    codes, ends = _codes(" " + texts + " ")
    row = np.repeat(np.arange(len(texts)), np.diff(ends))
    inner = np.flatnonzero(row[1:] == row[:-1])
    held = np.zeros((len(texts), dims), np.float32)
    held[row[inner], (codes[inner].astype(np.int64) * 31 + codes[inner + 1]) % dims] = 1
    letters = np.zeros((len(texts), 64), np.int32)
    np.add.at(letters, (row, codes % 64), 1)
    n = np.diff(ends) - 2
    return held, n + 1 - held.sum(axis=1), n, letters


def spelled_alike(left: pd.Series, right: pd.Series, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of texts that may score ``threshold`` by the spelling of their own tokens; none that does is left out.

    With t the threshold and n, m the lengths, such texts are (1 - t) * (n + m) insertions and deletions apart at
    most. One changes three pairs of letters at most, of n + 1 and m + 1, which a matrix product counts for all pairs of
    texts at once, and one letter, which is looked at for the pairs that are left.
    """
    (a, a_more, n, a_letters), (b, b_more, m, b_letters) = _bigrams(left), _bigrams(right)
    edits = (1 - threshold / 100) * (n[:, None] + m[None, :]) + 1e-6
    common = a @ b.T + np.minimum(a_more[:, None], b_more[None, :])
    i, j = np.nonzero((2 * common >= n[:, None] + m[None, :] + 2 - 3 * edits) & (np.abs(n[:, None] - m[None, :]) <= edits))
    near = np.abs(a_letters[i] - b_letters[j]).sum(axis=1) <= edits[i, j]
    return i[near], j[near]


def _spelled_pairs(texts: DataFrame, threshold: float, most: int) -> DataFrame:
    """Pairs of a group whose texts may be spelled alike, from blocks of at most about ``most`` by ``most`` texts.

    ``texts``: ``by, id, text``. A group is dealt to classes of lengths and slices of those; blocks are two slices whose lengths allow the threshold.
    """
    t, base = threshold / 100, math.log(1.125)
    rows = texts.withColumn("n", F.length("text")).withColumn("class", F.floor(F.log("n") / base).cast("int"))
    sizes = rows.groupBy("by", "class").agg(F.ceil(F.count("*") / most).cast("int").alias("slices"))
    cells = F.flatten(F.collect_list(F.transform(F.sequence(F.lit(0), F.col("slices") - 1), lambda k: F.struct(F.col("class").alias("c"), k.alias("k")))))
    mine = sizes.groupBy("by").agg(cells.alias("cells"), F.map_from_entries(F.collect_list(F.struct("class", "slices"))).alias("slices"))
    placed = rows.join(mine.withColumnRenamed("by", "_by"), F.col("by") == F.col("_by"))
    own = F.struct(F.col("class").alias("c"), F.pmod(F.xxhash64("id"), F.element_at("slices", F.col("class"))).cast("int").alias("k"))
    span = math.log((2 - t) / t) / base + 1  # so many classes apart lengths may be
    near = F.filter("cells", lambda x: F.abs(x["c"] - F.col("class")) <= span)
    each = placed.select("by", "id", "text", own.alias("own"), F.explode(near).alias("other"))
    each = each.select("by", "id", "text", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), (F.col("own") <= F.col("other")).alias("left"))
    kinds = dict(texts.dtypes)

    def block(rows: pd.DataFrame) -> pd.DataFrame:
        left, right = rows[rows["left"]], rows[~rows["left"]]
        if right.empty and rows["a"].iloc[0] == rows["b"].iloc[0]:  # a slice with itself
            i, j = spelled_alike(left["text"], left["text"], threshold)
            i, j = i[i < j], j[i < j]
            right = left
        else:
            i, j = spelled_alike(left["text"], right["text"], threshold)
        a, b = left["id"].to_numpy()[i], right["id"].to_numpy()[j]
        return pd.DataFrame({"by": rows["by"].iloc[:1].repeat(len(i)).to_numpy(), "left_id": np.minimum(a, b), "right_id": np.maximum(a, b)})

    pack = lambda c: F.concat_ws(":", f"{c}.c", f"{c}.k").alias(c)
    dealt = each.select("by", "id", "text", pack("a"), pack("b"), "left")
    return dealt.groupBy("by", "a", "b").applyInPandas(block, f"by {kinds['by']}, left_id {kinds['id']}, right_id {kinds['id']}")


def _bucket_pairs(keyed_rows: DataFrame, most: int) -> DataFrame:
    """Pairs of different identities that share (``by``, ``bucket``) of which one has a ``probe``; a large bucket is dealt to slices."""
    sizes = keyed_rows.groupBy("by", "bucket").agg(F.count("*").alias("n"), F.max("probe").alias("any"))
    sizes = sizes.where("n > 1 AND any").select(F.col("by").alias("_by"), F.col("bucket").alias("_bucket"), F.ceil(F.col("n") / most).cast("int").alias("slices"))
    sized = keyed_rows.join(sizes, (F.col("by") == F.col("_by")) & (F.col("bucket") == F.col("_bucket")))
    mine = F.pmod(F.xxhash64("id"), F.col("slices")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("slices") - 1))
    left = sized.where("probe").select("by", "bucket", F.col("id").alias("a"), mine.alias("i"), every.alias("j"))
    right = sized.select("by", "bucket", F.col("id").alias("b"), "probe", every.alias("i"), mine.alias("j")).withColumnRenamed("probe", "both")
    met = left.join(right, ["by", "bucket", "i", "j"]).where("a <> b AND (NOT both OR a < b)")
    return met.select("by", F.least("a", "b").alias("left_id"), F.greatest("a", "b").alias("right_id"))


def likely_pairs(rows: DataFrame, by: str = "filing_id", identity: str = "row_id", threshold: float = 85.0, small: int = 200, most: int = 500, block: int = 2000) -> DataFrame:
    """Pairs ``by, left_id < right_id`` of rows with different ``key``, among them all of a score of ``threshold``.

    Groups of up to ``small`` rows give all pairs. In larger ones a pair has a rare token in common, which holds
    if one key's tokens are nearly all the other's, or may be spelled alike. Of a key's tokens those count as rare that,
    from the least frequent of its group on, are together longer than what the other key may lack. Threshold from 50 to 100.
    """
    t = threshold / 100
    some = rows.where(F.col(by).isNotNull()).select(F.col(by).alias("by"), F.col(identity).alias("id"), _tokens(F.col("key")).alias("tokens")).where(F.size("tokens") > 0)
    sized = some.join(some.groupBy("by").agg(F.count("*").alias("_n")), "by")
    few = candidate_pairs(sized.where(F.col("_n") <= small).select("by", "id"), "by", "id")
    many = sized.where(F.col("_n") > small)

    # Of a token in over a hundredth of a group's rows the share is known, of others that it is less: at most a hundred times a row's tokens.
    each = many.select("by", "_n", F.explode("tokens").alias("token")).groupBy("by", "token").agg(F.count("*").alias("n"), F.max("_n").alias("_n"))
    often = each.where(F.col("n") * 100 > F.col("_n")).groupBy("by").agg(F.map_from_entries(F.collect_list(F.struct("token", "n"))).alias("often"))
    known = many.join(often, "by", "left").withColumn("often", F.coalesce("often", F.create_map().cast("map<string,bigint>")))
    ranked = F.sort_array(F.transform("tokens", lambda x: F.struct(F.coalesce(F.try_element_at("often", x), F.lit(0)).alias("n"), x.alias("token"))))
    length = lambda words: F.aggregate(words, F.lit(0), lambda total, x: total + F.length(x["token"]) + 1)
    known = known.select("by", "id", ranked.alias("ranked")).withColumn("most", (length(F.col("ranked")) - 1) * (2 * (1 - t) / (2 - t)) + 1e-9)
    tokens = known.select("by", "id", "most", F.posexplode("ranked").alias("at", "x"), F.col("ranked"))
    tokens = tokens.select("by", "id", F.xxhash64("x.token").alias("bucket"), (length(F.slice("ranked", F.lit(1), F.col("at"))) <= F.col("most")).alias("probe"))
    texts = many.select("by", "id", F.array_join(F.sort_array("tokens"), " ").alias("text"))
    found = _bucket_pairs(tokens, most).union(_spelled_pairs(texts, threshold, block)).distinct()
    return few.select("by", "left_id", "right_id").union(found).withColumnRenamed("by", by)


class _Texts:
    """Token texts (distinct tokens in order, one blank between) as arrays: tokens by number, their lengths, and which characters they are."""

    def __init__(self, texts: pa.Array):
        self.texts = texts
        words = pc.split_pattern(texts, " ")
        coded = words.flatten().dictionary_encode()
        size = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        size[pc.utf8_length(texts).to_numpy(zero_copy_only=False) == 0] = 0
        row, width = np.repeat(np.arange(len(size)), np.maximum(size, 1)), max(1, int(size.max(initial=0)))
        at = np.arange(len(row)) - np.repeat(np.cumsum(np.maximum(size, 1)) - np.maximum(size, 1), np.maximum(size, 1))
        self.size, self.token, self.length = size, np.full((len(size), width), -1, np.int32), np.zeros((len(size), width), np.int64)
        known = at < size[row]
        code = coded.indices.to_numpy(zero_copy_only=False)
        self.token[row[known], at[known]] = code[known]
        self.length[row[known], at[known]] = pc.utf8_length(coded.dictionary).to_numpy(zero_copy_only=False)[code[known]]

    def bits(self) -> bool:
        """Makes masks of 64 bits, a bit for a character; false if a text is too long or the letters are too many."""
        codes, ends = _codes(pd.Series(self.texts.to_pylist(), dtype=object))
        if int(np.diff(ends).max(initial=0)) > 64 or len(codes) == 0:
            return False
        met = np.zeros(int(codes.max()) + 1, bool)
        met[codes] = True
        self.letters = int(np.count_nonzero(met)) + 1
        if self.letters > 200:
            return False
        self.codes = _padded(np.cumsum(met, dtype=np.uint8)[codes], ends, np.arange(len(self.size)), int(np.diff(ends).max()), 0)
        self.places = np.zeros((len(self.size), self.letters), np.uint64)
        for k in range(self.codes.shape[1]):
            self.places[np.arange(len(self.size)), self.codes[:, k]] |= np.uint64(1) << np.uint64(k)
        begin = np.cumsum(self.length + 1, axis=1) - self.length - 1
        one = lambda n: np.where(n < 64, np.uint64(1) << np.minimum(n, 63).astype(np.uint64), np.uint64(0))
        self.word, self.blank = one(begin + self.length) - one(begin), one(begin + self.length)
        return True

    def own(self, rows: np.ndarray, common: np.ndarray) -> np.ndarray:
        """The bits of the tokens that are not common, with the blanks between them."""
        out, later = np.zeros(len(rows), np.uint64), np.zeros(len(rows), bool)
        for w in range(self.token.shape[1] - 1, -1, -1):
            mine = (self.token[rows, w] >= 0) & ~common[:, w]
            out |= np.where(mine, self.word[rows, w], np.uint64(0)) | np.where(mine & later, self.blank[rows, w], np.uint64(0))
            later |= mine
        return out

    def text(self, row: int, common: np.ndarray) -> str:
        return " ".join(x for x, c in zip(self.texts[int(row)].as_py().split(" "), common) if not c)

    def common_lengths(self, i: np.ndarray, j: np.ndarray, in_i: np.ndarray, in_j: np.ndarray) -> np.ndarray:
        """As ``common_lengths`` of what is own to each of the pairs' texts."""
        if not hasattr(self, "able"):
            self.able = self.bits()
        if not self.able:
            return common_lengths(*(pd.Series([self.text(r, c) for r, c in zip(rows, common)], dtype=object) for rows, common in ((i, in_i), (j, in_j))))
        out = np.zeros(len(i), np.int64)
        left, right = self.own(i, in_i), self.own(j, in_j)
        for at in range(0, len(i), 16384):
            part = slice(at, at + 16384)
            codes, base, held = self.codes[j[part]].T.astype(np.int64), i[part] * self.letters, self.places.ravel()
            row, a, b = np.full(codes.shape[1], ~np.uint64(0), np.uint64), left[part], right[part]
            for k in range(codes.shape[0]):
                on = (b >> np.uint64(k)) & np.uint64(1)
                if on.any():
                    hit = row & held[base + codes[k]] & a & (np.uint64(0) - on)
                    row = (row + hit) | (row & ~hit)
            out[part] = np.bitwise_count(~row)
        return out


def _group_links(groups: pa.ListArray, jaccard: bool, threshold: float, at_once: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of lists of token texts: places ``i < j`` (among all texts of all lists) of pairs in one list that reach the threshold, and their scores."""
    size = pc.list_value_length(groups).to_numpy(zero_copy_only=False).astype(np.int64)
    every, ends = groups.flatten(), np.concatenate(([0], np.cumsum(size)))
    slices = np.cumsum(size * (size - 1) // 2) // at_once
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(slices)) + 1, [len(size)]))
    for g0, g1 in zip(cuts[:-1], cuts[1:]):
        lo, hi = int(ends[g0]), int(ends[g1])
        if hi - lo < 2:
            continue
        texts = _Texts(every.slice(lo, hi - lo))
        after = np.repeat(ends[g0 + 1 : g1 + 1], size[g0:g1]) - 1 - np.arange(lo, hi)  # rows of the same list behind each
        i = np.repeat(np.arange(hi - lo), after)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(after) - after, after)
        full = (texts.size[i] > 0) & (texts.size[j] > 0)
        i, j = i[full], j[full]
        one, two = texts.token[i], texts.token[j]
        in_i, in_j = np.zeros(one.shape, bool), np.zeros(two.shape, bool)
        for w in range(two.shape[1]):
            same = (one == two[:, w : w + 1]) & (two[:, w : w + 1] >= 0)
            in_i |= same
            in_j[:, w] = same.any(axis=1)
        n = in_i.sum(axis=1)
        if jaccard:
            score = n / np.maximum(texts.size[i] + texts.size[j] - n, 1)
        else:
            joined = lambda rows, chosen, n: (texts.length[rows] * chosen).sum(axis=1) + np.maximum(n - 1, 0)
            s, n_one, n_two = joined(i, in_i, n), joined(i, ~in_i, texts.size[i] - n), joined(j, ~in_j, texts.size[j] - n)
            p = np.minimum(s, 1)
            first, second = s + p + n_one, s + p + n_two
            shared = np.where(s > 0, np.maximum(1 - (p + n_one) / np.maximum(s + first, 1), 1 - (p + n_two) / np.maximum(s + second, 1)), 0.0)
            shared[(s > 0) & ((n_one == 0) | (n_two == 0))] = 1.0
            able = np.flatnonzero((shared < 1) & (100 * (1 - np.abs(n_one - n_two) / (first + second)) >= threshold - 1e-9))
            letters = texts.common_lengths(i[able], j[able], in_i[able], in_j[able])
            score = shared
            score[able] = np.maximum(score[able], 1 - (n_one[able] + n_two[able] - 2 * letters) / (first + second)[able])
            score = 100 * score
        good = score >= threshold
        yield i[good] + lo, j[good] + lo, score[good]


def _parted(rows: DataFrame, by: str, small: int) -> tuple[DataFrame, DataFrame | None]:
    """The rows of groups of up to ``small`` rows, and the others (null groups included) if there are any."""
    large = materialize(rows.groupBy(by).agg(F.count("*").alias("_n")).where((F.col("_n") > small) | F.col(by).isNull()).select(F.col(by).alias("_large")), "large-groups")
    if large.isEmpty():
        return rows, None
    met = F.col(by).eqNullSafe(F.col("_large"))
    return rows.join(large, met, "left_anti"), rows.join(large, met, "left_semi")


def _gathered(rows: DataFrame, by: str, identity: str) -> DataFrame:
    """A row for each group with its ``members`` in the order of their identities, and their ``texts``: sorted tokens."""
    text = F.array_join(F.sort_array(_tokens(F.col("key"))), " ").alias("_text")
    others = [c for c in rows.columns if c not in (by, identity)]
    member = F.struct(identity, text, *others)
    return rows.groupBy(by).agg(F.sort_array(F.collect_list(member)).alias("members")).select(by, "members", F.col("members._text").alias("texts"))


def small_group_pairs(rows: DataFrame, by: str = "filing_id", identity: str = "row_id", threshold: float = 85.0, jaccard: bool = False) -> DataFrame:
    """Pairs ``by, left_id < right_id, score`` of groups that each fit a task; ``jaccard``: by the share of common tokens, 0 to 1."""
    kind = {f.name: f.dataType for f in rows.schema}
    groups = _gathered(rows.select(by, identity, "key"), by, identity).select(by, F.col(f"members.{identity}").alias("ids"), "texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(1), batch.column(2)
            group = np.repeat(np.arange(len(ids)), pc.list_value_length(ids).to_numpy(zero_copy_only=False))
            flat = ids.flatten()
            for i, j, score in _group_links(texts, jaccard, threshold):
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(group[i])), flat.take(pa.array(i)), flat.take(pa.array(j)), pa.array(score)], [by, "left_id", "right_id", "score"])

    shape = T.StructType([T.StructField(by, kind[by]), T.StructField("left_id", kind[identity]), T.StructField("right_id", kind[identity]), T.StructField("score", T.DoubleType())])
    return groups.mapInArrow(run, shape).where("left_id < right_id")


def small_group_clusters(rows: DataFrame, by: str = "filing_id", identity: str = "row_id", threshold: float = 85.0, jaccard: bool = False) -> DataFrame:
    """Rows with ``cluster_id``, the least identity of those that links of one group reach, for groups that each fit a task."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def least(texts: pa.Array) -> pa.Array:
        size = pc.list_value_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.concatenate(([0], np.cumsum(size)))
        label = np.arange(ends[-1])
        for i, j, _ in _group_links(texts, jaccard, threshold):
            while (label[i] != label[j]).any():
                to = np.minimum(label[i], label[j])
                np.minimum.at(label, label[i], to)
                np.minimum.at(label, label[j], to)
                label[i], label[j] = label[label[i]], label[label[j]]
        while (label[label] != label).any():
            label = label[label]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(label - np.repeat(ends[:-1], size), pa.int32()))

    groups = _gathered(rows, by, identity).select(by, "members", least("texts").alias("least"))
    each = groups.select(by, F.col(f"members.{identity}").alias("_ids"), F.inline(F.arrays_zip("members", "least")))
    return each.select(*(F.col(c) if c == by else F.col(f"members.{c}").alias(c) for c in rows.columns), F.get("_ids", F.col("least")).alias("cluster_id"))


def jaccard_pairs(rows: DataFrame, by: str = "filing_id", identity: str = "row_id", threshold: float = 0.99, small: int = 200, most: int = 1000) -> DataFrame:
    """All pairs of a group with that share of common tokens. Groups of more than ``small`` rows are met in slices of ``most``."""
    few, many = _parted(rows, by, small)
    out = small_group_pairs(few, by, identity, threshold, True).select("left_id", "right_id")
    if many is None:
        return out
    keys = many.select(identity, "key")
    both = candidate_pairs(many, by, identity, most).join(keys.toDF("left_id", "a"), "left_id").join(keys.toDF("right_id", "b"), "right_id")
    return out.union(both.where(token_jaccard(F.col("a"), F.col("b")) >= threshold).select("left_id", "right_id"))


def jaccard_clusters(rows: DataFrame, by: str = "filing_id", identity: str = "row_id", threshold: float = 0.99, small: int = 200) -> DataFrame:
    """Rows with the least row of their cluster under links of that share of common tokens."""
    few, many = _parted(rows, by, small)
    out = small_group_clusters(few, by, identity, threshold, True)
    if many is None:
        return out
    keys = many.select(identity, "key")
    both = likely_pairs(many, by, identity).join(keys.toDF("left_id", "a"), "left_id").join(keys.toDF("right_id", "b"), "right_id")
    return out.unionByName(cluster(many, both.where(token_jaccard(F.col("a"), F.col("b")) >= threshold), identity))


def scored_links(rows: DataFrame, by: str = "filing_id", identity: str = "row_id", threshold: float = 85.0) -> tuple[DataFrame, DataFrame]:
    """Scored pairs of the least rows of equal keys, and each row with that row as ``first_id``.

    Equal keys score 100 whatever they are, save empty ones, which score 0 with every key.
    """
    firsts = rows.where("key <> ''").groupBy(by, "key").agg(F.min(identity).alias("first_id"))
    firsts = materialize(firsts, "distinct-keys").withColumnRenamed("first_id", identity)
    pairs = score_pairs(likely_pairs(firsts, by, identity, threshold), firsts, identity, threshold).select(by, "left_id", "right_id", "score")
    members = rows.join(firsts.withColumnRenamed(identity, "first_id"), [by, "key"]).select(by, F.col(identity).alias("id"), "first_id")
    return pairs, members


def all_scored_pairs(rows: DataFrame, by: str = "filing_id", identity: str = "row_id", threshold: float = 85.0, small: int = 200) -> DataFrame:
    """Every pair of rows of a group that scores ``threshold``; as many as there are."""
    few, many = _parted(rows, by, small)
    found = small_group_pairs(few, by, identity, threshold).select("left_id", "right_id", "score")
    if many is None:
        return found
    pairs, members = scored_links(many, by, identity, threshold)
    members = materialize(members, "members").select("id", "first_id")
    same = members.alias("x").join(members.alias("y"), F.expr("x.first_id = y.first_id AND x.id < y.id")).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), F.lit(100.0).alias("score"))
    other = (
        pairs.join(members.select(F.col("id").alias("a"), F.col("first_id").alias("left_id")), "left_id")
        .join(members.select(F.col("id").alias("b"), F.col("first_id").alias("right_id")), "right_id").select("a", "b", "score")
    )
    return found.union(same.union(other).select(F.least("a", "b").alias("left_id"), F.greatest("a", "b").alias("right_id"), "score"))


def token_jaccard(a: Column, b: Column) -> Column:
    """The share of common tokens, in built-in functions only."""
    left, right = (F.array_distinct(F.filter(F.split(c, " "), lambda x: x != "")) for c in (a, b))
    return F.size(F.array_intersect(left, right)) / F.greatest(F.size(F.array_union(left, right)), F.lit(1))


def cluster(rows: DataFrame, pairs: DataFrame, identity: str = "row_id") -> DataFrame:
    """Each row with the least row of its cluster."""
    groups = connected_components(pairs, "left_id", "right_id")
    return rows.join(groups, F.col(identity) == F.col("node"), "left").withColumn("cluster_id", F.coalesce("component", identity)).drop("node", "component")


def merge_clusters(rows: DataFrame, by: str = "filing_id") -> DataFrame:
    """One row per cluster: the canonical name is that of most confidence, then the longest, then the first row's."""
    rank = F.struct(F.coalesce("confidence", F.lit(-1.0)), F.length("name"), -F.col("row_id"))
    distinct_names = F.array_sort(F.collect_set("name"), lambda a, b: F.when(F.lower(a) < F.lower(b), -1).when(F.lower(a) > F.lower(b), 1).when(a < b, -1).when(a > b, 1).otherwise(0))
    best = F.max_by("name", rank)
    merged = F.concat(F.array(best), F.filter(distinct_names, lambda x: x != best))
    out = rows.groupBy(by, "cluster_id").agg(
        best.alias("_name"), F.max_by("address", rank).alias("_address"), F.sum("claim_amount").cast(MONEY).alias("_claim"),
        F.max("confidence").alias("_confidence"), F.count("*").alias("n_rows"), F.sort_array(F.collect_set("line_number")).alias("line_numbers"),
        F.when(F.count("*") > 1, F.concat_ws("|", merged)).alias("merged_names"),
    )
    return out.withColumnsRenamed({"_name": "name", "_address": "address", "_claim": "claim_amount", "_confidence": "confidence"})


def dedup_stats(rows: DataFrame, by: str = "filing_id") -> DataFrame:
    return rows.groupBy(by).agg(
        F.count("*").alias("original_count"), F.countDistinct("cluster_id").alias("deduped_count"),
        (F.count("*") - F.countDistinct("cluster_id")).alias("duplicates_removed"),
    )


def deduplicate(rows: DataFrame, by: str = "filing_id", threshold: float = 85.0, small: int = 200) -> DataFrame:
    """All of the above. ``rows`` has ``row_id, name, address, claim_amount, confidence, line_number``."""
    few, many = _parted(rows, by, small)
    out = merge_clusters(small_group_clusters(keyed(few), by, threshold=threshold), by)
    if many is None:
        return out
    with_keys = keyed(many)
    pairs, members = scored_links(with_keys, by, threshold=threshold)
    links = pairs.select("left_id", "right_id").union(members.where("id <> first_id").select("first_id", "id"))
    return out.unionByName(merge_clusters(cluster(with_keys, links), by))
