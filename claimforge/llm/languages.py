"""Language identification by error-correcting output codes.

Each language has a codeword of +1 and -1; for every bit a binary classifier over
hashed character n-grams tells which of two sets of languages a text belongs to.
Decoding adds up an exponential loss over the bits, weighted by the least margin with
which a classifier tells any language of the training sample, and takes the nearest
codeword; a small lead over the second nearest marks the text as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimforge.llm import arrow
from claimforge.llm.pretokens import mix
from claimforge.llm.sampling import sample_ids_by

UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_ORDERS = (2, 3)
# Digits and ASCII marks count as blanks, letters in lower case.
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint64)


def features(data: np.ndarray, ends: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte n-grams of all texts, and the text each belongs to. N-grams never span two texts."""
    folded = _FOLD[data]
    owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    ids, owners = [], []
    code = folded
    for order in range(2, max(_ORDERS) + 1):
        if len(folded) < order:
            break
        code = code[: len(folded) - order + 1] * np.uint64(257) + folded[order - 1 :]
        if order in _ORDERS:
            whole = owner[: len(code)] == owner[order - 1 :]
            ids.append((mix(code[whole] + np.uint64(order << 40)) >> np.uint64(64 - bits)).astype(np.int64))
            owners.append(owner[: len(code)][whole])
    return (np.concatenate(ids), np.concatenate(owners)) if ids else (np.zeros(0, np.int64), np.zeros(0, np.int64))


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray  # languages x bits, +1 or -1
    weights: np.ndarray  # features x bits: log odds
    trust: np.ndarray  # bits: from the least margin of any language
    hash_bits: int
    scale: float = 2.0

    def margins(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        ids, owner = features(data, ends, self.hash_bits)
        out = np.zeros((len(ends) - 1, self.codes.shape[1]))
        counts = np.maximum(np.bincount(owner, minlength=len(out)), 1)
        for b in range(out.shape[1]):
            out[:, b] = np.bincount(owner, self.weights[ids, b], minlength=len(out)) / counts
        return out

    def losses(self, margins: np.ndarray) -> np.ndarray:
        return (self.trust * np.exp(-self.scale * margins[:, None, :] * self.codes[None])).mean(axis=2)


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """All distinct splits of up to 5 languages; for more, the best of 64 random codes of 10 log2(n) bits.

    Every bit has languages on both sides; a draw with a bit that hasn't gets one turned over.
    """
    if n == 1:
        return np.ones((1, 1))
    if n <= 5:
        splits = range(1, 1 << (n - 1))
        return np.array([[1 if k == 0 or not s >> (k - 1) & 1 else -1 for s in splits] for k in range(n)])
    rng, best, most = np.random.default_rng(seed), None, -1
    for _ in range(64):
        code = rng.choice([-1, 1], size=(n, int(np.ceil(10 * np.log2(n)))))
        flat = np.flatnonzero(np.abs(code.sum(axis=0)) == n)
        code[rng.integers(n, size=len(flat)), flat] *= -1
        apart = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i))
        if apart > most:
            best, most = code, apart
    return best


def train(
    docs: DataFrame, is_train: Column, id_col: str, text_col: str, lang_col: str, sample_docs: int = 4096, hash_bits: int = 15
) -> Model | None:
    """Fit on the labelled training rows of at most ``sample_docs`` ids: an equal share of each language, those of least hash.

    ``sample_docs`` is the bound of the training sample; its texts are used whole, rows
    without a text are passed over. A rare language is in it with all it has, up to its share.
    N-gram counts per language are summed by Spark; the driver gets one row per
    language and hash bucket. None if no row has a label and a text.
    """
    able = docs.where(is_train & F.col(lang_col).isNotNull())
    chosen = sample_ids_by(able, id_col, lang_col, sample_docs)
    sample = arrow.in_small_batches(able).where(F.col(id_col).isin(chosen) & F.col(text_col).isNotNull()).select(F.col(lang_col), F.col(text_col))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for a, _, data, ends in arrow.slices(batch.column(1), 1 << 20):
                ids, owner = features(data, ends, hash_bits)
                for lang in set(langs[a : a + len(ends) - 1]):
                    mine = np.array([x == lang for x in langs[a : a + len(ends) - 1]])
                    total[lang] = total.get(lang, 0) + np.bincount(ids[mine[owner]], minlength=1 << hash_bits)
        for lang, n in total.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some)), pa.array(some, pa.int64()), pa.array(n[some], pa.int64())], ["lang", "f", "n"]
            )

    sums = sample.mapInArrow(count, "lang string, f long, n long").groupBy("lang", "f").agg(F.sum("n").alias("n")).collect()
    languages = sorted({r.lang for r in sums})
    if not languages:
        return None
    counts = np.zeros((len(languages), 1 << hash_bits))
    for r in sums:
        counts[languages.index(r.lang), r.f] = r.n
    shares = counts + 0.5
    shares /= shares.sum(axis=1, keepdims=True)
    codes = codewords(len(languages))
    weights = np.zeros((1 << hash_bits, codes.shape[1]))
    for b in range(codes.shape[1]):
        yes, no = codes[:, b] > 0, codes[:, b] < 0
        if yes.any() and no.any():
            weights[:, b] = np.log(shares[yes].mean(axis=0)) - np.log(shares[no].mean(axis=0))
    # A classifier's trust: how far each language's own n-grams lie on the right side.
    means = (counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)) @ weights
    trust = 1 / (1 + np.exp(-8 * (means * codes).min(axis=0)))
    return Model(languages, codes, weights.astype(np.float32), trust, hash_bits)


def identify_languages(
    docs: DataFrame, model: Model | None, text_col: str = "text", least_lead: float = 0.2, chunk_bytes: int = 1 << 19
) -> DataFrame:
    """All columns of ``docs`` with ``lang_pred, score, ambiguous`` (which replace columns of these names).

    ``und`` with score 0 for null texts and texts without a letter, and for all
    texts if there is no model. ``score`` is the share of the nearest codeword in
    the softmax of negative losses; ``ambiguous`` when its lead over the second is
    below ``least_lead``. Empty tables and repeated rows need no special care.
    """
    ours = ("lang_pred", "score", "ambiguous")
    docs = docs.drop(*ours)
    kinds = (T.StringType(), T.DoubleType(), T.BooleanType())
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, t) for n, t in zip(ours, kinds))])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            column, n = batch.column(at), batch.num_rows
            best, score, unclear = np.full(n, -1), np.zeros(n), np.zeros(n, bool)
            if model is not None:
                for a, b, data, ends in arrow.slices(column, chunk_bytes):
                    loss = model.losses(model.margins(data, ends))
                    share = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
                    share /= share.sum(axis=1, keepdims=True)
                    best[a:b], score[a:b] = share.argmax(axis=1), share.max(axis=1)
                    ranked = np.sort(share, axis=1)
                    unclear[a:b] = ranked[:, -1] - (ranked[:, -2] if share.shape[1] > 1 else 0) < least_lead
                lettered = np.array([t is not None and _LETTER.search(t) is not None for t in column.to_pylist()], bool)
                best[~lettered] = -1
            score[best < 0], unclear[best < 0] = 0, True
            named = [UNKNOWN if k < 0 else model.languages[k] for k in best.tolist()]
            more = [pa.array(named, pa.string()), pa.array(score, pa.float64()), pa.array(unclear, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], schema.names)

    return arrow.in_small_batches(docs).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, ~held_out(), "doc_id", "text", "lang")
    out = identify_languages(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")
