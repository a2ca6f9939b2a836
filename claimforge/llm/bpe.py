"""Byte-level BPE by a lexicon automaton and exact merging.

Frequent words with their ids are compiled into a minimal acyclic transducer: the
automaton shares prefixes and suffixes, and the numbers on its edges add up to the
word's place in the id table. It is written once, shipped as a file and memory-mapped
by every worker. Words outside it are merged pair by pair by rank, many words side by side. The lexicon only
saves time: every word's ids are those of the merges.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import io
import json
import os
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimforge.llm import arrow, pretokens
from claimforge.llm.sampling import at_least
from claimforge.session import materialize, shared_folder


SHORT = 64  # bytes of a word that is worth keeping; longer ones hardly come again, and a table of them has no bound in bytes


class Merges:
    """Vocabulary and merge ranks of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = _byte_of_character()
        raw = lambda token: bytes(to_byte[c] for c in token)
        vocab = {raw(t): i for t, i in spec["model"]["vocab"].items() if all(c in to_byte for c in t)}
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.bytes_of = {i: t for t, i in vocab.items()} | {i: t.encode() for t, i in self.special.items()}
        self.single = [vocab.get(bytes([b])) for b in range(256)]
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = map(raw, pair.split(" ") if isinstance(pair, str) else pair)
            self.pairs[vocab[left], vocab[right]] = rank, vocab[left + right]
        n = max(self.bytes_of) + 1
        self.length = np.array([len(self.bytes_of.get(i, b"")) for i in range(n)], np.int64)
        self.first = np.cumsum(self.length) - self.length
        self.all_bytes = np.frombuffer(b"".join(self.bytes_of.get(i, b"") for i in range(n)), np.uint8)
        self.of_byte = np.array([-1 if i is None else i for i in self.single], np.int64)
        table = np.array(sorted((a * n + b, rank, made) for (a, b), (rank, made) in self.pairs.items()), np.int64).reshape(-1, 3)
        self.pair_keys, self.pair_ranks, self.pair_ids = table.T.copy() if len(table) else np.array([[-2], [1], [0]])

    def ids(self, word: bytes) -> list[int]:
        """Merge the neighbouring pair of least rank, leftmost first, until none is left: n log n steps for n bytes."""
        parts = [self.single[b] for b in word]
        n, pairs = len(parts), self.pairs
        before, after, alive = list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
        heap = [(pairs[p][0], k, p) for k, p in enumerate(zip(parts, parts[1:])) if p in pairs]
        heapq.heapify(heap)
        while heap:
            _, k, pair = heapq.heappop(heap)
            right = after[k]
            if not alive[k] or right == n or (parts[k], parts[right]) != pair:
                continue  # one of the two has been merged since
            parts[k], alive[right] = pairs[pair][1], False
            after[k] = after[right]
            if after[k] < n:
                before[after[k]] = k
            for left, other in ((before[k], k), (k, after[k])):
                if left >= 0 and other < n and (made := (parts[left], parts[other])) in pairs:
                    heapq.heappush(heap, (pairs[made][0], left, made))
        return [p for p, a in zip(parts, alive) if a]

    def ids_of_all(self, words: list[bytes], longest: int = 64) -> list[bytes]:
        """Ids of many words as little-endian 32-bit numbers: short words are merged side by side, a merge of each in every step."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        out = [b""] * len(words)
        for k in np.flatnonzero(size > longest).tolist():
            out[k] = array("i", self.ids(words[k])).tobytes()
        short = np.flatnonzero((size > 0) & (size <= longest))
        if not len(short):
            return out
        part = self.of_byte[np.frombuffer(b"".join([words[k] for k in short.tolist()]), np.uint8)]
        word = np.repeat(np.arange(len(short)), size[short])
        ready: list[tuple[np.ndarray, np.ndarray]] = []
        while len(part):
            key = np.append(part[:-1] * len(self.length) + part[1:], -1)
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            last = np.append(word[1:] != word[:-1], True)
            rank = np.where((self.pair_keys[at] == key) & ~last, self.pair_ranks[at], len(self.pair_keys))
            first = np.flatnonzero(np.append(True, last[:-1]))
            least = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(part))))
            live = least < len(self.pair_keys)
            ready.append((word[~live], part[~live]))
            hit = live & (rank == least)
            # Of equal pairs that overlap, the first, the third and so on.
            run = np.flatnonzero(hit & ~np.append(False, hit[:-1]))
            if len(run):
                spot = np.flatnonzero(hit)
                hit[spot[(spot - run[np.searchsorted(run, spot, "right") - 1]) % 2 == 1]] = False
            part = np.where(hit, self.pair_ids[at], part)
            left = live & ~np.append(False, hit[:-1])
            part, word = part[left], word[left]
        word, part = (np.concatenate(x) for x in zip(*ready))
        by = np.argsort(word, kind="stable")
        raw = part[by].astype("<i4").tobytes()
        cut = (4 * np.append(0, np.cumsum(np.bincount(word, minlength=len(short))))).tolist()
        for k, x, y in zip(short.tolist(), cut, cut[1:]):
            out[k] = raw[x:y]
        return out

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all ids, one after the other."""
        size = self.length[ids]
        to = np.cumsum(size)
        return self.all_bytes[np.arange(int(to[-1]) if len(to) else 0) + np.repeat(self.first[ids] - (to - size), size)]


def _byte_of_character() -> dict[str, int]:
    """Byte-level BPE writes printable Latin-1 bytes as themselves, the others as 256, 257, ... in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Lexicon:
    """A minimal acyclic transducer from words to rows of an id table."""

    def __init__(self, kinds: np.ndarray, to: np.ndarray, add: np.ndarray, final: np.ndarray, bounds: np.ndarray, ids: np.ndarray):
        self.kinds, self.to, self.add, self.final, self.bounds, self.table = kinds, to, add, final, bounds, ids

    @classmethod
    def compile(cls, entries: Iterable[tuple[bytes, list[int]]]) -> Lexicon:
        """From distinct non-empty words with their ids, by incremental minimisation of sorted words."""
        entries = sorted(entries)
        register: dict[tuple, int] = {}
        done: list[tuple[bool, dict[int, int]]] = []
        path: list[tuple[list[bool], dict[int, int]]] = [([False], {})]

        def freeze(node: tuple[list[bool], dict[int, int]]) -> int:
            key = (node[0][0], tuple(node[1].items()))
            if key not in register:
                register[key] = len(done)
                done.append((node[0][0], node[1]))
            return register[key]

        def close(depth: int, word: bytes) -> None:
            while len(path) > depth + 1:
                child = freeze(path.pop())
                path[-1][1][word[len(path) - 1]] = child

        last = b""
        for word, _ in entries:
            shared = len(os.path.commonprefix([word, last]))
            close(shared, last)
            path.extend(([False], {}) for _ in word[shared:])
            path[-1][0][0] = True
            last = word
        close(0, last)
        root = freeze(path.pop())
        count = [0] * len(done)
        for s, (end, edges) in enumerate(done):  # children come before their parents
            count[s] = int(end) + sum(count[c] for c in edges.values())
        used = sorted({b for _, edges in done for b in edges})
        kinds = np.zeros(256, np.int64)
        kinds[used] = np.arange(1, len(used) + 1)
        # State 0 is the dead end and state 1 the root.
        name = np.arange(len(done)) + 2
        name[root] = 1
        to = np.zeros((len(done) + 2, len(used) + 1), np.int32)
        add, final = np.zeros_like(to), np.zeros(len(done) + 2, bool)
        for s, (end, edges) in enumerate(done):
            final[name[s]] = end
            before = int(end)
            for b in sorted(edges):
                to[name[s], kinds[b]], add[name[s], kinds[b]] = name[edges[b]], before
                before += count[edges[b]]
        size = np.array([len(i) for _, i in entries], np.int64)
        table = np.array([i for _, ids in entries for i in ids], "<i4")
        return cls(kinds, to, add, final, np.append(0, np.cumsum(size)), table)

    @classmethod
    def load(cls, name_of: dict[str, str]) -> Lexicon:
        return cls(*(np.load(path, mmap_mode="r") for path in name_of.values()))

    def rows(self, data: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """For each word ``data[first:first+size]`` its row in the id table, or -1."""
        state, row = np.ones(len(first), np.int64), np.zeros(len(first), np.int64)
        live, step = np.flatnonzero(size > 0), 0
        state[size == 0] = 0
        while len(live):
            kind, s = self.kinds[data[first[live] + step]], state[live]
            row[live] += self.add[s, kind]
            state[live] = self.to[s, kind]
            step += 1
            live = live[(state[live] > 0) & (size[live] > step)]
        return np.where(self.final[state] & (state > 0), row, -1)


class Encoder:
    """Ids of distinct words: from the lexicon, a table of at most ``most_words`` short words met before, or merging."""

    def __init__(self, tokenizer_path: str, lexicon: Lexicon | None, most_words: int):
        self.merges, self.lexicon, self.most_words = Merges(tokenizer_path), lexicon, most_words
        self.known: dict[bytes, bytes] = {}

    def ids_of(self, words: list[bytes]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(words)
        if self.lexicon is not None and words:
            size = np.fromiter(map(len, words), np.int64, len(words))
            data = np.frombuffer(b"".join(words), np.uint8)
            row = self.lexicon.rows(data, np.cumsum(size) - size, size)
            held = np.flatnonzero(row >= 0)
            raw, bounds = memoryview(self.lexicon.table).cast("B"), self.lexicon.bounds
            for k, a, b in zip(held.tolist(), (4 * bounds[row[held]]).tolist(), (4 * bounds[row[held] + 1]).tolist()):
                out[k] = bytes(raw[a:b])
        known = self.known
        new = [w for w, ids in zip(words, out) if ids is None and w not in known]
        made = dict(zip(new, self.merges.ids_of_all(new)))
        done = [ids if ids is not None else made[w] if w in made else known[w] for w, ids in zip(words, out)]
        short = {w: ids for w, ids in made.items() if len(w) <= SHORT}
        if len(known) + len(short) > self.most_words:
            known.clear()
        known.update(short)
        return done


@functools.lru_cache(maxsize=1)
def _encoder(tokenizer_path: str, lexicon_files: tuple[tuple[str, str], ...], most_words: int) -> Encoder:
    lexicon = Lexicon.load({k: SparkFiles.get(name) for k, name in lexicon_files}) if lexicon_files else None
    return Encoder(tokenizer_path, lexicon, most_words)


def build_lexicon(docs: DataFrame, tokenizer_path: str, text_col: str, words: int) -> tuple[tuple[str, str], ...]:
    """Compile the most frequent short pre-tokens of all documents, at most ``words``, and ship the files.

    Which words it holds has no effect on any id. Words are counted over whole texts; the
    driver gets those above the count that leaves at most ``words``.
    """
    spark = docs.sparkSession
    rows = arrow.in_small_batches(docs.select(F.coalesce(text_col, F.lit("")).alias("t")))

    def table(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(seen.keys()), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["w", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for _, _, data, ends in arrow.slices(batch.column(0), 1 << 20):
                found, n = pretokens.counted(data, ends)
                for word, k in zip(found, n):
                    if len(word) <= SHORT:
                        seen[word] += k
                if len(seen) > 200_000:
                    yield table(seen)
                    seen.clear()
        yield table(seen)

    counts = materialize(rows.mapInArrow(count, "w binary, n long").groupBy("w").agg(F.sum("n").alias("n")).where("n > 1"), "words")
    top = counts.where(F.col("n") >= at_least(counts, "n", 2, words)).select("w")
    merges = Merges(tokenizer_path)
    lexicon = Lexicon.compile((bytes(r[0]), merges.ids(bytes(r[0]))) for r in top.collect())
    folder = shared_folder(spark, "lexicon")
    mark = folder.rpartition("-")[2]
    fs, root = pafs.FileSystem.from_uri(folder)
    fs.create_dir(root)
    files = []
    for part, values in vars(lexicon).items():
        name = f"lexicon-{mark}-{part}.npy"
        with fs.open_output_stream(f"{root}/{name}") as out:
            held = io.BytesIO()
            np.save(held, values)
            out.write(held.getvalue())
        spark.sparkContext.addFile(f"{folder}/{name}")
        files.append((part, name))
    return tuple(files)


def bpe_round_trip(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    lexicon_words: int = 20_000,
    most_words: int = 200_000,
    chunk_bytes: int = 1 << 19,
    with_ids: bool = False,
) -> DataFrame:
    """Encode and decode whole texts; digests per row, and the ids themselves if ``with_ids``.

    Null texts count as empty: no ids, and the digests of nothing. Every row gives
    one row, repeated ones too, a null id stays null, and columns other than id and
    text are ignored. Special strings inside texts become their own id.
    """
    files = build_lexicon(docs, tokenizer_path, text_col, lexicon_words)
    kind = T.LongType()
    names = [(id_col, kind), ("n_tokens", kind), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    names += [("ids", T.ArrayType(T.IntegerType()))] if with_ids else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path, files, most_words)
        merges = encoder.merges
        for batch in batches:
            for a, b, data, ends in arrow.slices(batch.column(1), chunk_bytes):
                ids, to = pretokens.encode(data, ends, merges.special, encoder.ids_of)
                raw, text = ids.astype("<u4").tobytes(), merges.decode(ids).tobytes()
                at = np.append(0, np.cumsum(merges.length[ids]))[to].tolist()
                cut = to.tolist()
                rows = [
                    batch.column(0).slice(a, b - a),
                    pa.array(np.diff(to), pa.int64()),
                    pa.array([hashlib.sha256(raw[4 * x : 4 * y]).hexdigest() for x, y in zip(cut, cut[1:])]),
                    pa.array([
                        hashlib.sha256(text[x:y].decode("utf-8", "replace").encode()).hexdigest() for x, y in zip(at, at[1:])
                    ]),
                ]
                if with_ids:
                    rows.append(pa.ListArray.from_arrays(pa.array(to, pa.int32()), pa.array(ids, pa.int32())))
                yield pa.RecordBatch.from_arrays(rows, [n for n, _ in names])

    schema = T.StructType([T.StructField(n, t) for n, t in names])
    source = docs.select(F.col(id_col).cast("long"), F.coalesce(text_col, F.lit("")))
    return arrow.in_small_batches(source).mapInArrow(run, schema)


def op9_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return bpe_round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))
