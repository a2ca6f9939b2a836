"""Token-id files: each document a zstandard frame under one shared dictionary.

A shard file is ``MAGIC``, the frames, an index and an 8-byte length of the index.
The index is a zstandard frame of little-endian 64-bit numbers: document count,
then document ids, frame ends and id counts. The dictionary's SHA-256 stands in
the header, so a reader can tell which dictionary a shard needs, and one short
document is read by its frame alone. Ids are written as 16-bit numbers where all
of the vocabulary fits, else as 32-bit ones.
"""

from __future__ import annotations

import functools
import hashlib
import os
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimforge.llm import arrow, pretokens
from claimforge.llm.sampling import sample_ids
from claimforge.session import materialize, shared_folder

MAGIC = b"CFIDS1\0\0"
_LEVEL = 1
_SHORT = 64  # bytes of a pre-token that is worth keeping


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t, {a.content: i for i, a in t.get_added_tokens_decoder().items()}


@functools.lru_cache(maxsize=2)
def _known(path: str) -> dict[bytes, bytes]:
    return {}


def _ids_of(path: str, most_words: int, words: list[bytes]) -> list[bytes]:
    """Ids of pre-tokens by the tokenizers library; short ones met before come from a table of at most ``most_words``."""
    known, made = _known(path), {}
    if new := [w for w in words if w not in known]:
        found = _tokenizer(path)[0].encode_batch_fast([w.decode() for w in new], add_special_tokens=False)
        made = dict(zip(new, [array("i", e.ids).tobytes() for e in found]))
    done = [made[w] if w in made else known[w] for w in words]
    short = {w: ids for w, ids in made.items() if len(w) <= _SHORT}
    if len(known) + len(short) > most_words:
        known.clear()
    known.update(short)
    return done


def encode_column(
    column: pa.Array, tokenizer_path: str, end_id: int | None, chunk_bytes: int = 4 << 20, most_words: int = 400_000
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with all their ids and n+1 bounds, ``end_id`` after each document."""
    special = _tokenizer(tokenizer_path)[1]
    for a, b, data, ends in arrow.slices(column, chunk_bytes):
        ids, to = pretokens.encode(data, ends, special, lambda w: _ids_of(tokenizer_path, most_words, w))
        if end_id is not None:
            ids = np.insert(ids, to[1:], end_id)
            to = to + np.arange(len(to))
        yield a, b, ids, to


def train_dictionary(
    docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str, text_col: str, sample_docs: int, size: int,
    piece_bytes: int = 16 << 10, most_pieces: int = 4,
) -> bytes:
    """A zstandard dictionary over the id arrays of ``sample_docs`` documents (those of least id hash).

    An array is cut into pieces of ``piece_bytes``, of which at most ``most_pieces`` spread over
    the whole array are taken, so the driver holds a bounded number of bytes. Of rows that repeat
    an id the least text counts. With too little to learn from, an empty dictionary. The
    dictionary only affects file size: all documents are encoded whole.
    """
    chosen = sample_ids(docs, id_col, sample_docs)
    rows = docs.where(F.col(id_col).isin(chosen)).groupBy(id_col).agg(F.min(F.coalesce(text_col, F.lit(""))).alias("t")).select("t")

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _kind(tokenizer_path)
        for batch in batches:
            for _, _, ids, to in encode_column(batch.column(0), tokenizer_path, end_id):
                whole = [ids[x:y].astype(kind).tobytes() for x, y in zip(to[:-1].tolist(), to[1:].tolist())]
                parts = [w[p : p + piece_bytes] for w in whole for p in _spread(len(w), piece_bytes, most_pieces)]
                yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary())], ["ids"])

    samples = [bytes(r[0]) for r in rows.mapInArrow(arrays, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _spread(size: int, step: int, most: int) -> list[int]:
    """Where at most ``most`` pieces of ``step`` begin, from the first to the last."""
    starts = range(0, size, step)
    return list(starts) if len(starts) <= most else [starts[k * (len(starts) - 1) // (most - 1)] for k in range(most)]


def _kind(tokenizer_path: str) -> str:
    return "<u2" if _tokenizer(tokenizer_path)[0].get_vocab_size() <= 1 << 16 else "<u4"


def write_shards(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 2,
    shards: int | None = None,
    shard_bytes: int = 64 << 20,
    sample_docs: int = 512,
    dictionary_bytes: int = 64 << 10,
) -> tuple[DataFrame, str]:
    """Encode whole texts and write them in ascending id order; returns the shard table and the folder.

    Null texts count as empty (the end id alone), null ids sort first, rows that
    repeat an id are all written, other columns are ignored, and an empty table
    gives no shard. The shard table has ``shard, path, first_id, n_docs, n_ids,
    bytes``; its ids ascend with ``shard``. There are as many as ``spark.sql.shuffle.partitions``, or
    more for at most about ``shard_bytes`` of text in each. A file is named by shard and task attempt and the table names that of the
    attempt that came to its end, so a repeated task writes beside the files of others.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "token-ids")
    trained = train_dictionary(docs, tokenizer_path, end_id, id_col, text_col, sample_docs, dictionary_bytes)
    mark = hashlib.sha256(trained).hexdigest()
    fs, root = pafs.FileSystem.from_uri(folder)
    fs.create_dir(root)
    with fs.open_output_stream(f"{root}/{mark}.zdict") as out:
        out.write(trained)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        fs, root = pafs.FileSystem.from_uri(folder)
        kind = _kind(tokenizer_path)
        packer = zstandard.ZstdCompressor(level=_LEVEL, dict_data=_dictionary(trained))
        known, numbers, ends, counts = (array("q") for _ in range(4))
        at, part = 0, f"{root}/part-{shard:06d}-{TaskContext.get().taskAttemptId()}.ids"
        out = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                out = fs.open_output_stream(part)
                out.write(MAGIC + bytes.fromhex(mark) + kind.encode().ljust(8))
            known.extend(batch.column(0).is_valid().cast(pa.int64()).to_pylist())
            numbers.extend(batch.column(0).fill_null(0).to_pylist())
            for _, _, ids, to in encode_column(batch.column(1), tokenizer_path, end_id):
                ids = ids.astype(kind)
                frames = [packer.compress(ids[x:y].tobytes()) for x, y in zip(to[:-1].tolist(), to[1:].tolist())]
                ends.extend((at + np.cumsum([len(f) for f in frames])).tolist())
                at = ends[-1]
                counts.extend(np.diff(to).tolist())
                out.write(b"".join(frames))
        if out is None:
            return
        table = np.concatenate([[len(numbers)], known, numbers, ends, counts]).astype("<i8")
        index = zstandard.ZstdCompressor(level=3).compress(table.tobytes())
        out.write(index + struct.pack("<q", len(index)))
        out.close()
        row = [[shard], [part], [numbers[0] if known[0] else None], [len(numbers)], [int(sum(counts))], [at]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(row, [pa.int64(), pa.string(), *[pa.int64()] * 4])], _SHARD.names
        )

    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    n = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // shard_bytes))
    ordered = (
        arrow.in_small_batches(docs).select(F.col(id_col).cast("long"), F.coalesce(text_col, F.lit("")))
        .toDF("id", "text").repartitionByRange(n, "id").sortWithinPartitions("id")
    )
    return materialize(ordered.mapInArrow(write, _SHARD), "token-shards"), folder


_SHARD = T.StructType(
    [T.StructField("shard", T.LongType()), T.StructField("path", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in ("first_id", "n_docs", "n_ids", "bytes")]
)


def _dictionary(trained: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(trained, zstandard.DICT_TYPE_AUTO if trained else zstandard.DICT_TYPE_RAWCONTENT)


class Shard:
    """One shard file; ``ids(k)`` reads the k-th document by its own bytes alone."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        self.file = fs.open_input_file(path)
        size = self.file.size()
        head = self.file.read_at(48, 0)
        if head[:8] != MAGIC:
            raise ValueError(f"{path} is no token-id shard")
        self.dictionary, self.kind = head[8:40].hex(), head[40:48].decode().strip()
        (length,) = struct.unpack("<q", self.file.read_at(8, size - 8))
        table = np.frombuffer(zstandard.ZstdDecompressor().decompress(self.file.read_at(length, size - 8 - length)), "<i8")
        n = int(table[0])
        known, self.numbers, ends, self.counts = np.split(table[1:], 4)
        self.numbers = [int(v) if k else None for k, v in zip(known, self.numbers)]
        self.bounds = 48 + np.append(0, ends)
        assert len(self.numbers) == n
        with fs.open_input_stream(f"{path.rpartition('/')[0]}/{self.dictionary}.zdict") as f:
            trained = f.read()
        if hashlib.sha256(trained).hexdigest() != self.dictionary:
            raise ValueError(f"the dictionary of {path} is damaged")
        self.unpacker = zstandard.ZstdDecompressor(dict_data=_dictionary(trained))

    def ids(self, k: int) -> np.ndarray:
        a, b = int(self.bounds[k]), int(self.bounds[k + 1])
        return self._open(self.file.read_at(b - a, a), k)

    def _open(self, frame: bytes, k: int) -> np.ndarray:
        raw = self.unpacker.decompress(frame, max_output_size=int(self.counts[k]) * np.dtype(self.kind).itemsize)
        return np.frombuffer(raw, self.kind)

    def runs(self, most_bytes: int = 4 << 20) -> Iterator[tuple[int, list[np.ndarray]]]:
        """All documents in order, read in runs of about ``most_bytes``."""
        k, n = 0, len(self.numbers)
        while k < n:
            to = max(k + 1, int(np.searchsorted(self.bounds, self.bounds[k] + most_bytes, "right")) - 1)
            raw, base = self.file.read_at(int(self.bounds[to] - self.bounds[k]), int(self.bounds[k])), int(self.bounds[k])
            cut = (self.bounds[k : to + 1] - base).tolist()
            yield k, [self._open(raw[cut[i] : cut[i + 1]], k + i) for i in range(to - k)]
            k = to


def read_shards(shards: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, shard, frame_bytes`` of each document, from the files.

    ``start`` counts the ids of all documents before it, over all shards. Only the
    shard table's counts, one row a shard, are summed on one task.
    """
    from pyspark.sql import Window

    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = shards.select("shard", "path", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("before"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for shard, path, before in zip(*(c.to_pylist() for c in batch.columns)):
                file = Shard(fs, path)
                start = before + np.cumsum(file.counts) - file.counts
                for k, run in file.runs():
                    to = k + len(run)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(file.numbers[k:to], pa.int64()),
                            pa.array(start[k:to], pa.int64()),
                            pa.array(file.counts[k:to], pa.int64()),
                            pa.array([zlib.crc32(ids.astype("<u4").tobytes()) for ids in run], pa.int64()),
                            pa.array([shard] * len(run), pa.int64()),
                            pa.array(np.diff(file.bounds[k : to + 1]), pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32", "shard", "frame_bytes"],
                    )

    n = max(1, int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long, shard long, frame_bytes long"
    return placed.repartition(n).mapInArrow(read, schema)


def op2_token_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return read_shards(*write_shards(docs, public_tokenizers.path("byte_bpe_50k.json")))
