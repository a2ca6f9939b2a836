"""Grace hash deduplication over complete content.

Two levels use the same table. Inside each input split, rows are partitioned to
spill files by hash, again and again until a bucket fits, and an open-addressing
table that compares complete contents collapses equal ones; what leaves a split is
one record per distinct content, so a text that holds a third of all rows leaves
it once. These records are shuffled by hash and collapsed the same way. Members
find their group by (split, slot), never by content, so no join key is hot.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimforge.llm import arrow
from claimforge.session import materialize

# The white space that does not count.
WHITE_SPACE = b" \t\n\x0b\x0c\r"
_FANOUT_BITS = 4


class ContentTable:
    """Open addressing with linear probing; keys are compared byte by byte."""

    def __init__(self) -> None:
        self.slots = np.full(1024, -1, np.int64)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []

    def place(self, content: bytes, hash_: int) -> tuple[int, bool]:
        """The number of ``content``, and whether it is new."""
        mask = len(self.slots) - 1
        at = hash_ & mask
        while (k := int(self.slots[at])) >= 0:
            if self.hashes[k] == hash_ and self.contents[k] == content:
                return k, False
            at = (at + 1) & mask
        self.slots[at] = k = len(self.contents)
        self.hashes.append(hash_)
        self.contents.append(content)
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return k, True

    def _grow(self) -> None:
        mask = 2 * len(self.slots) - 1
        self.slots = np.full(mask + 1, -1, np.int64)
        for k, h in enumerate(self.hashes):
            at = h & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = k


def grace_groups(records: Iterator[tuple[bytes, bytes, tuple]], budget: int) -> Iterator[tuple[bytes, bytes, list[tuple]]]:
    """Group ``(digest, content, rest)`` by content: yields content's digest, content and all ``rest``.

    Contents in memory stay near ``budget`` bytes: beyond it, records go to spill
    files by the next bits of the digest, and each file is treated alike. A file
    whose records share all the bits used so far has copies of few contents, which
    the table holds once.
    """
    yield from _grace(records, budget, 0)


def _grace(records: Iterator[tuple[bytes, bytes, tuple]], budget: int, depth: int) -> Iterator[tuple[bytes, bytes, list]]:
    table, groups, digests, held = ContentTable(), [], [], 0
    files = None
    for digest, content, rest in records:
        if files is None:
            k, new = table.place(content, int.from_bytes(digest[-8:], "little"))
            if new:
                groups.append([])
                digests.append(digest)
                held += len(content) + 200
            groups[k].append(rest)
            held += 64
            if held > budget and depth < 60 and len(groups) > 1:
                files = [tempfile.TemporaryFile() for _ in range(1 << _FANOUT_BITS)]
                for k, members in enumerate(groups):
                    for r in members:
                        pickle.dump((digests[k], table.contents[k], r), files[_bucket(digests[k], depth)], 5)
                table, groups, digests = ContentTable(), [], []
        else:
            pickle.dump((digest, content, rest), files[_bucket(digest, depth)], 5)
    for k, members in enumerate(groups):
        yield digests[k], table.contents[k], members
    for f in files or ():
        f.seek(0)
        yield from _grace(_read(f), budget, depth + 1)
        f.close()


def _bucket(digest: bytes, depth: int) -> int:
    return digest[depth // 2] >> (_FANOUT_BITS * (depth % 2)) & 15


def _read(f) -> Iterator[tuple]:
    while True:
        try:
            yield pickle.load(f)
        except EOFError:
            return


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", task_budget: int = 32 << 20, shards: int | None = None
) -> DataFrame:
    """One row per input row: id, ``keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after deleting blanks, tabs, line feeds, vertical
    tabs, form feeds and carriage returns; null counts as empty. Of equal texts the row with
    the most code points in the original text stays, then the smallest id (null
    ids come last), then the first in input order, so of rows that repeat id and
    text exactly one is kept. Other columns are ignored; an empty table gives an
    empty result. ``task_budget`` bounds the bytes of contents a task holds at once.
    """
    spark = docs.sparkSession

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        split = TaskContext.get().partitionId()

        def records() -> Iterator[tuple[bytes, bytes, tuple]]:
            n = 0
            for batch in batches:
                for number, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    content = text.encode().translate(None, WHITE_SPACE)
                    yield hashlib.sha256(content).digest(), content, (number, len(text), n)
                    n += 1

        def row(slot: int, group: tuple) -> tuple:
            digest, content, members = group
            number, size, place = min(members, key=_rank)
            return split, slot, digest, content, [m[0] for m in members], [m[2] for m in members], number, size, place

        yield from _batches((row(*g) for g in enumerate(grace_groups(records(), task_budget))), _LOCAL)

    source = arrow.in_small_batches(docs).select(F.col(id_col).cast("long"), F.coalesce(text_col, F.lit("")))
    found = materialize(source.mapInArrow(local, _LOCAL_SQL), "exact-local")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[tuple[bytes, bytes, tuple]]:
            for batch in batches:
                for r in zip(*(c.to_pylist() for c in batch.columns)):
                    yield r[2], r[3], (r[0], r[1], *r[4:])

        def rows() -> Iterator[tuple]:
            for digest, _, members in grace_groups(records(), task_budget):
                best = min(members, key=lambda m: (*_rank(m[2:4]), m[0], m[4]))
                size = sum(m[5] for m in members)
                for m in members:
                    yield m[0], m[1], digest.hex(), best[2], size, m[0] == best[0] and m[1] == best[1], best[4]

        yield from _batches(rows(), _MERGED)

    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    merged = (
        found.select("split", "slot", "digest", "content", "number", "size", "place", F.size("ids").cast("long").alias("n"))
        .repartition(n, "digest").mapInArrow(merge, _MERGED_SQL)
    )
    members = found.select("split", "slot", F.explode(F.arrays_zip("ids", "places")).alias("m"))
    return members.join(merged, ["split", "slot"]).select(
        F.col("m.ids").alias(id_col),
        "keep_id",
        "group_size",
        (F.col("holds") & (F.col("m.places") == F.col("best_place"))).alias("kept"),
        "text_sha256",
    )


def _rank(member: tuple) -> tuple:
    number, size = member[0], member[1]
    return (-size, number is None, number or 0, *member[2:])


_LOCAL = pa.schema([
    ("split", pa.int32()), ("slot", pa.int32()), ("digest", pa.binary()), ("content", pa.binary()), ("ids", pa.list_(pa.int64())),
    ("places", pa.list_(pa.int64())), ("number", pa.int64()), ("size", pa.int64()), ("place", pa.int64()),
])
_LOCAL_SQL = "split int, slot int, digest binary, content binary, ids array<long>, places array<long>, number long, size long, place long"
_MERGED = pa.schema([
    ("split", pa.int32()), ("slot", pa.int32()), ("text_sha256", pa.string()), ("keep_id", pa.int64()),
    ("group_size", pa.int64()), ("holds", pa.bool_()), ("best_place", pa.int64()),
])
_MERGED_SQL = "split int, slot int, text_sha256 string, keep_id long, group_size long, holds boolean, best_place long"


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 512, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows in batches of at most ``most``, and of about ``most_bytes`` of binary values; one row may be larger."""
    held: list[tuple] = []
    size, binary = 0, [k for k, f in enumerate(schema) if pa.types.is_binary(f.type)]
    for row in rows:
        held.append(row)
        size += sum(len(row[k]) for k in binary)
        if len(held) >= most or size >= most_bytes:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def op4_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS size,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents),
g AS (
  SELECT doc_id, sha256(norm) AS text_sha256,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY size DESC, doc_id ASC NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size,
         row_number() OVER (PARTITION BY norm ORDER BY size DESC, doc_id ASC NULLS LAST) AS place
  FROM d)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM g
"""
