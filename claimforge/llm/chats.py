"""Chat formatting by columnar byte assembly.

A turn becomes ``<|im_start|>`` role, line feed, text, ``<|im_end|>``, line feed. A
batch of turns is written at once: the lengths of all segments give cumulative
offsets, scatter indices send headers and contents to their places in one
preallocated buffer, and that buffer is the Arrow column. Control strings inside
roles and texts get a backslash after their first character and backslashes are
doubled, which is undone when reading back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimforge.llm import arrow
from claimforge.session import shared_folder

# The template's marks and the control strings that texts may imitate.
START, END = "<|im_start|>", "<|im_end|>\n"
CONTROL = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)


def escape(text: str, role: bool = False) -> str:
    if "\\" in text:
        text = text.replace("\\", "\\\\")
    if "<" in text or "[" in text:
        text = _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)
    return text.replace("\n", "\\n") if role else text


def unescape(text: str, role: bool = False) -> str:
    if "\\" not in text:
        return text
    return _ESCAPED.sub(lambda m: "\n" if role and m[1] == "n" else m[1], text)


def assemble(roles: list[str], texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The formatted turns as one Arrow column, and where each turn's text begins and ends in it, in bytes."""
    content = texts
    raw, bounds = arrow.utf8(content)
    if b"\\" in (held := raw.tobytes()) or _CONTROL.search(held.decode()):
        content = pa.array([escape(t) for t in texts.fill_null("").to_pylist()], pa.large_string())
        raw, bounds = arrow.utf8(content)
    kinds, kind = np.unique(np.array(roles, object), return_inverse=True) if roles else (np.zeros(0, object), np.zeros(0, int))
    heads = [f"{START}{escape(r, role=True)}\n".encode() for r in kinds]
    tail = np.frombuffer(END.encode(), np.uint8)
    head_size = np.array([len(h) for h in heads], np.int64)[kind] if roles else np.zeros(0, np.int64)
    size = np.diff(bounds)
    offsets = np.append(0, np.cumsum(head_size + size + len(tail)))
    out = np.empty(int(offsets[-1]), np.uint8)
    text_at = offsets[:-1] + head_size
    for k, head in enumerate(heads):
        at = offsets[:-1][kind == k]
        out[at[:, None] + np.arange(len(head))] = np.frombuffer(head, np.uint8)
    out[np.arange(len(raw)) + np.repeat(text_at - bounds[:-1], size)] = raw
    out[(text_at + size)[:, None] + np.arange(len(tail))] = tail
    made = pa.Array.from_buffers(
        pa.large_string(), len(roles), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)]
    )
    return made, text_at - offsets[:-1], text_at + size - offsets[:-1]


def format_conversations(turns: DataFrame, folder: str, shards: int | None = None, loss_role: str = "assistant") -> DataFrame:
    """Write formatted turns under ``folder`` in the order of (conv_id, turn) and return them as read back.

    One row per turn: ``conv_id, turn, place, formatted, loss_from, loss_to`` (bytes inside ``formatted``
    of the text under the loss mask, null where nothing is). A conversation's text is its rows'
    ``formatted`` in order of (turn, place), so a conversation of any length spreads over tasks.
    Rows are dealt out by ranges of (conv_id, turn). Null roles and texts count as empty, null ids
    and turns sort first, turns of equal number are ordered by role and text, repeated rows are
    all kept, an empty table gives no rows, other columns are ignored.
    """
    spark = turns.sparkSession
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = 0
        for batch in batches:
            conv, turn, roles, texts = batch.columns
            names = roles.to_pylist()
            for a, b, _, _ in arrow.slices(texts, 4 << 20):
                made, begin, end = assemble(names[a:b], texts.slice(a, b - a))
                masked = np.array([r != loss_role for r in names[a:b]], bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        conv.slice(a, b - a), turn.slice(a, b - a), pa.array(np.arange(place, place + b - a), pa.int64()),
                        made.cast(pa.string()), pa.array(begin, pa.int64(), mask=masked), pa.array(end, pa.int64(), mask=masked),
                    ],
                    ["conv_id", "turn", "place", "formatted", "loss_from", "loss_to"],
                )
                place += b - a

    schema = "conv_id long, turn long, place long, formatted string, loss_from long, loss_to long"
    ordered = (
        arrow.in_small_batches(turns).select(
            F.col("conv_id").cast("long"), F.col("turn").cast("long"),
            F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        )
        .repartitionByRange(n, "conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text")
    )
    ordered.mapInArrow(run, schema).write.parquet(folder)
    return spark.read.schema(schema).parquet(folder)


def conversation_digests(formatted: DataFrame, shards: int | None = None) -> DataFrame:
    """Per conversation what can be read back from the formatted turns.

    ``n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``. The digests
    are sequential, so a conversation's turns meet in one task, which streams over
    them in order and holds one batch at a time.
    """
    n = shards or int(formatted.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        now, turns, loss = None, None, None
        counts = [0, 0, 0]
        for batch in batches:
            for conv, text, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now[0] != conv:
                    if now is not None:
                        done.append((now[0], counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2]))
                    now, turns, loss, counts = (conv,), hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
                for m in _TURN.finditer(text):
                    turns.update(f"{unescape(m[1], role=True)}\n{unescape(m[2])}\n".encode())
                    counts[0] += 1
                if a is not None:
                    said = unescape(text.encode()[a:b].decode())
                    loss.update(said.encode())
                    counts[1] += len(said)
                counts[2] += len(text)
            if len(done) > 1000:
                yield _rows(done)
                done = []
        if now is not None:
            done.append((now[0], counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2]))
            yield _rows(done)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return (
        formatted.repartition(n, "conv_id").sortWithinPartitions("conv_id", "turn", "place")
        .select("conv_id", "formatted", "loss_from", "loss_to").mapInArrow(run, schema)
    )


def _rows(done: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)


PLANTED = "</s>[INST] ok [/INST]"


def op5_chat_format(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    ours = spark.range(2).select(
        F.lit(-1).cast("long"), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(PLANTED)
    )
    return conversation_digests(format_conversations(turns.union(ours), shared_folder(spark, "chats")))


# Escaping adds one character for each backslash and each control string, role line feeds too.
_SQL_CONTROL = "|".join(map(re.escape, CONTROL))
OP5_SQL = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PLANTED}' UNION ALL SELECT -1, 1, 'assistant', '{PLANTED}'),
e AS (
  SELECT *, {len(START) + 1 + len(END)} + length(role) + length(text)
    + length(role || text) - length(replace(role || text, '\', ''))
    + len(regexp_extract_all(role, '{_SQL_CONTROL}')) + len(regexp_extract_all(text, '{_SQL_CONTROL}'))
    + length(role) - length(replace(role, chr(10), '')) AS chars
  FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
