"""Small helpers for reading Arrow text columns inside Python tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BATCH_ROWS = 1000


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, of which Python tasks get at most ``BATCH_ROWS`` rows at a time.

    Spark has one setting for this a session; it is lowered, never raised. Texts
    are far longer than the rows that its default of 10,000 was made for. Spark's own bound
    in bytes (``spark.sql.execution.arrow.maxBytesPerBatch``, 64 MB) holds beside it.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return df


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and its n+1 offsets into them; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return bytes_[ends[0] : ends[-1]], ends - ends[0]


def slices(column: pa.Array, most_bytes: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about ``most_bytes`` bytes: first row, end row, bytes, offsets.

    A row that is longer forms a run of its own; no text is ever cut.
    """
    data, ends = utf8(column)
    at, n = 0, len(ends) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + most_bytes, "right")) - 1)
        yield at, to, data[ends[at] : ends[to]], ends[at : to + 1] - ends[at]
        at = to
