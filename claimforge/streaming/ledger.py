"""The ledger of known misses as keyed state of a stream, with a timer for each case."""

from __future__ import annotations

import datetime
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from claimforge.operators import keyed_store

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_ENTRY = "filed date, attempts int, last_date date"
_DAY = datetime.timedelta(days=1)


class _Ledger(StatefulProcessor):
    def __init__(self, days: int):
        self.days = days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entry = handle.getValueState("entry", _ENTRY)

    def _row(self, case: str, entry: tuple | None) -> pd.DataFrame:
        filed, attempts, last = entry or (None, None, None)
        return pd.DataFrame({"case_number": [case], "filed": [filed], "attempts": pd.array([attempts], "Int32"), "last_date": [last]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        misses = sorted(
            ((d.date(), None if pd.isna(f) else f) for part in rows for d, f in zip(part["missed_on"], part["filed"])), key=lambda m: (m[0], m[1] is None, m[1] or m[0])
        )
        entry = tuple(self.entry.get()) if self.entry.exists() else None
        reach, at = self.days * _DAY, None
        for day, filed in misses:
            if day == at:  # one attempt a day; the earliest filing date of the day counts
                continue
            at = day
            if entry and (entry[0] or entry[2]) < day - _DAY - reach:  # was dropped before this day
                entry = None
            if entry and entry[2] == day:
                continue
            entry = ((entry and entry[0]) or filed, (entry[1] if entry else 0) + 1, day)
            if (entry[0] or day) < day - reach:
                entry = None
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if entry:
            self.entry.update(entry)
            over = (entry[0] or entry[2]) + reach + _DAY
            self.handle.registerTimer(int(datetime.datetime(over.year, over.month, over.day, tzinfo=datetime.UTC).timestamp() * 1000))
        else:
            self.entry.clear()
        yield self._row(key[0], entry)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.entry.clear()
        yield self._row(key[0], None)

    def close(self) -> None:
        pass


def miss_stream(misses: DataFrame, days: int = 45, delay: str = "0 seconds") -> DataFrame:
    """Changes of the ledger by a stream of ``case_number, filed, missed_on`` (a timestamp, in UTC): the case's new entry, without attempts if it is gone.

    A case gains an attempt for each day on which it is missed. It is dropped ``days`` after it was filed or, if that is not known,
    last missed: by a timer when no more comes, or when what comes is later than that. A case's misses come in order of their days.
    """
    rows = misses.select("case_number", "filed", "missed_on").withWatermark("missed_on", delay)
    return rows.groupBy("case_number").transformWithStateInPandas(_Ledger(days), f"case_number string, {_ENTRY}", "Update", "EventTime")


def miss_ledger(misses: DataFrame, path: str, writer: str = "misses", days: int = 45) -> DataFrame:
    """The ledger after all that a stream of misses has now, in a keyed store under ``path``, which later calls go on with."""
    spark = misses.sparkSession
    shape = spark.createDataFrame([], f"case_number string, {_ENTRY}, batch long").schema

    def newest(rows: DataFrame) -> DataFrame:
        rest = [c for c in shape.names if c != "case_number"]
        return rows.groupBy("case_number").agg(F.max_by(F.struct(*rest), "batch").alias("r")).select("case_number", "r.*")

    def write(batch: DataFrame, number: int) -> None:
        keyed_store.merge(path, batch.withColumn("batch", F.lit(number).cast("long")), ["case_number"], newest, writer, number)

    had = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)  # the store that keyed state with timers needs; a query takes the setting when it starts
    try:
        query = (
            miss_stream(misses, days).writeStream.outputMode("update").option("checkpointLocation", f"{path}/progress/{writer}")
            .foreachBatch(write).trigger(availableNow=True).start()
        )
    finally:
        spark.conf.unset(_PROVIDER) if had is None else spark.conf.set(_PROVIDER, had)
    query.awaitTermination()
    return keyed_store.read(spark, path, shape).where("attempts IS NOT NULL").drop("batch")
