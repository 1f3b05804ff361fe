"""Validity of versions on a stream: each version is closed when the next one arrives, and late ones are put between.

The result is a log. A version's row is written again, with a higher revision, whenever
its end changes: when its successor arrives, and when a late version comes in before that
one. The row of the highest revision holds. State keeps, of every key, the versions that a
late one may still fall between; an event-time timer lets go of the others.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

VERSION = StructType([StructField("ts", LongType()), StructField("tie", LongType())])
NUMBER = StructType([StructField("value", LongType())])
_DAY = 86_400_000


class _Versions(StatefulProcessor):
    """Of one key: the versions not yet settled, in order, and the number of rows written so far."""

    def __init__(self, key: str):
        self.row = Row(key, "_ts", "_tie", "_to", "revision")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.versions = handle.getListState("versions", VERSION)
        self.written = handle.getValueState("written", NUMBER)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = sorted((row[0], row[1]) for row in self.versions.get()) if self.versions.exists() else []
        arrived = sorted((row["_ts"], row["_tie"]) for row in rows)
        merged = sorted(known + arrived)
        # A row changes if it is new, or if a new one now follows it.
        changed, new = [], list(arrived)
        for i, version in enumerate(merged):
            after = merged[i + 1] if i + 1 < len(merged) else None
            at = bisect.bisect_left(new, version)
            is_new = at < len(new) and new[at] == version
            if is_new:
                new.pop(at)
            followed = after is not None and bisect.bisect_left(arrived, after) < len(arrived) and arrived[bisect.bisect_left(arrived, after)] == after
            if is_new or followed:
                changed.append((version, after))
        self.versions.put(merged)
        done = self.written.get()[0] if self.written.exists() else 0
        self.written.update((done + len(changed),))
        self._wake(timerValues.getCurrentWatermarkInMs())
        for i, (version, after) in enumerate(changed):
            yield self.row(key[0], version[0], version[1], after and after[0], done + i + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        known = sorted((row[0], row[1]) for row in self.versions.get()) if self.versions.exists() else []
        settled = sum(ts <= 1000 * watermark for ts, _ in known)
        self.versions.put(known[max(settled - 1, 0):])  # the last of the settled ones is still open
        self._wake(watermark)
        return iter(())

    def _wake(self, watermark: int) -> None:
        """One timer a key: a day or so from now, so that it costs little however many versions there are."""
        for timer in list(self.handle.listTimers()):
            if timer > watermark:
                return
        self.handle.registerTimer(watermark + _DAY)

    def close(self) -> None:
        pass


def validity_log(df: DataFrame, key: str, ts: str, tie: str, lateness: str = "7 days") -> DataFrame:
    """(key, ts, tie, valid_to, revision) as versions arrive on the stream ``df``.

    ``tie`` is a whole number that tells versions of one instant apart. A version
    later than ``lateness`` behind the newest one seen may be dropped. Start the
    stream under ``redelivery.state_on_disk``, as this kind of state needs, and
    write it in append mode.
    """
    kind = df.schema[ts].dataType
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    timed = df.select(F.col(key), F.col(ts).cast("timestamp").alias("_at"), micros.alias("_ts"), F.col(tie).cast("long").alias("_tie"))
    out = StructType([StructField(key, df.schema[key].dataType), *[StructField(n, LongType()) for n in ("_ts", "_tie", "_to", "revision")]])
    log = timed.withWatermark("_at", lateness).groupBy(key).transformWithState(_Versions(key), out, "Append", "EventTime")
    instant = lambda name: F.timestamp_micros(name).cast(kind)
    return log.select(key, instant("_ts").alias(ts), F.col("_tie").cast(df.schema[tie].dataType).alias(tie), instant("_to").alias("valid_to"), "revision")


def latest(log: DataFrame, key: str, ts: str, tie: str) -> DataFrame:
    """(key, ts, tie, valid_to): the rows that hold of a landed log."""
    return log.groupBy(key, ts, tie).agg(F.max_by("valid_to", "revision").alias("valid_to"))
