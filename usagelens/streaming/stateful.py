"""Keyed stream state with timers (W3, W6): first launches and device sessions.

Both are ``transformWithState`` processors on the RocksDB state store, so state
lies on disk beside the executors, with its changelog in the shared checkpoint
folder, and a lost executor's state is restored from there.  Event-time timers
remove what the watermark has made final: state holds the devices of the horizon,
not all there ever were.

* :func:`first_launch_job` (W3): a device's state is its first launch by (day,
  id).  An older launch that arrives later changes it and comes out again as a
  candidate; the sink is the kept index (``operators.first_index``), which takes
  the smallest of all candidates and records which launch lost the flag.  After
  the timer a device may come out once more and changes nothing, as the index
  knows better.
* :func:`session_job` (W6): a device's state is its open sessions.  A session
  that grows comes out again under its key (product, device, start); one that is
  absorbed or gets an earlier start comes out with no launches, which removes it.
  :func:`latest_sessions` reads the newest state of every session.

Python runs per key here: PySpark offers keyed state in no other form.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from usagelens.operators.first_index import FirstLaunchIndex
from usagelens.streaming.jobs import LATE_HORIZON, _ntz, _start, read_latest, versioned_sink

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_EPOCH = dt.date(1970, 1, 1)
_FAR = 1 << 31


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed state needs the RocksDB store; queries started from now on use it."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def milliseconds(interval: str) -> int:
    """Length of an interval such as '7 days' or '30 seconds'."""
    number, unit = interval.split()
    return int(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")] * 1000


class FirstLaunches(StatefulProcessor):
    """State of a (product, device): day number and id of its first launch."""

    def __init__(self, horizon_ms: int, attributes: list[str]):
        self.horizon_ms, self.attributes = horizon_ms, attributes

    def init(self, handle) -> None:
        self.handle = handle
        self.first = handle.getValueState("first", "day long, launch_id long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        order = lambda r: ((r.d - _EPOCH).days, r.launch_id)
        best = min(rows, key=order)
        held = tuple(self.first.get()) if self.first.exists() else None
        if held is None or order(best) < held:
            self.first.update(order(best))
            if held is None:      # the first launch is final once no older day can arrive
                self.handle.registerTimer((order(best)[0] + 1) * 86_400_000 + self.horizon_ms)
            yield Row(product_id=key[0], device_id=key[1], d=best.d, launch_id=best.launch_id, **{a: best[a] for a in self.attributes})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.first.clear()
        return iter(())

    def close(self) -> None:
        pass


def first_launch_job(rows: DataFrame, index: FirstLaunchIndex, checkpoint: str, horizon: str = LATE_HORIZON,
                     trigger: str | None = None, available_now: bool = False) -> StreamingQuery:
    """Keep ``index`` up with a stream of launches (product_id, device_id, ts, d, launch_id, attributes).

    Rows later than the horizon are not in the stream's result; the increment
    job lands them (W2), and ``index.update`` takes them from there.
    """
    use_rocksdb(rows.sparkSession)
    schema = {f.name: f for f in rows.schema}
    names = ["product_id", "device_id", "d", "launch_id", *index.attributes]
    out = ", ".join(f"{c} {schema[c].dataType.simpleString()}" for c in names)
    keyed = rows.where("ts is not null").select(*names, "ts").withWatermark("ts", horizon).groupBy("product_id", "device_id")
    candidates = keyed.transformWithState(FirstLaunches(milliseconds(horizon), index.attributes), outputStructType=out,
                                          outputMode="Update", timeMode="EventTime")
    writer = candidates.writeStream.outputMode("update").option("checkpointLocation", checkpoint) \
        .foreachBatch(lambda batch, epoch: index.update(batch, epoch) and None)
    return _start(writer, trigger, available_now)


class Sessions(StatefulProcessor):
    """State of a (product, device): its open sessions as (start, last, launches), in microseconds."""

    def __init__(self, gap_ms: int, horizon_ms: int):
        self.gap_us, self.keep_us = gap_ms * 1000, (gap_ms + horizon_ms) * 1000

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "start long, last long, n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = [tuple(s) for s in self.open.get()] if self.open.exists() else []
        merged: list[list] = []
        for start, last, n in sorted(held + [(r.us, r.us, 1) for r in rows]):
            if merged and start - merged[-1][1] < self.gap_us:
                merged[-1][1:] = max(merged[-1][1], last), merged[-1][2] + n
            else:
                merged.append([start, last, n])
        now = {s[0]: tuple(s) for s in merged}
        self.open.put([now[k] for k in sorted(now)])
        self.handle.registerTimer((min(s[1] for s in merged) + self.keep_us) // 1000 + 1)
        was = {s[0]: s for s in held}
        for start in was.keys() - now.keys():            # absorbed by another session
            yield Row(product_id=key[0], device_id=key[1], start_us=start, last_us=was[start][1], launches=0)
        for start in now.keys() - {k for k in was if now.get(k) == was[k]}:
            yield Row(product_id=key[0], device_id=key[1], start_us=start, last_us=now[start][1], launches=now[start][2])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        edge = timerValues.getCurrentWatermarkInMs() * 1000 - self.keep_us
        left = [tuple(s) for s in self.open.get() if s[1] > edge] if self.open.exists() else []
        if left:
            self.open.put(left)
            self.handle.registerTimer((min(s[1] for s in left) + self.keep_us) // 1000 + 1)
        else:
            self.open.clear()
        return iter(())

    def close(self) -> None:
        pass


def session_job(rows: DataFrame, path: str, checkpoint: str, gap: str = "30 seconds", horizon: str = LATE_HORIZON,
                trigger: str | None = None, available_now: bool = False) -> StreamingQuery:
    """The sessions that each micro-batch changes, written under ``path/epoch=<id>``."""
    use_rocksdb(rows.sparkSession)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    keyed = rows.where("ts is not null").select("product_id", "device_id", "ts", F.unix_micros("ts").alias("us")) \
        .withWatermark("ts", horizon).groupBy("product_id", "device_id")
    out = f"product_id {kinds['product_id']}, device_id {kinds['device_id']}, start_us long, last_us long, launches long"
    changed = keyed.transformWithState(Sessions(milliseconds(gap), milliseconds(horizon)), outputStructType=out,
                                       outputMode="Update", timeMode="EventTime")
    return versioned_sink(changed, path, checkpoint, trigger, available_now)


def latest_sessions(spark: SparkSession, path: str, gap: str = "30 seconds") -> DataFrame:
    """product_id, device_id, session_start, session_end (last activity and gap), launches."""
    rows = read_latest(spark, path, ["product_id", "device_id", "start_us"]).where("launches > 0")
    end = F.col("last_us") + milliseconds(gap) * 1000
    return rows.select("product_id", "device_id", _ntz(F.timestamp_micros("start_us")).alias("session_start"),
                       _ntz(F.timestamp_micros(end)).alias("session_end"), "launches")
