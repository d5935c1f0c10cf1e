"""Buffered micro-batch ingestion of raw payloads, for all four queues.

A landing folder of payload files (JSON text per row) is read as a stream,
validated and resolved with the same column expressions as the batch chain
(``operators.ingest``), and each micro-batch appends the good rows to the
kind's table partitioned by ingest day and the rejects to a reject table --
one ``foreachBatch`` every ``trigger`` (default 10 s).  Items without an app
key go to the rejects as ``-2``, as in the batch chain: good rows and rejects
add up to the input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from usagelens.operators import ingest as IN
from usagelens.streaming.jobs import DEFAULT_TRIGGER


def ingest_stream(raw_stream: DataFrame, parse: Callable[[DataFrame], DataFrame],
                  check: Callable[[DataFrame], tuple[DataFrame, DataFrame]], out_path: str,
                  reject_path: str, checkpoint: str, trigger: str = DEFAULT_TRIGGER,
                  available_now: bool = False) -> StreamingQuery:
    """Start the ingest of one queue (payload_id, payload, ingest_ts in) by the
    two steps of its batch chain: ``parse`` payloads -> fields, ``check`` them ->
    (good rows, rejects).  A replayed batch overwrites its own ``epoch`` folders."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        parsed = parse(batch).drop("payload").persist()     # read and parsed once for good rows and every kind of reject
        try:
            good, rejects = check(parsed)
            (good.withColumn("ingest_day", F.to_date("ingest_ts")).write.mode("overwrite")
             .partitionBy("ingest_day").parquet(f"{out_path}/epoch={epoch_id}"))
            rejects.write.mode("overwrite").parquet(f"{reject_path}/epoch={epoch_id}")
        finally:
            parsed.unpersist()

    w = raw_stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def ingest_launch_stream(raw_stream: DataFrame, registry: DataFrame, mccmnc: DataFrame, out_path: str,
                         reject_path: str, checkpoint: str, **options) -> StreamingQuery:
    """Launch queue."""
    return ingest_stream(raw_stream, IN.parse_launch, lambda p: IN.check_launch(p, registry, mccmnc), out_path, reject_path, checkpoint, **options)


def ingest_event_stream(raw_stream: DataFrame, registry: DataFrame, event_defs: DataFrame, out_path: str,
                        reject_path: str, checkpoint: str, **options) -> StreamingQuery:
    """Custom-event queue."""
    return ingest_stream(raw_stream, IN.parse_event, lambda p: IN.check_event(p, registry, event_defs), out_path, reject_path, checkpoint, **options)


def ingest_page_stream(raw_stream: DataFrame, registry: DataFrame, out_path: str, reject_path: str,
                       checkpoint: str, **options) -> StreamingQuery:
    """Page-view queue."""
    return ingest_stream(raw_stream, IN.parse_page_view, lambda p: IN.check_page(p, registry), out_path, reject_path, checkpoint, **options)


def ingest_crash_stream(raw_stream: DataFrame, registry: DataFrame, out_path: str, reject_path: str,
                        checkpoint: str, **options) -> StreamingQuery:
    """Crash queue."""
    return ingest_stream(raw_stream, IN.parse_crash, lambda p: IN.check_crash(p, registry), out_path, reject_path, checkpoint, **options)
