"""Sinks: keyed records, idempotent per-batch writes, run-to-completion helper."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener


def keyed_records(df: DataFrame, key: str, value: Sequence[str] | str) -> DataFrame:
    """``(key string, value string)`` records: a scalar value as text, several as JSON."""
    if isinstance(value, str):
        v = F.col(value).cast("string")
    else:
        v = F.to_json(F.struct(*value))
    return df.select(F.col(key).cast("string").alias("key"), v.alias("value"))


def write_each_batch(outputs: dict[str, tuple[Callable[[DataFrame], DataFrame], str]]):
    """``foreachBatch`` writer sending each micro-batch to several outputs.

    ``outputs`` maps a name to (transform, path). Every batch is written to
    ``<path>/batch=<id>`` with overwrite, so a batch replayed after a failure
    replaces its own earlier attempt instead of duplicating it.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for fn, path in outputs.values():
                fn(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        finally:
            batch.unpersist()
    return write


class Progress(StreamingQueryListener):
    """Adds up, per stream, what its micro-batches observed: ``totals[name][metric]`` and ``batches``.

    Register with ``spark.streams.addListener``; a running stream then shows its
    counts as they grow, where an eager count would read the stream again.
    """

    def __init__(self):
        self.totals: dict[str, dict[str, int]] = {}
        self.batches = 0

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self.batches += 1
        for name, row in event.progress.observedMetrics.items():
            known = self.totals.setdefault(name, {})
            for metric, value in row.asDict().items():
                known[metric] = known.get(metric, 0) + (value or 0)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def run_available_now(df: DataFrame, *, checkpoint: str, path: str | None = None,
                      mode: str = "append", fmt: str = "parquet",
                      foreach_batch=None, timeout_s: float | None = None) -> StreamingQuery:
    """Process everything available, then stop (``trigger(availableNow=True)``)."""
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(fmt).option("path", path)
    q = w.trigger(availableNow=True).start()
    q.awaitTermination(timeout_s)
    if q.exception() is not None:
        raise q.exception()
    return q


def start_every(df: DataFrame, *, checkpoint: str, path: str | None = None,
                interval: str = "10 seconds", mode: str = "append", fmt: str = "parquet",
                foreach_batch=None) -> StreamingQuery:
    """Run continuously with a micro-batch every ``interval`` (the commit interval).

    Output rows are emitted per micro-batch, not per record; per-record
    changelogs come from the state functions, which emit one row per input.
    """
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(fmt).option("path", path)
    return w.trigger(processingTime=interval).start()
