"""Incremental runs as streams: new contents reach the store once, whatever is replayed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.operators import store


def stream_into_store(stream: DataFrame, content: str, store_path: str, checkpoint: str):
    """Writes each batch's contents that the store hasn't got; the query is returned started.

    Batches are anti-joined with the store and contents are keyed by their digest, so a batch that is
    replayed after a failure adds nothing.
    """

    def add(batch: DataFrame, _: int) -> None:
        store.write_contents(store.addressed(batch.select(content), content), store_path)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def bucket_counts(stream: DataFrame, ts: str, bucket: str, window: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Counts of a bucket in tumbling windows; rows that come later than `late` after a window are not counted."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, window).alias("w"), bucket).agg(F.count(F.lit(1)).alias("n")).select("w.start", "w.end", bucket, "n")
