"""A journal followed as a stream: the last line of every key is state, so a restart goes on where it stopped and replays nothing."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

#: State lies in RocksDB, which spills to disk and puts snapshots into the query's checkpoint.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LastLine(StatefulProcessor):
    """Keeps the line of the highest order of every key, of equal ones the one that came last; a key of which nothing was heard for so long expires."""

    def __init__(self, schema: T.StructType, order: str, keep_ms: int | None):
        self._schema, self._order, self._keep_ms = schema, order, keep_ms

    def init(self, handle) -> None:
        self._handle, self._last = handle, handle.getValueState("last", self._schema)

    def _told(self, line: tuple, stale: bool) -> Row:
        return Row(*[f.name for f in self._schema.fields], "stale")(*line, stale)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803  (the interface's names)
        place = self._schema.fieldNames().index(self._order)
        last = tuple(self._last.get()) if self._last.exists() else None
        before = last
        for row in rows:
            line = tuple(row[f] for f in self._schema.fieldNames())
            if last is None or line[place] >= last[place]:
                last = line
        if self._keep_ms:
            for timer in list(self._handle.listTimers()):
                self._handle.deleteTimer(timer)
            self._handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self._keep_ms)
        if last != before:
            self._last.update(last)
            yield self._told(last, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        if self._last.exists():
            line = tuple(self._last.get())
            self._last.clear()
            yield self._told(line, True)

    def close(self) -> None:
        pass


def follow_journal(stream: DataFrame, key: str, order: str, keep_ms: int | None = None) -> DataFrame:
    """The changes of a journal's state as a stream: a line that became the last of its key, or with stale one whose key has expired.

    Lines without key or order, truncated ones among them, are left out. A line of a lower order than the known one changes nothing.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    lines = stream.filter(stream[key].isNotNull() & stream[order].isNotNull())
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in lines.schema.fields])
    out = T.StructType([*schema.fields, T.StructField("stale", T.BooleanType())])
    return lines.groupBy(key).transformWithState(LastLine(schema, order, keep_ms), out, "Update", "ProcessingTime" if keep_ms else "None")


def keep_current(stream: DataFrame, key: str, order: str, path: str, checkpoint: str, keep_ms: int | None = None):
    """Writes the changes below the path, a directory for each batch, so that a batch that is done again replaces its own; the query is returned started.

    Without expiry it ends once it has read what there is; with it, it looks for new lines and expired keys every second until it is stopped.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = follow_journal(stream, key, order, keep_ms).writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime="1 second") if keep_ms else writer.trigger(availableNow=True)).start()
