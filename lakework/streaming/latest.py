"""Latest-wins as a stream: keyed state, late lines resolved against it."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

#: Keyed state with timers needs this store.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _reduced(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of each Arrow batch's rows the last of each key; a hot key is one row a batch before it is shuffled."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table.take(pc.sort_indices(table, [(o, "ascending") for o in order], null_placement="at_start"))
            rest = [(c, "last", pc.ScalarAggregateOptions(skip_nulls=False, min_count=0)) for c in names if c not in key]
            last = pa.TableGroupBy(table, list(key), use_threads=False).aggregate(rest)
            last = last.rename_columns([c.removesuffix("_last") if c not in key else c for c in last.column_names])
            yield from last.select(names).cast(batch.schema).combine_chunks().to_batches()

    return rows.mapInArrow(run, rows.schema)


class Latest(StatefulProcessor):
    """One key's winner; a timer forgets it."""

    def __init__(self, kept: T.StructType, key: Sequence[str], order: Sequence[str], at: str | None, wait_ms: int | None):
        self.kept, self.key, self.order, self.at, self.wait_ms = kept, list(key), list(order), at, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.best = handle, handle.getValueState("best", self.kept)

    def rank(self, row: dict[str, Any]) -> tuple:
        return tuple((row[o] is not None, row[o]) if row[o] is not None else (False,) for o in self.order)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:  # noqa: N802, N803
        held = self.best.get() if self.best.exists() else None
        before = best = dict(zip(self.kept.names, held, strict=True)) if held is not None else None
        for row in rows:
            new = {c: row[c] for c in self.kept.names}
            if best is None or self.rank(new) > self.rank(best):
                best = new
        if best is before:
            return
        self.best.update(tuple(best[c] for c in self.kept.names))
        if self.wait_ms is not None and best[self.at] is not None:
            for timer in self.handle.listTimers():
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(max(best[self.at] // 1000 + self.wait_ms, timerValues.getCurrentWatermarkInMs() + 1))
        yield Row(**dict(zip(self.key, key, strict=True)), **best)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:  # noqa: N802, N803
        self.best.clear()
        return iter([])

    def close(self) -> None:
        pass


def latest_stream(stream: DataFrame, key: Sequence[str], order: Sequence[str], values: Sequence[str] = (), at: str | None = None, late: str = "1 hour", forget_ms: int | None = None) -> DataFrame:
    """The row of greatest ``order`` per key, as it changes: in update mode a row for each key whose winner changed.

    A line may come in any order and in any batch: it wins only if its order is greater than
    the state's (nulls are least), so all orders of arrival end with the same rows as the batch's
    ``versions.latest``.  The state is one row per key, checkpointed by Spark.  Order columns aren't among the key's.

    ``forget_ms``: with the event time ``at``, a key's state goes when the watermark (``late`` behind
    the newest event) is that much past its winner; a line that comes after that counts as new.
    """
    rows = _reduced(stream.select(*dict.fromkeys([*key, *order, *values, *([at] if at else [])])), key, order)
    timed = at is not None and forget_ms is not None
    # times are microseconds inside, which compare alike however Python reads a session's zone
    times = [f.name for f in rows.schema if f.name not in key and f.dataType == T.TimestampType()]
    if timed:
        rows = rows.withColumn("_event_time", F.col(at)).withWatermark("_event_time", late)
    rows = rows.withColumns({c: F.unix_micros(c) for c in times})
    kept = T.StructType([f for f in rows.schema if f.name not in (*key, "_event_time")])
    output = T.StructType([*(rows.schema[k] for k in key), *kept])
    stream.sparkSession.conf.set(*STATE_STORE)
    found = rows.groupBy(*key).transformWithState(Latest(kept, key, order, at, forget_ms if timed else None), output, "Update", "EventTime" if timed else "None")
    return found.withColumns({c: F.timestamp_micros(c) for c in times})


def keep_latest(changes: DataFrame, table: str, checkpoint: str, key: Sequence[str], order: Sequence[str]) -> StreamingQuery:
    """Write a latest-wins stream to a Parquet table that has each key's winner.

    A batch that is repeated after a failure changes nothing: a row only replaces one of lower order.
    """
    from lakework.operators.versions import latest
    from lakework.sources.lake import exists, write_table

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        rows = batch.unionByName(spark.read.parquet(table)) if exists(spark, table) else batch
        write_table(latest(rows, key, list(order)), table)

    return changes.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
