"""Log events as a stream.

A micro-batch is sorted by time within its partitions, long messages are cut to the sink's limit without halving a
character, and rows are numbered into batches of bounded bytes. A batch that is delivered twice (a retry after a lost
executor) is written once, as every batch has its own folder that is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from moothall.functions import codecs
from moothall.sources.shared import put_aside

# The sink's limits in bytes, what each event adds, and the milliseconds after which what waits is written.
EVENT, BATCH, EXTRA, WAIT = 240_000, 900_000, 26, 200


def events(lines: DataFrame, at: Column, message: Column) -> DataFrame:
    """(stream, timestamp in ms, message) of each line of each message; empty lines are left out."""
    rows = lines.select("stream", F.unix_millis(at.cast("timestamp")).alias("timestamp"), F.explode(F.split(message, "\r?\n")).alias("message"))
    return rows.where("message <> ''").withColumn("message", codecs.cut_bytes(F.col("message"), EVENT))


def batched(rows: DataFrame) -> DataFrame:
    """Events with the number of their batch within a stream: a batch ends before it has more than ``BATCH`` bytes, by
    running size over events in order of time."""
    order = Window.partitionBy("stream").orderBy("timestamp", "message")
    size = F.octet_length("message") + EXTRA
    return rows.withColumn("batch", F.floor((F.sum(size).over(order) - size) / (BATCH - EVENT - EXTRA)).cast("long"))


def write_batches(stream: DataFrame, path: str, checkpoint: str, every: str | None = None, order: str = "timestamp") -> StreamingQuery:
    """Write micro-batches, each sorted by time within its partitions; without ``every``, what there is, once."""

    def write(batch: DataFrame, number: int) -> None:
        batch.sortWithinPartitions(order).write.mode("overwrite").parquet(f"{path}/batch={number}")

    out = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (out.trigger(processingTime=every) if every else out.trigger(availableNow=True)).start()


def latest(stream: DataFrame, key: str, at: str, late: str = "24 hours") -> DataFrame:
    """The first row of each key within a span of event time: what a fresh run must not repeat."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def _placed(rows: DataFrame) -> DataFrame:
    """Rows with ``size`` and ``before``, the bytes of the stream's events before each in order of time. Sums run within
    range partitions, and over the partitions' totals, so no stream passes through one task."""
    ranged = rows.withColumn("size", (F.octet_length("message") + EXTRA).cast("long")).repartitionByRange("stream", "timestamp", "message")
    ranged = put_aside(ranged.withColumn("__part", F.spark_partition_id()))
    parts = ranged.groupBy("stream", "__part").agg(F.sum("size").alias("total"))
    earlier = F.sum("total").over(Window.partitionBy("stream").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("stream", "__part", F.coalesce(earlier, F.lit(0)).alias("earlier"))
    order = Window.partitionBy("stream", "__part").orderBy("timestamp", "message").rowsBetween(Window.unboundedPreceding, 0)
    placed = ranged.withColumn("within", F.sum("size").over(order) - F.col("size")).join(parts, ["stream", "__part"])
    return placed.withColumn("before", F.col("within") + F.col("earlier")).drop("within", "earlier", "__part")


def flushed(rows: DataFrame, limit: int = BATCH) -> DataFrame:
    """(stream, timestamp, message, size, batch): events by the batch that a writer puts them in who takes events in order of
    time and writes as soon as what waits has ``limit`` bytes or more.

    If a batch began at an event, the next one begins at the first event that has ``limit`` bytes or more between: this is looked
    up for every event among the events of its stretch of bytes and the next. Then batches' beginnings are followed by steps
    that double, as the chain of the first event's. No stretch has more events than its bytes hold."""
    placed = put_aside(_placed(rows))
    # stretches are as wide as the largest event at least, so of two in a row one has an event
    width = max(limit, placed.agg(F.max("size")).first()[0] or 0)
    stretch = lambda c: F.floor(c / F.lit(width)).cast("long")
    at = placed.select("stream", F.col("before").alias("at"))
    points = at.select("stream", "at", F.explode(F.array(stretch(F.col("at")) - 1, stretch(F.col("at")))).alias("b"), F.col("at").alias("value"), F.lit(1).alias("is_point"))
    asked = at.select("stream", "at", stretch(F.col("at") + limit).alias("b"), (F.col("at") + limit).alias("value"), F.lit(0).alias("is_point"))
    down = Window.partitionBy("stream", "b").orderBy(F.desc("value"), F.desc("is_point")).rowsBetween(Window.unboundedPreceding, 0)
    least = F.last(F.when(F.col("is_point") == 1, F.col("value")), ignorenulls=True).over(down)
    step = points.unionByName(asked).withColumn("to", least).where("is_point = 0 AND to IS NOT NULL").select("stream", "at", "to")
    step, m, known = put_aside(step), 1, 0
    met = put_aside(at.where("at = 0").withColumn("n", F.lit(0).cast("long")))
    while known < (count := met.count()):
        further = met.join(step, ["stream", "at"]).select("stream", F.col("to").alias("at"), (F.col("n") + m).alias("n"))
        met, m, known = put_aside(met.unionByName(further).distinct()), m * 2, count
        step = put_aside(step.join(step.select("stream", F.col("at").alias("to"), F.col("to").alias("further")), ["stream", "to"]).select("stream", "at", F.col("further").alias("to")))
    # a batch is shorter than its limit and its last event, so its beginning is at most two stretches back
    begins = met.select("stream", F.col("at").alias("before"), F.explode(F.array(*[stretch(F.col("at")) + i for i in range(3)])).alias("b"), F.col("n").alias("batch"))
    both = placed.withColumn("b", stretch(F.col("before"))).unionByName(begins, allowMissingColumns=True)
    up = Window.partitionBy("stream", "b").orderBy("before", F.col("batch").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("batch", F.last("batch", ignorenulls=True).over(up)).where("message IS NOT NULL").drop("b", "before")


class Flush(StatefulProcessor):
    """What waits of one stream, written when it has ``limit`` bytes or more, or ``wait`` milliseconds after its first event."""

    def __init__(self, limit: int = BATCH, wait: int = WAIT):
        self.limit, self.wait = limit, wait

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.events = handle.getListState("events", "timestamp long, message string")
        self.state = handle.getValueState("state", "bytes long, batch long, timer long")

    def out(self, key: tuple, events: list[tuple], batch: int) -> Iterator[Row]:
        for timestamp, message in sorted(events, key=lambda e: e[0]):
            yield Row(stream=key[0], batch=batch, timestamp=timestamp, message=message)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        size, batch, timer = self.state.get() or (0, 0, 0)
        events = [tuple(e) for e in self.events.get()] if size else []
        for r in rows:
            events.append((r["timestamp"], r["message"]))
            size += len(r["message"].encode()) + EXTRA
            if size >= self.limit:
                yield from self.out(key, events, batch)
                events, size, batch = [], 0, batch + 1
        if timer and not events:
            self.handle.deleteTimer(timer)
            timer = 0
        elif events and not timer:
            timer = timerValues.getCurrentProcessingTimeInMs() + self.wait
            self.handle.registerTimer(timer)
        if events:
            self.events.put(events)
        else:
            self.events.clear()
        self.state.update((size, batch, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        size, batch, _ = self.state.get() or (0, 0, 0)
        if size:
            yield from self.out(key, [tuple(e) for e in self.events.get()], batch)
            self.events.clear()
            self.state.update((0, batch + 1, 0))

    def close(self) -> None:
        pass


def flushes(stream: DataFrame, limit: int = BATCH, wait: int = WAIT) -> DataFrame:
    """Events (stream, timestamp, message) of a stream with the batch that each is written in; a stream's state is what
    waits, which is less than ``limit`` bytes. Needs the RocksDB state store."""
    made = "stream string, batch long, timestamp long, message string"
    return stream.groupBy("stream").transformWithState(Flush(limit, wait), made, "append", "processingTime")
