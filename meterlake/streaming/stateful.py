"""Stateful stream operators. A watermark bounds the state of all but ``latest_stream``, which keeps one row per meter for good (``latest_with_ttl`` lets idle meters go); all state is keyed and spread."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery, StreamingQueryListener

from meterlake import schemas
from meterlake.functions import STREAM_SEPARATOR, event_rules, exact, rejection_reason
from meterlake.operators.cleaning import REASON, parse_events, reject_events
from meterlake.sources.sinks import replace_buckets


def typed_event_stream(envelopes: DataFrame) -> DataFrame:
    """Events with typed times from a stream of envelopes (stateless, so usable before any watermark)."""
    parsed = _worked_out(parse_events(envelopes).select(*_typed(), "is_malformed"))
    return parsed.where(~F.col("is_malformed")).drop("is_malformed")


def _worked_out(df: DataFrame) -> DataFrame:
    """The same rows, with columns that are worked out once for each.

    A filter above a plain projection is moved below it, and there each use of a field in the filter parses the text again: with the rules, nineteen times for each event.
    A generator of one row is not passed by filters on what it makes.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def _judged(envelopes: DataFrame, regions: Sequence[str]) -> DataFrame:
    return parse_events(envelopes).withColumn(REASON, rejection_reason(event_rules(regions), STREAM_SEPARATOR))


def _typed() -> list:
    return [
        "event_id", "meter_id", "customer_id", "region_name", F.col("event_ts").alias("event_timestamp"), "kwh",
        "voltage", "event_type", F.coalesce("source_system", "bronze_source_system").alias("source_system"),
        F.col("producer_ts").alias("producer_timestamp"), "ingestion_timestamp",
    ]


def valid_event_stream(envelopes: DataFrame, regions: Sequence[str] = schemas.REGIONS) -> DataFrame:
    """Typed events that pass the rules of the micro-batch pipeline, repeats included; ``invalid_event_stream`` has the others."""
    judged = _worked_out(_judged(envelopes, regions).select(*_typed(), REASON))
    return judged.where(F.col(REASON) == "").drop(REASON)


def invalid_event_stream(envelopes: DataFrame, regions: Sequence[str] = schemas.REGIONS, as_of: str | None = None) -> DataFrame:
    """Dead-letter records of the events ``valid_event_stream`` leaves out."""
    judged = _worked_out(_judged(envelopes, regions).select("raw_event_payload", "source_system", "bronze_source_system", REASON))
    return reject_events(judged.where(F.col(REASON) != ""), as_of=as_of)


def dedup_events(stream: DataFrame, delay: str, ts: str = "event_timestamp", key: str = "event_id") -> DataFrame:
    """Drop repeats of an id over all micro-batches; ids older than the watermark leave the state.

    Repeats are dropped per input split first, then over all: an id sent over and over reaches
    the second step at most once per split, so no task has to take all its copies.
    """
    split = "__split"
    per_split = stream.withColumn(split, F.spark_partition_id()).withWatermark(ts, delay).dropDuplicatesWithinWatermark([key, split])
    return per_split.dropDuplicatesWithinWatermark([key]).drop(split)


def hourly_stream(stream: DataFrame, delay: str | None, ts: str = "event_timestamp", width: str = "1 hour") -> DataFrame:
    """Closed hours per region, heartbeats left out: total, events, exact distinct meters.

    Two chained aggregations: per meter, then per region. The distinct count is a row count of the first, so no
    state row ever holds a set of meters. Append mode: an hour is emitted once its end passes the watermark.
    ``delay`` is None where the stream has its watermark already (after ``dedup_events``).
    """
    readings = stream.where(F.col("event_type") != "heartbeat")
    per_meter = (
        (readings if delay is None else readings.withWatermark(ts, delay))
        .groupBy(F.window(ts, width).alias("w"), "region_name", "meter_id")
        .agg(F.sum(exact("kwh")).alias("__sum"), F.count("*").alias("__rows"))
    )
    return per_meter.groupBy(F.window(F.window_time("w"), width).alias("w"), "region_name").agg(
        F.sum("__sum").cast("decimal(18,4)").cast("double").alias("total_kwh"),
        F.sum("__rows").alias("event_count"),
        F.count("meter_id").alias("unique_meter_count"),
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
             "region_name", "total_kwh", "event_count", "unique_meter_count")


def latest_stream(stream: DataFrame, ts: str = "event_timestamp", key: str = "meter_id", tie_break: str = "event_id") -> DataFrame:
    """Latest reading per meter as keyed state: one row per meter (update or complete mode)."""
    readings = stream.where(F.col("event_type") != "heartbeat")
    row = F.struct(*[c for c in readings.columns if c != key])
    return readings.groupBy(key).agg(F.max_by(row, F.struct(ts, tie_break)).alias("r")).select(key, "r.*")


class _Latest(StatefulProcessor):
    """Keeps a meter's latest row until the watermark is ``ttl_ms`` past it; the row that ends it is marked ``expired``."""

    def __init__(self, names: list[str], ttl_ms: int):
        self.names, self.ttl_ms = names, ttl_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.latest = handle.getValueState("latest", "at bigint, tie string, row string")

    def _row(self, key, row: str, expired: bool) -> Row:
        return Row(meter_id=key[0], row=row, expired=expired)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        best = before = self.latest.get() if self.latest.exists() else None
        for r in rows:
            if best is None or (r["at"], r["tie"]) > best[:2]:
                best = (r["at"], r["tie"], r["row"])
        if best == before:
            return
        # a meter without a row has no timer; each call crosses to the JVM, and listing timers is the slowest of them
        for timer in [] if before is None else list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(best[0] + self.ttl_ms)
        self.latest.update(best)
        yield self._row(key, best[2], False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        row = self.latest.get()[2]
        self.latest.clear()
        yield self._row(key, row, True)


def latest_with_ttl(stream: DataFrame, delay: str, ttl_seconds: int, ts: str = "event_timestamp", key: str = "meter_id", tie_break: str = "event_id") -> DataFrame:
    """Changes of the latest reading per meter: its columns and ``expired``. State is one row per meter heard of within ``ttl_seconds`` of event time.

    Update mode; the state store has to be RocksDB, which keeps it off the heap. A row is put out when a meter's latest reading changes, and once more, with ``expired`` true, when the watermark is ``ttl_seconds``
    past it and the meter leaves the state. A meter that comes back starts anew. Rows older than the watermark (``delay`` behind the newest) are late and not looked at.
    """
    readings = stream.where((F.col("event_type") != "heartbeat") & F.col(key).isNotNull()).withWatermark(ts, delay)
    kept = [c for c in readings.columns if c != key]
    packed = readings.select(
        F.col(key).alias("meter_id"), ts, F.unix_millis(ts).alias("at"), F.col(tie_break).cast("string").alias("tie"), F.to_json(F.struct(*kept), {"ignoreNullFields": "false"}).alias("row"))
    changes = packed.groupBy("meter_id").transformWithState(
        statefulProcessor=_Latest(kept, ttl_seconds * 1000), outputStructType="meter_id string, row string, expired boolean", outputMode="Update", timeMode="EventTime")
    fields = T.StructType([f for f in readings.schema if f.name != key])
    return changes.select(F.col("meter_id").alias(key), F.from_json("row", fields).alias("r"), "expired").select(key, "r.*", "expired")


_ROCKSDB = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def keep_latest(
    stream: DataFrame, path: str, checkpoint: str, delay: str, ttl_seconds: int, buckets: int = 64, trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Keep the table of latest readings at ``path`` (``sinks.read_buckets``) up to date; by default until the input is used up.

    The state store's kind is a setting of the session that a query takes over when it starts; it is put back afterwards.
    """
    conf, (name, rocksdb) = stream.sparkSession.conf, _ROCKSDB
    before = conf.get(name)
    conf.set(name, rocksdb)
    try:
        query = (
            latest_with_ttl(stream, delay, ttl_seconds).writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))
            .foreachBatch(lambda df, n: replace_buckets(df, path, ["meter_id"], buckets, gone="expired")).start()
        )
    finally:
        conf.set(name, before)
    if trigger is None:
        query.awaitTermination()
    return query


def to_table(stream: DataFrame, path: str, checkpoint: str, trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Append a stateful stream to Parquet and, by default, wait until the input is used up."""
    query = (
        stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start(path)
    )
    if trigger is None:
        query.awaitTermination()
    return query


class LateRows(StreamingQueryListener):
    """Counts the rows stateful operators refuse as too late, for every query from the time it is added on.

    ``spark.streams.addListener(late)`` before the query starts; ``late.dropped[str(query.id)]`` afterwards. A listener sees every progress
    report, while the query itself remembers the last hundred only.
    """

    def __init__(self):
        self.dropped: Counter[str] = Counter()

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        self.dropped[str(event.progress.id)] += sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
