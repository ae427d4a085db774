"""Streaming forms of the batch operators.

Each takes a streaming raw log ``(ts_kafka, message[, seq])``. Event time is the
capture time of a message; results close when the watermark passes them.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tarmac.functions.fixed_values import UNINFORMATIVE_LABELS
from tarmac.operators.decode import decode, split_rejects, valid_allcall, valid_frames
from tarmac.operators.takeoffs import with_runway
from tarmac.operators.windows import THRESHOLD_MS, grid_states
from tarmac.session import MINUTE_MS, shared_dir

DELAY = "10 minutes"
#: Waiting rows of an aircraft are kept and played by pieces of time this long.
BUCKET_MS = 60 * MINUTE_MS
_ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def decoded_stream(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid frames, rejects), both in append mode."""
    decoded = decode(raw)
    return valid_frames(decoded), split_rejects(decoded)[1]


def without_repeats(raw: DataFrame, gap: str = "5 seconds", delay: str = DELAY) -> DataFrame:
    """Valid frames with copies of the same message less than ``gap`` apart merged into the first.

    A session per (aircraft, message) gives the same rows however the input is cut
    into triggers, and repeats of a message at other times are kept.
    """
    rows = valid_frames(decode(raw)).withColumn("at", F.timestamp_millis("ts_kafka")).withWatermark("at", delay)
    order = F.struct("ts_kafka", "seq")
    copies = rows.groupBy("icao", "message", F.session_window("at", gap)).agg(
        F.min(order).alias("first"), F.count("*").alias("n_copies")
    )
    return copies.select("icao", "first.ts_kafka", "first.seq", "message", "n_copies")


def window_states_stream(
    raw: DataFrame, window_ms: int = THRESHOLD_MS, slide_ms: int | None = None
) -> DataFrame:
    """Last state per aircraft and clock window, tumbling or sliding."""
    states = grid_states(decode(raw), window_ms, slide_ms)
    return states.select(F.unix_millis("window.start").alias("window_ms"), *states.columns).drop("window")


def occupancy_stream(raw: DataFrame, delay: str = DELAY) -> DataFrame:
    """Distinct aircraft per hour and ground state.

    Repeats are dropped first; an aircraft is then one row per hour, and the
    count is exact with state bounded by the open hours.
    """
    rows = valid_allcall(decode(raw)).withColumn("at", F.timestamp_millis("ts_kafka")).withWatermark("at", delay)
    per_aircraft = rows.groupBy(F.window("at", "1 hour"), "icao", "on_ground").agg(F.count("*").alias("replies"))
    hours = per_aircraft.groupBy(F.window("window", "1 hour").alias("hour_window"), "on_ground")
    return hours.agg(F.count("*").alias("n")).select(
        F.unix_millis("hour_window.start").alias("hour_ms"), "on_ground", "n"
    )


def contact_sessions(raw: DataFrame, gap: str = "10 minutes", delay: str = DELAY) -> DataFrame:
    """Stretches of contact with an aircraft without a pause of ``gap``."""
    rows = valid_frames(decode(raw)).withColumn("at", F.timestamp_millis("ts_kafka")).withWatermark("at", delay)
    sessions = rows.groupBy("icao", F.session_window("at", gap).alias("contact")).agg(F.count("*").alias("n_messages"))
    return sessions.select(
        "icao",
        F.unix_millis("contact.start").alias("start_ms"),
        F.unix_millis("contact.end").alias("end_ms"),
        "n_messages",
    )


_SIGNAL = ["ts_kafka", "seq", "stopped", "reply", "kind", "lat", "lon"]
_EVENT = (
    "icao string, seq bigint, last_stopped_ms bigint, takeoff_ms bigint, wait_ms bigint, wait_s double, "
    "aircraft_type string, lat double, lon double"
)
_KNOWN = "stop_ms bigint, kind string, lat double, lon double"


def _advance(icao: str, known: dict, rows: pd.DataFrame) -> pd.DataFrame:
    """Take-offs among one aircraft's rows in time order; ``known`` is brought up to date.

    A reply closes the last stop since the reply before it, so stops are carried
    forward inside the stretches between replies.
    """
    rows = rows.sort_values(["ts_kafka", "seq"], ignore_index=True)
    # what is known stands before the rows, as one more
    first = {"ts_kafka": known["stop_ms"], "stopped": known["stop_ms"] is not None, "reply": False} | known
    kinds = {"ts_kafka": "Int64", "stopped": "bool", "reply": "bool", "kind": "string", "lat": "Float64", "lon": "Float64"}
    line = pd.DataFrame({c: pd.array([first[c], *rows[c]], dtype=kinds[c]) for c in kinds})
    leg = line["reply"].cumsum() - line["reply"]
    stop = line["ts_kafka"].where(line["stopped"]).groupby(leg).ffill()
    whole = line["lat"].notna() & line["lon"].notna()
    kind, lat, lon = line["kind"].ffill(), line["lat"].where(whole).ffill(), line["lon"].where(whole).ffill()
    left = (line["reply"] & stop.notna()).iloc[1:].to_numpy()
    closed, leaving = stop.iloc[1:][left].to_numpy("int64"), rows["ts_kafka"][left].to_numpy("int64")
    events = pd.DataFrame({"icao": icao, "seq": rows["seq"][left].to_numpy("int64"), "last_stopped_ms": closed, "takeoff_ms": leaving})
    events = events.assign(wait_ms=leaving - closed, wait_s=(leaving - closed) / 1000.0)
    events = events.assign(**{n: c.iloc[1:][left].to_numpy() for n, c in (("aircraft_type", kind.astype(object)), ("lat", lat.astype("float64")), ("lon", lon.astype("float64")))})
    open_stop = None if line["reply"].iloc[-1] else stop.iloc[-1]
    known["stop_ms"] = None if pd.isna(open_stop) else int(open_stop)
    known["kind"] = None if pd.isna(kind.iloc[-1]) else kind.iloc[-1]
    known["lat"], known["lon"] = (None if pd.isna(c.iloc[-1]) else float(c.iloc[-1]) for c in (lat, lon))
    return events


def _packed(rows: pd.DataFrame) -> bytes:
    batch = pa.RecordBatch.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


class TakeoffProcessor(StatefulProcessor):
    """Holds an aircraft's rows until the watermark passes them, then plays them in time order.

    The state is what is known of the aircraft, and its waiting rows in buckets of ``BUCKET_MS``, a
    packed part for each Arrow batch that brought some. A timer stands at the first time of every part; as
    timers come in time order, a task holds one bucket of one aircraft, however much a trigger
    brought. Rows behind the watermark are late and never get here.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", _KNOWN)
        self.waiting = handle.getMapState("waiting", "bucket bigint, part int", "rows binary")

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues: object) -> None:
        row = initialState.iloc[0]
        self.known.update(tuple(None if pd.isna(row[c]) else row[c].item() if hasattr(row[c], "item") else row[c] for c in ("stop_ms", "kind", "lat", "lon")))

    def _add(self, bucket: int, rows: pd.DataFrame) -> None:
        part = 0
        while self.waiting.containsKey((bucket, part)):
            part += 1
        self.waiting.updateValue((bucket, part), (_packed(rows),))
        self.handle.registerTimer(int(rows["ts_kafka"].min()))

    def _take(self, bucket: int) -> pd.DataFrame | None:
        parts = []
        while self.waiting.containsKey((bucket, len(parts))):
            parts.append(pa.ipc.open_stream(self.waiting.getValue((bucket, len(parts)))[0]).read_pandas())
        for part in range(len(parts)):
            self.waiting.removeKey((bucket, part))
        return pd.concat(parts) if parts else None

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        for batch in rows:
            for bucket, part in batch[_SIGNAL].groupby(batch["ts_kafka"] // BUCKET_MS):
                self._add(int(bucket), part)
        return iter([])

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
        bucket = expiredTimerInfo.getExpiryTimeInMs() // BUCKET_MS
        rows = self._take(bucket)
        if rows is None:  # an earlier timer of the bucket has played them
            return
        due = rows["ts_kafka"] <= timerValues.getCurrentWatermarkInMs()
        if not due.all():
            self._add(bucket, rows[~due])
        if due.any():
            names = ("stop_ms", "kind", "lat", "lon")
            known = dict(zip(names, self.known.get() if self.known.exists() else (None,) * 4))
            events = _advance(key[0], known, rows[due])
            self.known.update(tuple(known[n] for n in names))
            if len(events):
                yield events


def _signals(raw: DataFrame) -> DataFrame:
    """The rows that matter for take-offs: stops, airborne replies, positions and identifications."""
    reply = (F.col("dl") == 11) & (F.col("on_ground") == 0)
    named = F.col("tc").between(2, 4) | ((F.col("tc") == 1) & ~F.col("aircraft_type").isin(*UNINFORMATIVE_LABELS))
    rows = valid_frames(decode(raw)).filter(reply | F.col("msg_type").isin("surface", "ident"))
    return rows.select(
        "icao",
        "ts_kafka",
        "seq",
        F.coalesce(F.col("surf.speed") == 0, F.lit(False)).alias("stopped"),
        reply.alias("reply"),
        F.when(named, F.col("aircraft_type")).alias("kind"),
        F.col("surf.lat").alias("lat"),
        F.col("surf.lon").alias("lon"),
    )


def takeoff_state(raw: DataFrame) -> DataFrame:
    """``(icao, stop_ms, kind, lat, lon)``: what a batch log leaves known, for a stream that goes on from its end."""
    moment = F.struct("ts_kafka", "seq")
    placed = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    last = _signals(raw).groupBy("icao").agg(
        F.max(F.when(F.col("stopped"), moment)).alias("stop"),
        F.max(F.when(F.col("reply"), moment)).alias("reply"),
        F.max(F.when(F.col("kind").isNotNull(), F.struct("ts_kafka", "seq", "kind"))).alias("named"),
        F.max(F.when(placed, F.struct("ts_kafka", "seq", "lat", "lon"))).alias("place"),
    )
    waits = F.col("reply").isNull() | (F.col("stop") > F.col("reply"))
    return last.select(
        "icao",
        F.when(F.col("stop").isNotNull() & waits, F.col("stop.ts_kafka")).alias("stop_ms"),
        F.col("named.kind").alias("kind"),
        "place.lat",
        "place.lon",
    )


def takeoffs_stream(raw: DataFrame, delay: str = DELAY, initial: DataFrame | None = None) -> DataFrame:
    """Take-offs with keyed state; rows are held until the watermark passes them, so order is by time.

    The state of an aircraft is four fields plus its rows of the last ``delay`` and of the
    running trigger, kept in the state store and not in memory. ``initial`` is a
    ``takeoff_state`` to go on from.
    """
    rows = _signals(raw).withColumn("at", F.timestamp_millis("ts_kafka")).withWatermark("at", delay)
    events = rows.groupBy("icao").transformWithStateInPandas(
        statefulProcessor=TakeoffProcessor(),
        outputStructType=_EVENT,
        outputMode="Append",
        timeMode="EventTime",
        initialState=initial.groupBy("icao") if initial is not None else None,
    )
    return with_runway(events)


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB: on disk, and as changes in the checkpoint."""
    before = {c: spark.conf.get(c, None) for c in _ROCKSDB}
    for c, value in _ROCKSDB.items():
        spark.conf.set(c, value)
    try:
        yield
    finally:
        for c, value in before.items():
            spark.conf.unset(c) if value is None else spark.conf.set(c, value)


def run_to_table(stream: DataFrame, name: str) -> DataFrame:
    """Runs a stream over what is available into a Parquet table and reads it back."""
    spark = stream.sparkSession
    base = f"{shared_dir(spark)}/{name}"
    writer = (
        stream.writeStream.format("parquet")
        .option("path", f"{base}/data")
        .option("checkpointLocation", f"{base}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
    )
    with rocksdb_state(spark):
        query = writer.start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/data")
