"""Data-anchored time windows per aircraft and the last state inside each.

A window opens at the first message that is at least ``threshold`` after the
opening of the previous one. Where it opens therefore depends on every earlier
message of the aircraft. The time line is cut into slices, and rows are shuffled
once by (aircraft, slice). A first pass over a slice gives a transfer table that tells, for
every message that could open its first window, when the window after its last one may
open. From these tables follows when each slice's first window may open, and a second
pass over the same shuffled rows gives the state of every window's part in the slice. Both passes
see a slice in order of time and batch by batch, so a task's memory does not follow how many messages
an aircraft sends. Parts of a window that lies in two slices or batches are put together at the end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from tarmac.functions import geo
from tarmac.operators.decode import valid_frames
from tarmac.operators.spans import SPAN, SPAN_MS, by_span, two_before
from tarmac.session import MINUTE_MS

THRESHOLD_MS = 5 * MINUTE_MS
FANOUT = 32
FANOUT_UP = 256
LEVELS = 1
NEVER = -(1 << 62)

_TRANSFER = "icao string, slice bigint, entry bigint, ready bigint"
_READY = "icao string, slice bigint, ready bigint"


def _in_order(times: np.ndarray, after: int | None) -> np.ndarray:
    """A batch's times, which have to go on from the batch before."""
    if len(times) and (np.any(times[1:] < times[:-1]) or (after is not None and times[0] < after)):
        raise ValueError("messages of a slice are not in order of time")
    return times


def _slice_transfer(batches: Iterable[np.ndarray], start: int, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidate first openings of a slice, and when the next window may open after each.

    Times come in order. Only the candidates are kept, each with when its next window may open.
    """
    entries, exits = np.array([], np.int64), np.array([], np.int64)
    for times in batches:
        if not len(entries) or entries[-1] < start + threshold:
            # openings in the first threshold length, plus the first time after it
            new = times[: np.searchsorted(times, start + threshold) + 1]
            entries, exits = np.concatenate([entries, new]), np.concatenate([exits, new + threshold])
        while True:
            spot = np.searchsorted(times, exits)
            moving = spot < len(times)
            if not moving.any():
                break
            exits = np.where(moving, times[np.minimum(spot, len(times) - 1)] + threshold, exits)
        entries, exits = _thinned(entries, exits)
    return entries, exits


def _thinned(entries: np.ndarray, exits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A transfer table without the entries that the next one answers alike."""
    keep = np.append(exits[:-1] != exits[1:], True)[: len(exits)]
    return entries[keep], exits[keep]


def _through(ready: np.ndarray, entries: np.ndarray, exits: np.ndarray) -> np.ndarray:
    """Passes opening times through a slice: its exit for the first entry not before each."""
    spot = np.searchsorted(entries, ready)
    inside = spot < len(entries)
    return np.where(inside, exits[np.minimum(spot, len(entries) - 1)], ready)


def _children(table: pa.Table) -> list[tuple[int, np.ndarray, np.ndarray]]:
    slices, entries, exits = (table[c].to_numpy() for c in ("slice", "entry", "ready"))
    order = np.lexsort((entries, slices))
    slices, entries, exits = slices[order], entries[order], exits[order]
    cuts = np.flatnonzero(np.diff(slices)) + 1
    return [(int(n[0]), e, x) for n, e, x in zip(np.split(slices, cuts), np.split(entries, cuts), np.split(exits, cuts)) if len(n)]


def _rows(icao: str, **columns) -> pa.Table:
    n = len(next(iter(columns.values())))
    return pa.table({"icao": pa.array([icao] * n, pa.string()), **{k: pa.array(v, pa.int64()) for k, v in columns.items()}})


def sliced(rows: DataFrame, threshold_ms: int, fanout: int = FANOUT) -> DataFrame:
    """Rows with their slice, brought together by (aircraft, slice)."""
    with_slice = rows.withColumn("slice", F.floor(F.col("ts_kafka") / F.lit(fanout * threshold_ms)))
    return with_slice.filter("icao IS NOT NULL AND slice IS NOT NULL").repartition("icao", "slice")


def _ordered(rows: DataFrame) -> GroupedData:
    """Rows of ``sliced`` by (aircraft, slice), each slice in order of time."""
    return rows.sortWithinPartitions("icao", "slice", "ts_kafka").groupBy("icao", "slice")


def _times(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of one slice with their times."""
    last = None
    for batch in batches:
        if batch.num_rows:
            times = _in_order(batch["ts_kafka"].to_numpy(), last)
            last = int(times[-1])
            yield batch, times


def _with_ready(grouped: DataFrame, ready: DataFrame) -> GroupedData:
    """Rows of ``sliced`` with when a window may first open in their slice; a task keeps one row a slice of the other side."""
    return _ordered(grouped.join(ready.hint("shuffle_hash"), ["icao", "slice"]))


def arrivals(
    grouped: DataFrame, threshold_ms: int, fanout: int = FANOUT, fanout_up: int = FANOUT_UP, levels: int = LEVELS
) -> DataFrame:
    """``(icao, slice, ready)``: when a window may first open in each slice of ``sliced`` rows.

    A task sees the times of one slice, ``fanout`` windows long, batch by batch, or transfer tables. Such a
    table has at most one entry per distinct time of one threshold length, and fewer as
    windows that open a little apart soon open together. With one level an
    aircraft's tables meet in one task, 3 300 a year with 5-minute windows; each further level
    first combines ``fanout_up`` neighbours, at two more shuffles of tables.
    """
    base_ms = fanout * threshold_ms

    def first_transfer(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        icao, number = (k.as_py() for k in key)
        points = _times(batches)
        entries, exits = _slice_transfer((np.unique(t) for _, t in points), number * base_ms, threshold_ms)
        yield from _rows(icao, slice=np.full(len(entries), number), entry=entries, ready=exits).to_batches()

    # all columns are used, so that the shuffle of rows is the one of the second pass
    others = [F.max(c) if c == "seq" else F.count(c) for c in grouped.columns if c not in ("icao", "slice", "ts_kafka")]
    points = grouped.groupBy("icao", "slice", "ts_kafka").agg(F.array(F.count("*"), *others).alias("used"))
    points = points.filter(F.size("used") > 0).select("icao", "slice", "ts_kafka")
    transfers = [_ordered(points).applyInArrow(first_transfer, _TRANSFER)]
    level_ms = base_ms
    for _ in range(1, levels):
        level_ms *= fanout_up
        above = F.floor(F.col("slice") / F.lit(fanout_up)).alias("parent")
        transfers.append(
            transfers[-1]
            .select("icao", above, "slice", "entry", "ready")
            .groupBy("icao", "parent")
            .applyInArrow(_merge_transfers(level_ms, threshold_ms), _TRANSFER)
        )

    def from_start(key: tuple, table: pa.Table) -> pa.Table:
        return _arrivals(key[0].as_py(), table, NEVER)

    def from_parent(key: tuple, table: pa.Table, known: pa.Table) -> pa.Table:
        return _arrivals(key[0].as_py(), table, known["ready"][0].as_py()) if known.num_rows else _arrivals(key[0].as_py(), table, NEVER)

    ready = transfers[-1].groupBy("icao").applyInArrow(from_start, _READY)
    for lower in reversed(transfers[:-1]):
        children = lower.withColumn("parent", F.floor(F.col("slice") / F.lit(fanout_up)))
        parents = ready.withColumnRenamed("slice", "parent")
        ready = (
            children.groupBy("icao", "parent").cogroup(parents.groupBy("icao", "parent")).applyInArrow(from_parent, _READY)
        )
    return ready


def _merge_transfers(level_ms: int, threshold_ms: int) -> Callable[[tuple, pa.Table], pa.Table]:
    """Combines the transfer tables of neighbouring slices into one of length ``level_ms``."""

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        icao, number = (k.as_py() for k in key)
        parts = _children(table)
        # openings in the first threshold length, plus the first candidate after it
        entries = np.concatenate([e for _, e, _ in parts])
        entries = entries[: np.searchsorted(entries, number * level_ms + threshold_ms) + 1]
        ready = entries
        for _, child_entries, child_exits in parts:
            ready = _through(ready, child_entries, child_exits)
        entries, ready = _thinned(entries, ready)
        return _rows(icao, slice=np.full(len(entries), number), entry=entries, ready=ready)

    return merge


def _arrivals(icao: str, table: pa.Table, ready: int) -> pa.Table:
    """When a window may first open in each child slice."""
    numbers, opens = [], []
    current = np.array([ready])
    for number, entries, exits in _children(table):
        numbers.append(number)
        opens.append(int(current[0]))
        current = _through(current, entries, exits)
    return _rows(icao, slice=numbers, ready=opens)


def _openings(points: np.ndarray, ready: int, threshold: int) -> np.ndarray:
    """Openings of the windows that distinct times of a slice can belong to, the one still open from before first."""
    found = [] if ready == NEVER else [ready - threshold]
    spot = int(np.searchsorted(points, ready))
    while spot < len(points):
        found.append(int(points[spot]))
        spot = int(np.searchsorted(points, points[spot] + threshold))
    return np.array(found, np.int64)


def window_anchors(
    rows: DataFrame,
    threshold_ms: int = THRESHOLD_MS,
    fanout: int = FANOUT,
    fanout_up: int = FANOUT_UP,
    levels: int = LEVELS,
) -> DataFrame:
    """``(icao, anchor)``: the opening time of every window of ``(icao, ts_kafka)`` rows."""
    grouped = sliced(rows.select("icao", "ts_kafka"), threshold_ms, fanout)
    ready = arrivals(grouped, threshold_ms, fanout, fanout_up, levels)

    def opened(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opens = None
        for batch, times in _times(batches):
            opens = batch["ready"][0].as_py() if opens is None else opens
            anchors = _openings(np.unique(times), opens, threshold_ms)
            yield from _rows(key[0].as_py(), anchor=anchors[anchors >= opens]).to_batches()
            opens = int(anchors[-1]) + threshold_ms

    return _with_ready(grouped, ready).applyInArrow(opened, "icao string, anchor bigint")


def _last(value: str) -> Column:
    """Latest non-null value of a group by message order."""
    return F.max_by(value, F.when(F.col(value).isNotNull(), F.struct("ts_kafka", "seq")))


#: Field groups of a window's state: the values that the latest message of the group gives.
_GROUPS = {
    "reply": {"on_ground": "int"},
    "air": {"lat": "double", "lon": "double", "alt_feet": "double"},
    "surf": {"lat": "double", "lon": "double", "speed": "double"},
    "ident": {"callsign": "string", "vortex": "string"},
    "vel": {"speed": "int"},
}
_ARROW = {"int": pa.int32(), "double": pa.float64(), "string": pa.string(), "bigint": pa.int64()}


def _window_rows(decoded: DataFrame) -> DataFrame:
    present = {"reply": F.col("dl") == 11, **{g: F.col(g).isNotNull() for g in ("air", "surf", "ident", "vel")}}

    def group(name: str) -> Column:
        source = "" if name == "reply" else f"{name}."
        fields = [F.col(f"{source}{field}").cast(kind).alias(field) for field, kind in _GROUPS[name].items()]
        return F.when(present[name], F.struct(*fields)).alias(name)

    return valid_frames(decoded).select("ts_kafka", "seq", "icao", *map(group, _GROUPS))


def _part_schema() -> str:
    parts = [f"{g} struct<{', '.join(f'{f}: {k}' for f, k in {'ts_kafka': 'bigint', 'seq': 'bigint', **fields}.items())}>" for g, fields in _GROUPS.items()]
    return f"icao string, anchor bigint, ts_kafka bigint, n_messages bigint, ground_seen int, {', '.join(parts)}"


def _window_parts(table: pa.Table, ready: int, threshold: int) -> tuple[pa.Table, int]:
    """The state of each window's part in some rows of a slice: the latest message of every group. Then, when the next window may open."""
    table = table.combine_chunks()
    seq = table["seq"].to_numpy()
    order = np.lexsort((seq, table["ts_kafka"].to_numpy()))
    times, seq = table["ts_kafka"].to_numpy()[order], seq[order]
    anchors = _openings(np.unique(times), ready, threshold)
    window = np.searchsorted(anchors, times, "right") - 1
    starts = np.flatnonzero(np.diff(window, prepend=-1))
    counts = np.diff(np.append(starts, len(times)))
    ends = starts + counts - 1
    place = np.arange(len(times))
    columns = {
        "icao": table["icao"].take(pa.array(order[starts])),
        "anchor": pa.array(anchors[window[starts]]),
        "ts_kafka": pa.array(times[ends]),
        "n_messages": pa.array(counts),
    }
    for name, fields in _GROUPS.items():
        column = table[name].combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        there = column.is_valid().to_numpy(zero_copy_only=False)[order]
        latest = np.maximum.reduceat(np.where(there, place, -1), starts)
        missing = latest < 0
        rows = pa.array(order[latest], mask=missing)
        own = [column.field(f).take(rows).cast(_ARROW[k]) for f, k in fields.items()]
        moments = [pa.array(times[latest]), pa.array(seq[latest])]
        kinds = [pa.field(f, _ARROW[k]) for f, k in {"ts_kafka": "bigint", "seq": "bigint", **fields}.items()]
        columns[name] = pa.StructArray.from_arrays([*moments, *own], fields=kinds, mask=pa.array(missing))
        if name == "reply":
            stated = column.field("on_ground").to_numpy(zero_copy_only=False)[order]
            stated = np.where(there & ~np.isnan(stated.astype(float)), stated, -1).astype(np.int64)
            most = np.maximum.reduceat(stated, starts)
            columns["ground_seen"] = pa.array(most, pa.int32(), mask=most < 0)
    parts = pa.table({k: columns[k] for k in ("icao", "anchor", "ts_kafka", "n_messages", "ground_seen", *_GROUPS)})
    return parts, int(anchors[-1]) + threshold


def _resolved(last: DataFrame, *keys: str) -> DataFrame:
    """The values of a state from its groups: on the ground the surface speed and position replace the airborne ones."""
    ground = F.when(F.col("ground_seen") == 1, F.lit(1)).otherwise(F.col("reply.on_ground"))
    down = F.coalesce(ground == 1, F.lit(False))
    moved = down & F.col("surf.lat").isNotNull() & F.col("surf.lon").isNotNull()
    return last.select(
        "icao",
        *keys,
        "ts_kafka",
        "n_messages",
        F.when(down, F.coalesce("surf.speed", F.col("vel.speed").cast("double")))
        .otherwise(F.col("vel.speed").cast("double"))
        .alias("velocity"),
        F.when(moved, F.col("surf.lat")).otherwise(F.col("air.lat")).alias("lat"),
        F.when(moved, F.col("surf.lon")).otherwise(F.col("air.lon")).alias("lon"),
        ground.alias("ground"),
        F.col("air.alt_feet").alias("alt_feet"),
        F.col("ident.callsign").alias("callsign"),
        F.col("ident.vortex").alias("vortex"),
    )


def spanned_states(decoded: DataFrame, threshold_ms: int = THRESHOLD_MS) -> DataFrame:
    """``window_states`` with the span column, brought together by (aircraft, span) for the operators of ``routes``."""
    grouped = sliced(_window_rows(decoded), threshold_ms)
    ready = arrivals(grouped, threshold_ms)

    def parts(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opens = None
        for batch, _ in _times(batches):
            opens = batch["ready"][0].as_py() if opens is None else opens
            found, opens = _window_parts(pa.Table.from_batches([batch]), opens, threshold_ms)
            yield from found.to_batches()

    found = _with_ready(grouped, ready).applyInArrow(parts, _part_schema())
    found = found.withColumn(SPAN, F.floor(F.col("anchor") / F.lit(SPAN_MS))).repartition("icao", SPAN)
    whole = found.groupBy("icao", SPAN, "anchor").agg(
        F.max("ts_kafka").alias("ts_kafka"),
        F.sum("n_messages").alias("n_messages"),
        F.max("ground_seen").alias("ground_seen"),
        *[F.max(g).alias(g) for g in _GROUPS],  # a group orders by its message's time
    )
    return _resolved(whole, "anchor", SPAN)


def window_states(decoded: DataFrame, threshold_ms: int = THRESHOLD_MS) -> DataFrame:
    """One row per aircraft and anchored window with the last state seen inside it.

    Ground is 1 once any all-call reply in the window said so, else what the
    last reply said. On the ground the surface speed and position replace the
    airborne ones.
    """
    return spanned_states(decoded, threshold_ms).drop(SPAN)


def grid_states(decoded: DataFrame, window_ms: int = THRESHOLD_MS, slide_ms: int | None = None) -> DataFrame:
    """The same last state on fixed clock windows; works on batch and streaming frames.

    Partial aggregates come first, so a busy window does not pile up.
    """
    rows = _window_rows(decoded).withColumn("ts", F.timestamp_millis("ts_kafka"))
    slide = slide_ms or window_ms
    window = F.window("ts", f"{window_ms} milliseconds", f"{slide} milliseconds")
    if decoded.isStreaming:
        rows = rows.withWatermark("ts", "10 minutes")
    last = rows.groupBy("icao", window.alias("window")).agg(
        F.max("ts_kafka").alias("ts_kafka"),
        F.count("*").alias("n_messages"),
        F.max("reply.on_ground").alias("ground_seen"),
        *[_last(g).alias(g) for g in _GROUPS],
    )
    return _resolved(last, "window")


def direction(states: DataFrame) -> DataFrame:
    """Adds ``direction_rad`` and the signed ``bearing_rad`` against the two previous windows."""
    rows = by_span(states)
    placed, one, two = two_before(rows, ("lat", "lon"))
    df = placed.withColumns({"__p1": one, "__p2": two})

    def against(place: str) -> Column:
        return geo.angle_to_east(F.col("lat") - F.col(f"{place}.lat"), F.col("lon") - F.col(f"{place}.lon"))

    df = df.withColumns({"__a1": against("__p1"), "__a2": against("__p2")})
    both = (F.col("__a1") + F.col("__a2")) / F.lit(2.0)
    bearing = F.atan2(F.col("lat") - F.col("__p1.lat"), F.col("lon") - F.col("__p1.lon"))
    return df.select(
        *states.columns,
        F.coalesce(both, "__a1", "__a2").alias("direction_rad"),
        bearing.alias("bearing_rad"),
    )


def map_states(decoded: DataFrame, threshold_ms: int = THRESHOLD_MS) -> DataFrame:
    """The table behind the maps: window states with directions."""
    return direction(spanned_states(decoded, threshold_ms)).drop(SPAN)
