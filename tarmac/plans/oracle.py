"""Expected results of the registered queries as DuckDB SQL over ``events``.

The statements compute the message contents from the event attributes, so they
check the encoder and the decoder as well as the operators on top.
"""

from __future__ import annotations

from tarmac.functions.fixed_values import (
    CATEGORY_LABELS,
    GROUND_LABELS,
    RUNWAYS,
    WEEKDAY_LETTERS,
    WEEKDAYS_ES,
)

_LABELS = ", ".join(
    f"({tc}, {cat}, '{label}')" for tc, labels in CATEGORY_LABELS.items() for cat, label in enumerate(labels)
)


def _list(names: list[str]) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


def _ray_cast(vertices: list[tuple[float, float]]) -> str:
    """Odd number of edges to the right of the point."""
    edges = zip(vertices, vertices[1:] + vertices[:1])
    hits = [
        f"(CASE WHEN (({ay}) > lat) <> (({by}) > lat) "
        f"AND lon < (({bx}) - ({ax})) * (lat - ({ay})) / (({by}) - ({ay})) + ({ax}) THEN 1 ELSE 0 END)"
        for (ax, ay), (bx, by) in edges
        if ay != by
    ]
    return f"({' + '.join(hits)}) % 2 = 1"


_RUNWAY = "CASE " + " ".join(f"WHEN {_ray_cast(v)} THEN '{name}'" for name, v in RUNWAYS) + " END"


def _r(column: str, name: str | None = None) -> str:
    return f"round({column}, 6) + 0.0 AS {name or column}"


# numbers, places, call sign blocks, attributes, aircraft, kinds and times of the frames of each log
_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER)"
_T = "1704067200000 + (epoch_us(ts) // 1000 - 1704067200000) // 4"
PLAIN_LOG = f"""
ev AS (
  SELECT event_id AS e, event_id AS p, event_id // 300 AS c, {_K} AS k, user_id % 12 AS u, event_type, {_T} AS ts_kafka, 0 AS rich
  FROM events),"""
FLEET_LOG = f"""
bursts AS (
  SELECT event_id AS p, {_K} AS k, CASE WHEN user_id % 3 = 0 THEN 0 ELSE 1 + user_id % 60 END AS u, {_T} AS t0, unnest([0, 1, 2, 3]) AS i
  FROM events),
ev AS (
  SELECT p * 4 + i AS e, p, (t0 + 400 * i) // 345600000 AS c, k, u,
         CASE WHEN i < 2 THEN CASE WHEN k % 4 = 0 THEN 'click' ELSE 'error' END WHEN i = 3 THEN 'view'
              WHEN p % 3 = 0 THEN 'signup' WHEN p % 3 = 1 OR k % 10 <> 8 THEN 'purchase' ELSE 'error' END AS event_type,
         t0 + 400 * i AS ts_kafka, 1 AS rich
  FROM bursts),"""

FRAMES = f"""{PLAIN_LOG}
kinds AS (
  SELECT *, CASE event_type WHEN 'view' THEN 'allcall' WHEN 'click' THEN 'surface' WHEN 'signup' THEN 'ident'
                 WHEN 'purchase' THEN 'velocity' ELSE CASE WHEN k % 10 = 8 THEN 'status' ELSE 'airborne' END END AS kind,
         40.45 + ((p * 7919) % 1000) * 0.00009::DOUBLE AS lat0, -3.59 + ((p * 104729) % 1000) * 0.00007::DOUBLE AS lon0,
         CASE WHEN event_type = 'click' THEN 90.0::DOUBLE ELSE 360.0::DOUBLE END AS q, e % 2 AS odd
  FROM ev),
c1 AS (SELECT *, q / (60 - odd) AS dlat FROM kinds),
c2 AS (SELECT *, floor(131072 * (lat0 - dlat * floor(lat0 / dlat)) / dlat + 0.5) AS yz FROM c1),
c3 AS (SELECT *, dlat * (yz / 131072 + floor(lat0 / dlat)) AS rlat FROM c2),
c4 AS (SELECT *, q / greatest(floor(2 * pi() / acos(1 - (1 - cos(pi() / 30)) / (cos(radians(rlat)) ** 2))) - odd, 1) AS dlon FROM c3),
c5 AS (SELECT *, floor(131072 * (lon0 - dlon * floor(lon0 / dlon)) / dlon + 0.5) AS xz FROM c4),
labels_by_code(tc, cat, label) AS (VALUES {_LABELS}),
msg AS (
  SELECT e AS seq, ts_kafka, '3400' || printf('%02x', u) AS icao, kind, k, u, e, p, c, rich, odd, yz, xz,
         CASE WHEN kind = 'allcall' THEN 11 WHEN rich = 1 AND p % 5 = 0 THEN 18 ELSE 17 END AS dl,
         CASE WHEN kind = 'surface' THEN 4 WHEN kind <> 'allcall' THEN 5 WHEN k % 10 = 9 THEN 0
              WHEN k % 4 = 0 THEN 4 ELSE 5 END AS ca,
         CASE kind WHEN 'surface' THEN 5 + e % 4 WHEN 'ident' THEN 1 + e % 4 WHEN 'velocity' THEN 19 WHEN 'status' THEN 31
              WHEN 'airborne' THEN CASE WHEN k % 10 = 9 THEN 20 + e % 3 ELSE 9 + e % 10 END END AS tc,
         CASE WHEN kind IN ('surface', 'ident', 'velocity', 'airborne') THEN kind END AS msg_type,
         CASE WHEN kind IN ('surface', 'airborne') THEN rlat END AS lat,
         CASE WHEN kind IN ('surface', 'airborne') THEN dlon * (xz / 131072 + floor(lon0 / dlon)) END AS lon,
         CASE WHEN kind = 'surface' THEN CASE WHEN k % 2 = 0 THEN 1 ELSE (k * 7) % 128 END END AS movement,
         e % 37 <> 0 AS intact
  FROM c5),
valid AS (
  SELECT *, row_number() OVER (ORDER BY ts_kafka, seq) AS rn,
         CASE ca WHEN 4 THEN 1 WHEN 5 THEN 0 END AS on_ground,
         CASE WHEN movement = 1 THEN 0.0 WHEN movement BETWEEN 2 AND 8 THEN 0.125 + (movement - 2) * 0.125
              WHEN movement BETWEEN 9 AND 12 THEN 1 + (movement - 9) * 0.25
              WHEN movement BETWEEN 13 AND 38 THEN 2 + (movement - 13) * 0.5
              WHEN movement BETWEEN 39 AND 93 THEN 15.0 + movement - 39
              WHEN movement BETWEEN 94 AND 108 THEN 70.0 + (movement - 94) * 2
              WHEN movement BETWEEN 109 AND 123 THEN 100.0 + (movement - 109) * 5
              WHEN movement = 124 THEN 175.0 END::DOUBLE AS surf_speed,
         CASE WHEN kind = 'surface' AND (k // 2) % 2 = 1 THEN (e % 128) * 360.0::DOUBLE / 128 END AS track,
         CASE WHEN kind = 'airborne' THEN
              CASE WHEN k % 10 = 9 THEN CASE WHEN (e * 13) % 4096 <> 0 THEN ((e * 13) % 4096) * 3.28084::DOUBLE END
                   ELSE (((e * 13) % 1600) * 25 - 1000)::DOUBLE END END AS alt_feet,
         CASE WHEN kind = 'ident' THEN 'F' || ['A', 'B', 'C'][1 + c % 3] || 'T00' || printf('%02d', u) END AS callsign,
         CASE WHEN kind = 'ident' THEN (SELECT label FROM labels_by_code l WHERE l.tc = msg.tc AND l.cat = k % 8) END AS label,
         CASE WHEN kind = 'velocity' THEN CASE WHEN k % 4 = 3 THEN 3 ELSE 1 END + rich * ((e % 8) // 4) END AS st,
         1 + 3 * rich * ((e % 8) // 4) AS factor, (e * 37) % 600 * (1 + 3 * rich * ((e % 8) // 4)) AS vx, (e * 53) % 600 * (1 + 3 * rich * ((e % 8) // 4)) AS vy
  FROM msg WHERE intact),
vel AS (
  SELECT rn, CASE WHEN st > 2 THEN (k * 5) % 500 * factor ELSE floor(sqrt(vx * vx + vy * vy))::BIGINT END AS speed,
         CASE WHEN st > 2 THEN ((e * 11) % 1024) * 360.0::DOUBLE / 1024
              ELSE (degrees(atan2((vx * (1 - 2 * (e % 2)))::DOUBLE, (vy * (1 - 2 * (k % 2)))::DOUBLE)) + 360) % 360 END AS heading,
         CASE WHEN 1 + e % 200 = 0 THEN NULL ELSE (e % 200) * 64 * (1 - 2 * (e % 2)) END AS vs,
         CASE WHEN st > 2 THEN CASE WHEN e % 2 = 1 THEN 'TAS' ELSE 'IAS' END ELSE 'GS' END AS vt,
         (k % 50) * 25 * (1 - 2 * rich * (p % 2)) AS dalt, CASE WHEN st < 3 THEN vx END AS vew, CASE WHEN st > 2 THEN (e * 11) % 1024 END AS hdg,
         CASE WHEN st > 2 THEN e % 2 END AS t, *  EXCLUDE (rn)
  FROM valid WHERE kind = 'velocity')"""

FACTS = """,
facts AS (
  SELECT DISTINCT strftime(make_timestamp(ts_kafka * 1000), '%d/%m/%Y') AS day,
         extract(hour FROM make_timestamp(ts_kafka * 1000))::BIGINT AS hour, icao, on_ground::BIGINT AS on_ground
  FROM valid WHERE dl = 11 AND on_ground IS NOT NULL),
hours AS (SELECT unnest(range(24)) AS hour)"""

TAKEOFFS = f""",
marks AS (
  SELECT *, dl = 11 AND on_ground = 0 AS is_air,
         coalesce(sum(CASE WHEN dl = 11 AND on_ground = 0 THEN 1 ELSE 0 END)
           OVER (PARTITION BY icao ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS leg
  FROM valid),
carried AS (
  SELECT *, max(CASE WHEN surf_speed = 0 THEN ts_kafka END)
              OVER (PARTITION BY icao, leg ORDER BY rn ROWS UNBOUNDED PRECEDING) AS stop,
         last_value(CASE WHEN tc IN (2, 3, 4) THEN label END IGNORE NULLS)
              OVER (PARTITION BY icao ORDER BY rn ROWS UNBOUNDED PRECEDING) AS type_now,
         last_value(CASE WHEN kind = 'surface' THEN rn END IGNORE NULLS)
              OVER (PARTITION BY icao ORDER BY rn ROWS UNBOUNDED PRECEDING) AS place
  FROM marks),
events_t AS (
  SELECT c.icao, c.seq, c.stop AS last_stopped_ms, c.ts_kafka AS takeoff_ms, c.ts_kafka - c.stop AS wait_ms,
         (c.ts_kafka - c.stop) / 1000.0::DOUBLE AS wait_s, c.type_now AS aircraft_type, p.lat, p.lon,
         (c.ts_kafka - p.ts_kafka) / 1000.0::DOUBLE AS pos_age_s,
         make_timestamp(c.ts_kafka * 1000) AS left_at
  FROM carried c LEFT JOIN valid p ON p.rn = c.place WHERE c.is_air AND c.stop IS NOT NULL),
tko AS (
  SELECT * EXCLUDE (left_at), strftime(left_at, '%Y-%m-%d') AS takeoff_date, extract(hour FROM left_at)::BIGINT AS takeoff_hour,
         (isodow(left_at) - 1)::BIGINT AS weekday_no, {_RUNWAY} AS runway
  FROM events_t),
clean AS (
  SELECT * FROM (SELECT *, lead(takeoff_ms) OVER (PARTITION BY icao ORDER BY takeoff_ms, seq) AS following
                 FROM tko WHERE wait_s < 1500 AND runway IS NOT NULL)
  WHERE following IS NULL OR following - takeoff_ms >= 1800000),
days7 AS (SELECT unnest(range(7)) AS weekday_no)"""

WINDOWS = """,
anchors(icao, anchor) AS (
  SELECT icao, min(ts_kafka) FROM valid GROUP BY icao
  UNION ALL
  SELECT a.icao, min(v.ts_kafka) FROM anchors a JOIN valid v ON v.icao = a.icao AND v.ts_kafka >= a.anchor + 3600000
  GROUP BY a.icao, a.anchor),
placed AS (SELECT v.*, a.anchor FROM valid v ASOF JOIN anchors a ON v.icao = a.icao AND v.ts_kafka >= a.anchor),
picks AS (
  SELECT icao, anchor, max(ts_kafka) AS ts_kafka, count(*) AS n_messages, max(CASE WHEN dl = 11 THEN on_ground END) AS seen,
         max(rn) FILTER (WHERE dl = 11) AS r, max(rn) FILTER (WHERE kind = 'airborne') AS a,
         max(rn) FILTER (WHERE kind = 'surface') AS s, max(rn) FILTER (WHERE kind = 'ident') AS i,
         max(rn) FILTER (WHERE kind = 'velocity') AS w
  FROM placed GROUP BY icao, anchor),
raw_states AS (
  SELECT p.icao, p.anchor, p.ts_kafka, p.n_messages, CASE WHEN p.seen = 1 THEN 1 ELSE r.on_ground END::BIGINT AS ground,
         a.lat AS alat, a.lon AS alon, a.alt_feet, s.lat AS slat, s.lon AS slon, s.surf_speed, i.callsign, i.label AS vortex,
         w.speed
  FROM picks p LEFT JOIN valid r ON r.rn = p.r LEFT JOIN valid a ON a.rn = p.a LEFT JOIN valid s ON s.rn = p.s
       LEFT JOIN valid i ON i.rn = p.i LEFT JOIN vel w ON w.rn = p.w),
states AS (
  SELECT icao, anchor, ts_kafka, n_messages,
         CASE WHEN ground = 1 THEN coalesce(surf_speed, speed) ELSE speed END::DOUBLE AS velocity,
         CASE WHEN ground = 1 AND slat IS NOT NULL THEN slat ELSE alat END AS lat,
         CASE WHEN ground = 1 AND slon IS NOT NULL THEN slon ELSE alon END AS lon,
         ground, alt_feet, callsign, vortex
  FROM raw_states),
lagged AS (
  SELECT *, lag(lat) OVER o AS lat1, lag(lon) OVER o AS lon1, lag(lat, 2) OVER o AS lat2, lag(lon, 2) OVER o AS lon2
  FROM states WINDOW o AS (PARTITION BY icao ORDER BY ts_kafka)),
angles AS (
  SELECT *, acos((lon - lon1) / (1e-5 + sqrt((lon - lon1) ** 2 + (lat - lat1) ** 2))) AS d1,
         acos((lon - lon2) / (1e-5 + sqrt((lon - lon2) ** 2 + (lat - lat2) ** 2))) AS d2,
         atan2(lat - lat1, lon - lon1) AS bearing_rad
  FROM lagged),
maps AS (
  SELECT * EXCLUDE (d1, d2, lat1, lon1, lat2, lon2),
         CASE WHEN d1 IS NULL THEN d2 WHEN d2 IS NULL THEN d1 ELSE (d1 + d2) / 2 END AS direction_rad
  FROM angles),
points AS (SELECT * FROM maps WHERE lat IS NOT NULL AND lon IS NOT NULL AND ground IS NOT NULL),
changes AS (
  SELECT *, lag(ts_kafka) OVER o AS before_ms, lag(callsign) OVER o AS before_callsign
  FROM points WINDOW o AS (PARTITION BY icao ORDER BY ts_kafka)),
legs AS (
  SELECT *, sum(CASE WHEN before_ms IS NULL OR callsign IS DISTINCT FROM before_callsign THEN 1 ELSE 0 END)
              OVER (PARTITION BY icao ORDER BY ts_kafka ROWS UNBOUNDED PRECEDING) AS leg
  FROM changes),
ranked AS (SELECT *, dense_rank() OVER (PARTITION BY icao ORDER BY leg DESC) - 1 AS flight_rank FROM legs),
route AS (
  SELECT icao, row_number() OVER (PARTITION BY icao ORDER BY ts_kafka) - 1 AS pos, ts_kafka, round(lat, 3) AS lat,
         round(lon, 3) AS lon, velocity, alt_feet, callsign
  FROM ranked WHERE flight_rank = 0)"""

_COLOR = "CASE WHEN velocity < 300 THEN 'red' WHEN velocity < 450 THEN 'yellow' ELSE 'green' END"

_LAST = """
picked AS (
  SELECT seq, ts_kafka, icao, rn, {surface} AS s, {airborne} AS a, {velocity} AS w, {ident} AS i, {gs} AS g, {asp} AS h
  FROM valid WHERE msg_type IS NOT NULL
  WINDOW o AS (PARTITION BY icao ORDER BY rn ROWS UNBOUNDED PRECEDING))"""


def _known(ttl_ms: int | None) -> str:
    conditions = {
        "surface": "kind = 'surface'",
        "airborne": "kind = 'airborne'",
        "velocity": "kind = 'velocity'",
        "ident": "kind = 'ident'",
        "gs": "st < 3",
        "asp": "st > 2",
    }
    picked = _LAST.format(**{n: f"max(CASE WHEN {c} THEN rn END) OVER o" for n, c in conditions.items()})
    fresh = "" if ttl_ms is None else " AND p.ts_kafka - {a}.ts_kafka <= " + str(ttl_ms)

    def join(alias: str, table: str) -> str:
        return f"LEFT JOIN {table} {alias} ON {alias}.rn = p.{alias}" + fresh.format(a=alias)

    joins = " ".join([join("s", "valid"), join("a", "valid"), join("i", "valid"), join("w", "vel"), join("g", "vel"), join("h", "vel")])
    return (
        picked
        + f""" SELECT p.ts_kafka AS timestamp, p.seq, p.icao, {_r('s.lat', 'latitude')}, {_r('s.lon', 'longitude')},
        {_r('s.surf_speed', 'surface_velocity')}, s.movement::BIGINT AS movement_code, {_r('s.track', 'ground_track')},
        {_r('a.lat', 'airborne_pos_lat')}, {_r('a.lon', 'airborne_pos_lon')},
        CASE WHEN a.tc >= 20 THEN 'airborne_gnss_alt' WHEN a.tc IS NOT NULL THEN 'airborne_barometric_alt' END AS "airborne_pos_altitude_type",
        CASE WHEN a.rn IS NOT NULL THEN 'no_condition' END AS "airborne_pos_surveillance_status",
        CASE WHEN a.rn IS NOT NULL THEN 0 END::BIGINT AS "airborne_pos_single_antenna_flag",
        CASE WHEN a.rn IS NOT NULL THEN 0 END::BIGINT AS "airborne_pos_time",
        CASE a.odd WHEN 0 THEN 'even_frame' WHEN 1 THEN 'odd_frame' END AS "airborne_pos_CPR",
        w.speed::BIGINT AS "V", {_r('w.heading', '"H"')}, w.vs::BIGINT AS "VS", w.vt AS "VT", w.st::BIGINT AS "ST",
        CASE WHEN w.rn IS NOT NULL THEN 0 END::BIGINT AS "IC", CASE WHEN w.rn IS NOT NULL THEN 1 END::BIGINT AS "IFR",
        CASE WHEN w.rn IS NOT NULL THEN 0 END::BIGINT AS "NUC", (w.k % 2)::BIGINT AS "VrSrc", (w.e % 2)::BIGINT AS "Svr",
        CASE WHEN w.rn IS NOT NULL THEN 0 END::BIGINT AS "SDif", w.dalt::BIGINT AS "dAlt", (1 + w.e % 200)::BIGINT AS "VR",
        (g.e % 2)::BIGINT AS "Dew", g.vew::BIGINT AS "Vew", (g.k % 2)::BIGINT AS "Dns",
        CASE WHEN h.rn IS NOT NULL THEN 1 END::BIGINT AS "SH", h.hdg::BIGINT AS "HDG", h.t::BIGINT AS "T", i.callsign, i.label AS vortex
        FROM picked p {joins}"""
    )


def _with(parts: str, select: str) -> str:
    return f"WITH RECURSIVE {FRAMES}{parts} {select}"


def _box(source: str, group: str | None) -> str:
    keys, by = (f"{group}, ", f"GROUP BY {group}") if group else ("", "")
    same = f"r.{group} = b.{group}" if group else "true"
    out = f"r.{group}, " if group else ""
    return f""", box AS (
      SELECT {keys}count(*) AS n, quantile_cont(wait_ms, 0.25) AS q1, quantile_cont(wait_ms, 0.5) AS median,
             quantile_cont(wait_ms, 0.75) AS q3 FROM {source} {by})
    SELECT {out}b.n, {_r('b.q1 / 1000.0::DOUBLE', 'q1')}, {_r('b.median / 1000.0::DOUBLE', 'median')},
           {_r('b.q3 / 1000.0::DOUBLE', 'q3')},
           {_r('min(wait_ms) FILTER (WHERE wait_ms BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) / 1000.0::DOUBLE', 'whisker_low')},
           {_r('max(wait_ms) FILTER (WHERE wait_ms BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) / 1000.0::DOUBLE', 'whisker_high')},
           count(*) FILTER (WHERE wait_ms NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers
    FROM {source} r JOIN box b ON {same} GROUP BY {out}b.n, b.q1, b.median, b.q3"""


def _hist(source: str, column: str) -> str:
    return f""", v AS (SELECT {column}::DOUBLE AS v FROM {source} WHERE {column} IS NOT NULL),
    bounds AS (SELECT min(v) AS lo, (max(v) - min(v)) / 10 AS width FROM v),
    counts AS (SELECT least(floor((v - lo) / width), 9) AS bin, count(*) AS n FROM v, bounds GROUP BY 1)
    SELECT b.bin, {_r('lo + b.bin * width', 'bin_start')}, {_r('lo + (b.bin + 1) * width', 'bin_end')},
           coalesce(c.n, 0) AS n
    FROM (SELECT unnest(range(10)) AS bin) b CROSS JOIN bounds LEFT JOIN counts c ON c.bin = b.bin"""


def _most(ground: int) -> str:
    return (
        ", most AS (SELECT icao, max(velocity) AS max_speed, max(alt_feet) AS max_alt_feet FROM points "
        f"WHERE ground = {ground} GROUP BY icao)"
    )


def _dense(cells: str, spine: str, keys: str, value: str) -> str:
    return f"SELECT {keys}, coalesce({value}, 0) AS {value} FROM ({spine}) LEFT JOIN ({cells}) USING ({keys})"


def _day(number: str) -> str:
    return f"WHERE day = '{number}'"


_MEAN = "round(sum(wait_ms) / count(*) / 1000.0::DOUBLE, 6) + 0.0 AS mean_wait_s"
_TKO = (
    f"icao, seq, last_stopped_ms, takeoff_ms, wait_ms, {_r('wait_s')}, aircraft_type, {_r('lat')}, {_r('lon')}, "
    f"{_r('pos_age_s')}, takeoff_date, takeoff_hour"
)
_STATE = (
    f"icao, anchor, ts_kafka, n_messages, {_r('velocity')}, {_r('lat')}, {_r('lon')}, ground, {_r('alt_feet')}, "
    "callsign, vortex"
)
_PROFILED = ["icao", "ts_kafka", "velocity", "lat", "lon", "ground", "alt_feet", "callsign", "vortex"]
_NULLABLE = ["velocity", "lat", "lon", "ground", "alt_feet", "callsign", "vortex", "direction_rad", "bearing_rad"]


def _profile_column(c: str) -> str:
    value = f"round({c}, 6)" if c in ("velocity", "lat", "lon", "alt_feet") else c
    return (
        f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS n_null, "
        f"count(DISTINCT {value}) AS n_distinct FROM maps"
    )


def _null_pair(a: str, b: str) -> str:
    return (
        f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", "
        f"round(corr(({a} IS NULL)::INTEGER, ({b} IS NULL)::INTEGER), 6) + 0.0 AS corr FROM maps "
        f"HAVING count(DISTINCT {a} IS NULL) = 2 AND count(DISTINCT {b} IS NULL) = 2"
    )



# a popup shows up to 8 significant digits: 40.123456 and -3.5123456 are already that short after rounding
_MARKER = """'{"type":"Feature","properties":{"id":"' || icao || '"' ||
  CASE WHEN callsign IS NULL THEN '' ELSE ',"callsign":"' || callsign || '"' END ||
  ',"lat":' || lat::VARCHAR || ',"lon":' || lon::VARCHAR ||
  CASE WHEN velocity IS NULL THEN '' ELSE ',"speed":' || velocity::VARCHAR END ||
  CASE WHEN rotation IS NULL THEN '' ELSE ',"rotation":' || rotation::VARCHAR END ||
  ',"ground":' || ground || ',"times":["' || at_text || '"]},"geometry":{"type":"MultiPoint","coordinates":[['
  || lon::VARCHAR || ',' || lat::VARCHAR || ']]}}'"""
_TRAIL = """'{"type":"Feature","properties":{"times":["' || rtrim(repeat(at_text || '","', size::BIGINT), '",') || '"]},'
  || '"geometry":{"type":"LineString","coordinates":[' || places || ']}}'"""


def _zones(lat: str) -> str:
    return f"floor(2 * pi() / acos(1 - (1 - cos(pi() / 30)) / (cos(radians({lat})) ** 2)))"


def _signed(value: str) -> str:
    return (
        f"CASE WHEN kind = 'surface' THEN CASE WHEN abs({value} - 90 - 40.51::DOUBLE) < abs({value} - 40.51::DOUBLE) THEN {value} - 90 ELSE {value} END "
        f"WHEN {value} >= 270 THEN {value} - 360 ELSE {value} END"
    )


_PAIRS = f""",
codes AS (
  SELECT rn, seq, ts_kafka, icao, kind, odd, (yz::BIGINT % 131072) / 131072.0::DOUBLE AS y, (xz::BIGINT % 131072) / 131072.0::DOUBLE AS x
  FROM valid WHERE kind IN ('airborne', 'surface')),
latest AS (
  SELECT *, max(CASE WHEN odd = 0 THEN rn END) OVER o AS re, max(CASE WHEN odd = 1 THEN rn END) OVER o AS ro
  FROM codes WINDOW o AS (PARTITION BY icao, kind ORDER BY rn ROWS UNBOUNDED PRECEDING)),
met AS (
  SELECT l.*, a.y AS ye, a.x AS xe, b.y AS yo, b.x AS xo, CASE WHEN l.kind = 'surface' THEN 90 ELSE 360 END::DOUBLE AS circle,
         floor(59 * a.y - 60 * b.y + 0.5::DOUBLE) AS j
  FROM latest l JOIN codes a ON a.rn = l.re JOIN codes b ON b.rn = l.ro WHERE abs(a.ts_kafka - b.ts_kafka) <= 10000),
ringed AS (SELECT *, circle / 60 * ((j % 60 + 60) % 60 + ye) AS le0, circle / 59 * ((j % 59 + 59) % 59 + yo) AS lo0 FROM met),
lats AS (SELECT *, {_signed('le0')} AS le, {_signed('lo0')} AS lo FROM ringed),
zoned AS (SELECT *, {_zones('le')} AS nl FROM lats WHERE {_zones('le')} = {_zones('lo')}),
counted AS (SELECT *, greatest(nl - odd, 1) AS n, floor(xe * (nl - 1) - xo * nl + 0.5::DOUBLE) AS m FROM zoned),
lons AS (SELECT *, circle / n * ((m % n + n) % n + CASE odd WHEN 1 THEN xo ELSE xe END) AS l0 FROM counted),
fixes AS (
  SELECT rn, seq, ts_kafka, icao, CASE odd WHEN 1 THEN lo ELSE le END AS lat, (kind = 'surface')::BIGINT AS ground,
         CASE WHEN kind = 'surface' THEN l0 + 90 * floor((-3.53::DOUBLE - l0) / 90 + 0.5::DOUBLE) WHEN l0 >= 180 THEN l0 - 360 ELSE l0 END AS lon
  FROM lons),
steps AS (
  SELECT *, lag(ts_kafka) OVER o AS t0, lag(lat) OVER o AS lat0, lag(lon) OVER o AS lon0 FROM fixes
  WINDOW o AS (PARTITION BY icao ORDER BY rn)),
speeds AS (
  SELECT *, 60 * degrees(2 * asin(sqrt(least(1, sin(radians((lat - lat0) / 2)) ** 2 + cos(radians(lat0)) * cos(radians(lat)) * sin(radians((lon - lon0) / 2)) ** 2))))
         / (greatest(ts_kafka - t0, 1) / 3600000.0::DOUBLE) AS knots FROM steps)"""


def fleet(sql: str) -> str:
    """A statement over the plain log as one over the fleet log."""
    return sql.replace(PLAIN_LOG, FLEET_LOG)


def oracle_queries() -> dict[str, str]:
    plain = _plain_queries()
    same = {
        "fleet_frames": "valid_frames",
        "fleet_airborne": "decode_airborne",
        "fleet_velocity": "decode_velocity",
        "fleet_takeoffs": "takeoffs",
        "fleet_window_states": "window_states",
        "fleet_direction": "direction",
        "fleet_trails": "trails",
        "fleet_flights": "flights",
        "fleet_current_route": "current_route",
        "fleet_segments": "segments",
        "fleet_height_profile": "height_profile",
        "fleet_latest_state": "latest_state",
        "fleet_map_points": "map_points_day",
    }
    # the plain statement of the known state states bits that are 0 in the plain log
    known = plain["known_state"]
    for old, new in _STATED_BITS:
        assert old in known
        known = known.replace(old, new)
    pairs = _with(_PAIRS, f"SELECT seq, ts_kafka, icao, {_r('lat')}, {_r('lon')}, ground, "
                  "CASE WHEN ts_kafka - t0 <= 600000 THEN (knots <= 1000)::BIGINT END AS plausible FROM speeds")
    return plain | {name: fleet(plain[of]) for name, of in same.items()} | {"fleet_known_state": fleet(known), "pair_positions": fleet(pairs)}


#: In the known state, what the plain log leaves constant and the fleet log does not.
_STATED_BITS = (
    ("CASE WHEN a.rn IS NOT NULL THEN 'no_condition' END", "CASE WHEN a.rn IS NOT NULL THEN ['no_condition', 'permanent_alert', 'temporary_alert', 'SPI_condition'][1 + a.p % 4] END"),
    ('CASE WHEN a.rn IS NOT NULL THEN 0 END::BIGINT AS "airborne_pos_single_antenna_flag"', '((a.p // 4) % 2)::BIGINT AS "airborne_pos_single_antenna_flag"'),
    ('CASE WHEN a.rn IS NOT NULL THEN 0 END::BIGINT AS "airborne_pos_time"', '((a.p // 8) % 2)::BIGINT AS "airborne_pos_time"'),
    ('CASE WHEN w.rn IS NOT NULL THEN 0 END::BIGINT AS "IC"', '(w.p % 2)::BIGINT AS "IC"'),
    ('CASE WHEN w.rn IS NOT NULL THEN 0 END::BIGINT AS "NUC"', '(w.p % 8)::BIGINT AS "NUC"'),
    ('CASE WHEN w.rn IS NOT NULL THEN 0 END::BIGINT AS "SDif"', '(w.p % 2)::BIGINT AS "SDif"'),
)


def _plain_queries() -> dict[str, str]:
    f, w = FACTS, WINDOWS
    t = TAKEOFFS
    hour_counts = "SELECT hour, on_ground, count(*) AS n FROM facts {where} GROUP BY hour, on_ground"
    matrix = "SELECT day, hour, count(*) AS n FROM facts {where} GROUP BY day, hour"
    day_spine = "SELECT day, hour FROM (SELECT DISTINCT day FROM facts) CROSS JOIN hours"
    hour_axis = "SELECT weekday_no, takeoff_hour FROM days7 CROSS JOIN (SELECT DISTINCT takeoff_hour FROM clean)"
    runway_hour = (
        "SELECT runway, takeoff_hour FROM (SELECT DISTINCT runway FROM clean) "
        "CROSS JOIN (SELECT DISTINCT takeoff_hour FROM clean)"
    )
    runway_day = "SELECT weekday_no, runway FROM days7 CROSS JOIN (SELECT DISTINCT runway FROM clean)"
    type_axis = (
        "SELECT aircraft_type, takeoff_hour, weekday_no FROM (SELECT DISTINCT aircraft_type, takeoff_hour FROM clean "
        "WHERE aircraft_type IS NOT NULL) CROSS JOIN days7"
    )
    informative = "aircraft_type IS NOT NULL AND aircraft_type <> 'No category information'"
    types = f"SELECT icao, count(DISTINCT aircraft_type) AS n_types FROM tko WHERE {informative} GROUP BY icao"
    group_struct = (
        "CASE kind WHEN 'ident' THEN concat_ws('|', callsign, label) WHEN 'velocity' THEN "
        "concat_ws('|', st, speed, heading, vs, vt, k % 2, e % 2, 1 + e % 200, dalt) END"
    )
    both = "SELECT icao FROM points {where} GROUP BY icao HAVING max(ground) = 1 AND min(ground) = 0"
    return {
        "decode_messages": _with(
            "",
            "SELECT seq, ts_kafka, icao, dl::BIGINT AS dl, ca::BIGINT AS ca, tc::BIGINT AS tc, "
            "on_ground::BIGINT AS on_ground, msg_type FROM valid",
        ),
        "decode_ident": _with(
            "",
            "SELECT seq, icao, tc::BIGINT AS tc, callsign, (k % 8)::BIGINT AS category, label AS vortex, "
            "label AS aircraft_type FROM valid WHERE kind = 'ident'",
        ),
        "decode_surface": _with(
            "",
            f"SELECT seq, icao, tc::BIGINT AS tc, {_r('lat')}, {_r('lon')}, {_r('surf_speed', 'speed')}, "
            f"movement::BIGINT AS movement_code, {_r('track', 'ground_track')} FROM valid WHERE kind = 'surface'",
        ),
        "decode_airborne": _with(
            "",
            f"SELECT seq, icao, tc::BIGINT AS tc, {_r('lat')}, {_r('lon')}, {_r('alt_feet')}, "
            "CASE WHEN tc < 19 THEN 'airborne_barometric_alt' ELSE 'airborne_gnss_alt' END AS altitude_type, "
            "['no_condition', 'permanent_alert', 'temporary_alert', 'SPI_condition'][1 + rich * (p % 4)] AS surveillance_status, "
            "(rich * ((p // 4) % 2))::BIGINT AS single_antenna, (rich * ((p // 8) % 2))::BIGINT AS time_bit, "
            "CASE odd WHEN 0 THEN 'even_frame' ELSE 'odd_frame' END AS cpr_format FROM valid WHERE kind = 'airborne'",
        ),
        "decode_velocity": _with(
            "",
            f"SELECT seq, icao, speed::BIGINT AS speed, {_r('heading')}, vs::BIGINT AS vertical_rate, vt AS speed_type, "
            "st::BIGINT AS subtype, (rich * (p % 2))::BIGINT AS intent_change, 1::BIGINT AS ifr, (rich * (p % 8))::BIGINT AS nuc, "
            "(k % 2)::BIGINT AS vr_source, (e % 2)::BIGINT AS vr_sign, (1 + e % 200)::BIGINT AS vr_raw, (rich * (p % 2))::BIGINT AS sdif, "
            "dalt::BIGINT AS dalt, CASE WHEN st < 3 THEN e % 2 END::BIGINT AS dew, vew::BIGINT AS vew, "
            "CASE WHEN st < 3 THEN k % 2 END::BIGINT AS dns, CASE WHEN st > 2 THEN 1 END::BIGINT AS heading_status, "
            "hdg::BIGINT AS heading_raw, t::BIGINT AS airspeed_type FROM vel",
        ),
        "rejects": _with("", "SELECT seq, ts_kafka, 'corrupted' AS reject_reason FROM msg WHERE NOT intact"),
        "valid_allcall": _with(
            "", "SELECT seq, icao, on_ground::BIGINT AS on_ground FROM valid WHERE dl = 11 AND on_ground IS NOT NULL"
        ),
        "valid_frames": _with("", "SELECT dl::BIGINT AS dl, count(*) AS n FROM valid GROUP BY dl"),
        "valid_adsb": _with(
            "", "SELECT msg_type, count(*) AS n FROM valid WHERE msg_type IS NOT NULL GROUP BY msg_type"
        ),
        "adsb_version": _with(
            "",
            "SELECT icao, coalesce(arg_max(e % 3, rn) FILTER (WHERE kind = 'status'), 0)::BIGINT AS version "
            "FROM valid GROUP BY icao",
        ),
        "occupancy": _with(f, "SELECT day, hour, icao, on_ground FROM facts"),
        "hour_ground_counts": _with(f, hour_counts.format(where=_day("02/01/2024"))),
        "hourly_dense": _with(
            f,
            _dense(
                hour_counts.format(where=_day("02/01/2024")),
                "SELECT hour, unnest([0, 1]) AS on_ground FROM hours",
                "hour, on_ground",
                "n",
            ),
        ),
        "axis_max": _with(
            f,
            "SELECT (ceil(coalesce(max(n), 0) / 10.0) * 10)::BIGINT AS axis_max FROM (SELECT count(*) AS n FROM facts "
            "WHERE day IN ('02/01/2024', '05/01/2024') GROUP BY day, hour, on_ground)",
        ),
        "weekday_traffic": _with(
            f,
            "SELECT day, (isodow(strptime(day, '%d/%m/%Y')) - 1)::BIGINT AS weekday_no, "
            f"{_list(WEEKDAYS_ES)}[isodow(strptime(day, '%d/%m/%Y'))] AS weekday, "
            f"CASE on_ground WHEN 1 THEN '{GROUND_LABELS[1]}' ELSE '{GROUND_LABELS[0]}' END AS state, count(*) AS n "
            "FROM facts GROUP BY day, on_ground",
        ),
        "day_hour_matrix": _with(f, matrix.format(where="")),
        "ground_by_hour": _with(f, matrix.format(where="WHERE on_ground = 1")),
        "air_by_hour": _with(f, matrix.format(where="WHERE on_ground = 0")),
        "day_hour_dense_ground": _with(f, _dense(matrix.format(where="WHERE on_ground = 1"), day_spine, "day, hour", "n")),
        "day_hour_dense_air": _with(f, _dense(matrix.format(where="WHERE on_ground = 0"), day_spine, "day, hour", "n")),
        "distinct_days": _with(f, "SELECT DISTINCT day FROM facts"),
        "takeoffs": _with(t, f"SELECT {_TKO} FROM tko"),
        "takeoff_runway": _with(t, f"SELECT {_TKO}, runway FROM tko"),
        "waits_clean": _with(t, f"SELECT {_TKO}, runway FROM clean"),
        "aircraft_lookup": _with(t, f"SELECT {_TKO}, runway FROM tko WHERE icao = '340005'"),
        "wait_stats": _with(
            t,
            f"SELECT takeoff_date, takeoff_hour, {_r('avg(wait_s)', 'mean_s')}, {_r('median(wait_s)', 'median_s')}, "
            "count(*) AS n_takeoffs FROM tko GROUP BY 1, 2",
        ),
        "takeoffs_weekday_hour": _with(
            t,
            _dense(
                "SELECT weekday_no, takeoff_hour, count(*) AS n FROM clean GROUP BY 1, 2",
                hour_axis,
                "weekday_no, takeoff_hour",
                "n",
            ),
        ),
        "takeoffs_type_weekday_hour": _with(
            t,
            _dense(
                "SELECT aircraft_type, takeoff_hour, weekday_no, count(*) AS n FROM clean GROUP BY 1, 2, 3",
                type_axis,
                "aircraft_type, takeoff_hour, weekday_no",
                "n",
            ),
        ),
        "wait_type_hour": _with(
            t,
            f"SELECT aircraft_type, takeoff_hour, {_MEAN} FROM clean WHERE aircraft_type IS NOT NULL GROUP BY 1, 2",
        ),
        "wait_weekday_hour": _with(
            t,
            _dense(
                f"SELECT weekday_no, takeoff_hour, {_MEAN} FROM clean GROUP BY 1, 2",
                hour_axis,
                "weekday_no, takeoff_hour",
                "mean_wait_s",
            ),
        ),
        "takeoffs_weekday_runway": _with(
            t,
            _dense(
                "SELECT weekday_no, runway, count(*) AS n FROM clean GROUP BY 1, 2", runway_day, "weekday_no, runway", "n"
            ),
        ),
        "takeoffs_runway_hour": _with(
            t,
            _dense(
                "SELECT runway, takeoff_hour, count(*) AS n FROM clean GROUP BY 1, 2",
                runway_hour,
                "runway, takeoff_hour",
                "n",
            ),
        ),
        "wait_runway_weekday": _with(
            t,
            _dense(
                f"SELECT weekday_no, runway, {_MEAN} FROM clean GROUP BY 1, 2",
                runway_day,
                "weekday_no, runway",
                "mean_wait_s",
            ),
        ),
        "wait_runway_hour": _with(
            t,
            _dense(
                f"SELECT runway, takeoff_hour, {_MEAN} FROM clean GROUP BY 1, 2",
                runway_hour,
                "runway, takeoff_hour",
                "mean_wait_s",
            ),
        ),
        "wait_box": _with(
            t + ", typed AS (SELECT * FROM tko WHERE aircraft_type IS NOT NULL)", _box("typed", "aircraft_type")
        ),
        "wait_box_clean": _with(
            t + ", typed AS (SELECT * FROM clean WHERE aircraft_type IS NOT NULL)", _box("typed", "aircraft_type")
        ),
        "wait_box_selected": _with(
            t
            + ", chosen AS (SELECT * FROM tko WHERE wait_s > 60 AND wait_s < 1800 AND runway IS NOT NULL), frequent AS "
            "(SELECT * FROM chosen WHERE icao IN (SELECT icao FROM chosen GROUP BY icao ORDER BY count(*) DESC, icao LIMIT 10))",
            _box("frequent", "icao"),
        ),
        "wait_box_overall": _with(t, _box("tko", None)),
        "wait_box_top": _with(
            t
            + ", frequent AS (SELECT * FROM tko WHERE icao IN "
            "(SELECT icao FROM tko GROUP BY icao ORDER BY count(*) DESC, icao LIMIT 10))",
            _box("frequent", "icao"),
        ),
        "wait_describe": _with(
            t,
            f"SELECT count(*) AS count, {_r('avg(wait_s)', 'mean')}, {_r('stddev_samp(wait_s)', 'std')}, "
            f"{_r('min(wait_s)', 'min')}, {_r('quantile_cont(wait_s, 0.25)', 'q1')}, "
            f"{_r('quantile_cont(wait_s, 0.5)', 'median')}, {_r('quantile_cont(wait_s, 0.75)', 'q3')}, "
            f"{_r('max(wait_s)', 'max')} FROM tko",
        ),
        "wait_hist": _with(t, _hist("tko", "wait_s")),
        "takeoffs_per_hour": _with(t, "SELECT takeoff_hour, count(*) AS n FROM tko GROUP BY 1"),
        "takeoffs_per_weekday": _with(
            t,
            f"SELECT weekday_no, {_list(WEEKDAY_LETTERS)}[weekday_no + 1] AS weekday, count(*) AS n FROM tko GROUP BY 1",
        ),
        "takeoffs_per_type": _with(
            t, "SELECT aircraft_type, count(*) AS n FROM tko WHERE aircraft_type IS NOT NULL GROUP BY 1"
        ),
        "max_wait_per_type": _with(
            t,
            f"SELECT aircraft_type, {_r('max(wait_s)', 'max_wait_s')} FROM tko WHERE aircraft_type IS NOT NULL GROUP BY 1",
        ),
        "top_aircraft": _with(
            t, "SELECT icao, count(*) AS n_takeoffs FROM tko GROUP BY icao ORDER BY n_takeoffs DESC, icao LIMIT 10"
        ),
        "types_per_aircraft": _with(t, types),
        "multi_type_aircraft": _with(t, f"SELECT * FROM ({types}) WHERE n_types > 1"),
        "aircraft_type_crosstab": _with(
            t,
            f"SELECT icao, aircraft_type, count(DISTINCT wait_ms) AS n FROM tko WHERE {informative} GROUP BY 1, 2",
        ),
        "aircraft_type_totals": _with(
            w,
            "SELECT vortex, count(*) AS n FROM (SELECT DISTINCT icao, vortex, ts_kafka FROM maps WHERE vortex IS NOT NULL "
            "AND vortex <> 'No category information') GROUP BY 1",
        ),
        "known_state": _with(",", _known(None)),
        "known_state_ttl": _with(",", _known(1800000)),
        "state_changes": _with(
            f""",
            known AS (
              SELECT v.seq, v.ts_kafka, v.icao, v.msg_type, v.rn, v.st, {group_struct} AS body,
                     CASE v.st WHEN 1 THEN concat_ws('|', v.e % 2, w.vew, v.k % 2) WHEN 3 THEN concat_ws('|', w.hdg, w.t) END AS extra
              FROM valid v LEFT JOIN (SELECT rn, speed, heading, vs, vt, dalt, vew, hdg, t FROM vel) w ON w.rn = v.rn
              WHERE v.msg_type IS NOT NULL),
            steps AS (
              SELECT *, lag(body) OVER (PARTITION BY icao, msg_type ORDER BY rn) AS body0,
                     lag(extra) OVER (PARTITION BY icao, msg_type, st ORDER BY rn) AS extra0 FROM known)""",
            "SELECT ts_kafka, seq, icao, msg_type FROM steps WHERE msg_type IN ('surface', 'airborne') "
            "OR body IS DISTINCT FROM body0 OR extra IS DISTINCT FROM extra0",
        ),
        "anchor_windows": _with(w, "SELECT icao, anchor FROM anchors"),
        "window_states": _with(w, f"SELECT {_STATE} FROM states"),
        "direction": _with(w, f"SELECT icao, ts_kafka, {_r('direction_rad')}, {_r('bearing_rad')} FROM maps"),
        "map_points": _with(
            w,
            f"SELECT icao, ts_kafka, {_r('lat')}, {_r('lon')}, ground FROM points "
            "WHERE ts_kafka BETWEEN 1704240000000 AND 1704247200000",
        ),
        "map_points_day": _with(
            w,
            f"SELECT icao, ts_kafka, {_r('lat')}, {_r('lon')}, ground FROM points "
            "WHERE ts_kafka BETWEEN 1704240000000 AND 1704326400000",
        ),
        "hour_spine": _with(
            ", bounds AS (SELECT date_trunc('day', make_timestamp(min(ts_kafka) * 1000)) AS lo, "
            "date_trunc('day', make_timestamp(max(ts_kafka) * 1000)) + INTERVAL 23 HOUR AS hi FROM msg)",
            "SELECT row_number() OVER (ORDER BY h) - 1 AS slot, epoch_ms(h) AS hour_start "
            "FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS h FROM bounds)",
        ),
        "trails": _with(
            w,
            f"SELECT icao, ts_kafka, count(*) OVER o AS n_points, {_r('first_value(lon) OVER o', 'first_lon')}, "
            f"{_r('first_value(lat) OVER o', 'first_lat')}, {_r('lon', 'last_lon')}, {_r('lat', 'last_lat')} "
            "FROM points WINDOW o AS (PARTITION BY icao ORDER BY ts_kafka ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)",
        ),
        "flights": _with(
            w,
            "SELECT icao, flight_rank, max(callsign) AS callsign, min(ts_kafka) AS first_ms, max(ts_kafka) AS last_ms, "
            f"count(*) AS n_points, {_r('greatest(0.0, 1.0 - 0.45::DOUBLE * flight_rank)', 'opacity')} "
            "FROM ranked GROUP BY icao, flight_rank",
        ),
        "decode_compat": _with(
            "",
            "SELECT seq, (SELECT label FROM labels_by_code l WHERE l.tc = v.tc AND l.cat = v.ca) AS aircraft_type "
            "FROM valid v WHERE kind = 'ident'",
        ),
        "category_labels": _with(
            "", "SELECT seq, tc::BIGINT AS tc, (k % 8)::BIGINT AS category, label FROM valid WHERE kind = 'ident'"
        ),
        "takeoffs_product": _with(t, f"SELECT {_TKO}, runway FROM tko"),
        "window_states_product": _with(
            w, f"SELECT {_STATE} FROM states WHERE make_timestamp(ts_kafka * 1000) >= TIMESTAMP '2024-01-03'"
        ),
        "window_states_roundtrip": _with(w, f"SELECT {_STATE} FROM states"),
        "flight_points": _with(
            w,
            "SELECT icao, leg::BIGINT AS flight_no, ts_kafka, round(lat, 3) + 0.0 AS lat, round(lon, 3) + 0.0 AS lon, "
            f"{_r('velocity')}, {_r('alt_feet')}, callsign FROM ranked",
        ),
        "current_route": _with(
            w, f"SELECT icao, pos, ts_kafka, lat, lon, {_r('velocity')}, {_r('alt_feet')}, callsign FROM route"
        ),
        "segments": _with(
            w,
            "SELECT icao, pos, lat AS from_lat, lon AS from_lon, to_lat, to_lon, "
            f"{_COLOR} AS color, callsign FROM (SELECT *, lead(lat) OVER (PARTITION BY icao ORDER BY pos) AS to_lat, "
            "lead(lon) OVER (PARTITION BY icao ORDER BY pos) AS to_lon FROM route) WHERE to_lat IS NOT NULL",
        ),
        "segment_counts": _with(w, "SELECT icao, count(*) - 1 AS n_segments FROM route GROUP BY icao"),
        "height_profile": _with(
            w
            + ", heights AS (SELECT icao, row_number() OVER (PARTITION BY icao ORDER BY ts_kafka) - 1 AS pos, "
            "alt_feet AS height FROM points WHERE alt_feet IS NOT NULL)",
            f"SELECT h.icao, h.pos, {_r('height')}, r.lat, r.lon FROM heights h "
            "LEFT JOIN route r ON r.icao = h.icao AND r.pos = h.pos",
        ),
        "latest_state": _with(
            w,
            "SELECT icao, ts_kafka, round(lat, 3) AS lat, round(lon, 3) AS lon, ground, "
            f"{_r('degrees(direction_rad)', 'rotation_deg')}, {_r('velocity')}, callsign, vortex AS vehicle_type, "
            "coalesce(vortex = 'Rotorcraft', false)::BIGINT AS is_rotorcraft, "
            "CASE WHEN velocity <> 0 THEN printf('%.3f', velocity) ELSE '-' END AS speed_text, "
            "strftime(make_timestamp(ts_kafka * 1000), '%Y-%m-%d %H:%M:%S') AS time_text "
            "FROM points QUALIFY row_number() OVER (PARTITION BY icao ORDER BY ts_kafka DESC) = 1",
        ),
        "aircraft_series": _with(
            w, f"SELECT ts_kafka, {_r('velocity')}, ground, {_r('alt_feet')} FROM maps WHERE icao = '340005'"
        ),
        "ground_and_air": _with(w, both.format(where="")),
        "ground_and_air_rows": _with(
            w,
            "SELECT icao, count(*) AS n FROM points WHERE icao IN ("
            + both.format(where="WHERE vortex = 'Medium 1 (between 7000 kg and 34000 kg)'")
            + ") GROUP BY icao",
        ),
        "geojson": _with(
            w
            + ", shown AS (SELECT icao, ts_kafka, callsign, ground, round(lat, 6) + 0.0 AS lat, round(lon, 6) + 0.0 AS lon, "
            "round(velocity, 6) + 0.0 AS velocity, round(degrees(direction_rad), 3) + 0.0 AS rotation, "
            "strftime(make_timestamp(ts_kafka * 1000), '%Y-%m-%d %H:%M:%S') AS at_text FROM points), "
            "lines AS (SELECT icao, ts_kafka, at_text, count(*) OVER o AS size, "
            "string_agg('[' || lon::VARCHAR || ',' || lat::VARCHAR || ']', ',') OVER o AS places "
            "FROM shown WINDOW o AS (PARTITION BY icao ORDER BY ts_kafka ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))",
            f"SELECT 'marker' AS kind, icao, ts_kafka, {_MARKER} AS feature FROM shown UNION ALL "
            f"SELECT 'trail', icao, ts_kafka, {_TRAIL} FROM lines",
        ),
        "max_speed_hist_air": _with(w + _most(0), _hist("most", "max_speed")),
        "max_speed_hist_ground": _with(w + _most(1), _hist("most", "max_speed")),
        "max_altitude_hist": _with(w + _most(0), _hist("most", "max_alt_feet")),
        "rows_per_aircraft": _with(w, "SELECT icao, count(*) AS n FROM maps GROUP BY icao"),
        "max_speed": _with(
            w,
            f"SELECT icao, ground, {_r('max(velocity)', 'max_speed')}, {_r('max(alt_feet)', 'max_alt_feet')} "
            "FROM points GROUP BY icao, ground",
        ),
        "altitude_hist": _with(w, _hist("points", "alt_feet")),
        "null_profile": _with(w, " UNION ALL ".join(_profile_column(c) for c in _PROFILED)),
        "null_corr": _with(
            w,
            " UNION ALL ".join(
                _null_pair(a, b) for i, a in enumerate(_NULLABLE) for b in _NULLABLE[i + 1 :]
            ),
        ),
            # streams: results whose window the watermark (10 minutes behind the newest row) has passed
        "stream_decode": _with(
            "",
            "SELECT seq, ts_kafka, icao, dl::BIGINT AS dl, tc::BIGINT AS tc, msg_type FROM valid",
        ),
        "stream_rejects": _with("", "SELECT seq, ts_kafka, 'corrupted' AS reject_reason FROM msg WHERE NOT intact"),
        "stream_without_repeats": _with(
            """, sent AS (
              SELECT seq, icao, unnest(CASE WHEN seq % 10 = 0 THEN [0, 1000] ELSE [0] END) + ts_kafka AS ts_kafka,
                     concat_ws('|', ca, tc, CASE WHEN kind = 'ident' THEN k % 8 END, callsign, lat, lon, movement, track, alt_feet, odd * (lat IS NOT NULL)::INTEGER,
                       CASE WHEN kind = 'velocity' THEN concat_ws('|', st, vx, vy, k % 50, e % 200, e % 2, k % 2, (e * 11) % 1024, (k * 5) % 500) END,
                       CASE WHEN kind = 'surface' THEN concat_ws('|', (k // 2) % 2, e % 128) END,
                       CASE WHEN kind = 'airborne' THEN (e * 13) % 4096 END, CASE WHEN kind = 'airborne' THEN (e * 13) % 1600 END,
                       CASE WHEN kind = 'status' THEN e % 3 END) AS body
              FROM valid),
            marked AS (SELECT *, CASE WHEN ts_kafka - lag(ts_kafka) OVER o <= 5000 THEN 0 ELSE 1 END AS starts
                       FROM sent WINDOW o AS (PARTITION BY icao, body ORDER BY ts_kafka, seq)),
            numbered AS (SELECT *, sum(starts) OVER (PARTITION BY icao, body ORDER BY ts_kafka, seq ROWS UNBOUNDED PRECEDING) AS run FROM marked)""",
            "SELECT icao, min(ts_kafka) AS ts_kafka, arg_min(seq, (ts_kafka, seq)) AS seq, count(*) AS n_copies FROM numbered "
            "GROUP BY icao, body, run HAVING max(ts_kafka) + 5000 <= (SELECT max(ts_kafka) - 600000 FROM sent)",
        ),
        "stream_window_states": _with(
            w.replace("placed AS (SELECT v.*, a.anchor FROM valid v ASOF JOIN anchors a ON v.icao = a.icao AND v.ts_kafka >= a.anchor)",
                      "placed AS (SELECT *, ts_kafka // 3600000 * 3600000 AS anchor FROM valid)"),
            f"SELECT {_STATE.replace('anchor', 'anchor AS window_ms')} FROM states "
            "WHERE anchor + 3600000 <= (SELECT max(ts_kafka) - 600000 FROM valid)",
        ),
        "stream_occupancy": _with(
            "",
            "SELECT ts_kafka // 3600000 * 3600000 AS hour_ms, on_ground::BIGINT AS on_ground, count(DISTINCT icao) AS n "
            "FROM valid WHERE dl = 11 AND on_ground IS NOT NULL GROUP BY 1, 2 "
            "HAVING hour_ms + 3600000 <= (SELECT max(ts_kafka) - 600000 FROM valid WHERE dl = 11 AND on_ground IS NOT NULL)",
        ),
        "stream_takeoffs": _with(
            t,
            f"SELECT icao, seq, last_stopped_ms, takeoff_ms, wait_ms, {_r('wait_s')}, aircraft_type, {_r('lat')}, {_r('lon')}, "
            "runway FROM tko WHERE takeoff_ms <= (SELECT max(ts_kafka) - 600000 FROM marks WHERE is_air OR kind IN ('surface', 'ident'))",
        ),
        "stream_sessions": _with(
            """, marked AS (SELECT *, CASE WHEN ts_kafka - lag(ts_kafka) OVER (PARTITION BY icao ORDER BY rn) <= 1800000 THEN 0 ELSE 1 END AS starts FROM valid),
            numbered AS (SELECT *, sum(starts) OVER (PARTITION BY icao ORDER BY rn ROWS UNBOUNDED PRECEDING) AS run FROM marked)""",
            "SELECT icao, min(ts_kafka) AS start_ms, max(ts_kafka) + 1800000 AS end_ms, count(*) AS n_messages FROM numbered "
            "GROUP BY icao, run HAVING end_ms <= (SELECT max(ts_kafka) - 600000 FROM valid)",
        ),
        "takeoff_runway_table": _with(t, f"SELECT {_TKO}, runway FROM tko"),
        "decoded_csv": _with(
            "",
            "SELECT ts_kafka, dl::BIGINT AS dl, icao, ca::BIGINT AS ca, on_ground::BIGINT AS on_ground, label AS aircraft_type, ts_kafka AS ts, "
            "strftime(make_timestamp(ts_kafka * 1000), '%Y-%m-%d') AS date, extract(hour FROM make_timestamp(ts_kafka * 1000))::BIGINT AS hour, "
            "tc::BIGINT AS tc FROM valid",
        ),
        "raw_range_scan": _with(
            "",
            "SELECT ts_kafka, CASE kind WHEN 'allcall' THEN 12 ELSE 20 END::BIGINT AS n_chars, NULL::VARCHAR AS line FROM msg "
            "WHERE ts_kafka BETWEEN 1704240000000 AND 1704240000000 + 2 * 86400000 - 1",
        ),
        "first_messages": _with("", "SELECT seq, ts_kafka, icao, dl::BIGINT AS dl FROM valid WHERE rn <= 10"),
        "time_order": _with("", "SELECT count(*) AS n, 0::BIGINT AS backwards FROM valid"),
        "occupancy_sketch": _with(f, "SELECT day, on_ground, count(DISTINCT icao) AS n_exact, 1::BIGINT AS in_bound FROM facts GROUP BY day, on_ground"),
        "sql_takeoffs_between": _with(
            """, inside AS (SELECT *, dl = 11 AND coalesce(on_ground = 0, false) AS is_air FROM valid
              WHERE ts_kafka BETWEEN 1704240000000 AND 1704240000000 + 3 * 86400000),
            legs_t AS (SELECT *, coalesce(sum(is_air::INTEGER) OVER (PARTITION BY icao ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS leg FROM inside),
            stops_t AS (SELECT *, max(CASE WHEN surf_speed = 0 THEN ts_kafka END) OVER (PARTITION BY icao, leg ORDER BY rn ROWS UNBOUNDED PRECEDING) AS stop FROM legs_t)""",
            f"SELECT icao, stop AS last_stopped_ms, ts_kafka AS takeoff_ms, {_r('(ts_kafka - stop) / 1000.0::DOUBLE', 'wait_s')} FROM stops_t WHERE is_air AND stop IS NOT NULL",
        ),
        "sql_known_state_of": _with(
            """, own AS (SELECT *, max(CASE WHEN kind = 'ident' THEN rn END) OVER o AS ri, max(CASE WHEN kind = 'airborne' THEN rn END) OVER o AS ra,
                max(CASE WHEN kind = 'velocity' THEN rn END) OVER o AS rw FROM valid WHERE icao = '340005' AND msg_type IS NOT NULL
                AND ts_kafka BETWEEN 1704240000000 AND 1704326400000 WINDOW o AS (ORDER BY rn ROWS UNBOUNDED PRECEDING))""",
            f"SELECT o.ts_kafka, o.seq, i.callsign, {_r('a.lat', 'lat')}, {_r('a.lon', 'lon')}, {_r('a.alt_feet', 'alt_feet')}, w.speed::BIGINT AS speed "
            "FROM own o LEFT JOIN valid i ON i.rn = o.ri LEFT JOIN valid a ON a.rn = o.ra LEFT JOIN vel w ON w.rn = o.rw",
        ),
        "sql_day_hours": _with(
            "",
            "SELECT strftime(make_timestamp(ts_kafka * 1000), '%d/%m/%Y') AS day, extract(hour FROM make_timestamp(ts_kafka * 1000))::BIGINT AS hour, "
            "dl::BIGINT AS dl, count(*) AS n, count(DISTINCT icao) AS n_icao FROM msg GROUP BY ALL",
        ),
        "stream_product": _with(
            "",
            "SELECT seq, ts_kafka, dl::BIGINT AS dl, icao, ca::BIGINT AS ca, on_ground::BIGINT AS on_ground, tc::BIGINT AS tc, "
            "strftime(make_timestamp(ts_kafka * 1000), '%Y-%m-%d') AS date, extract(hour FROM make_timestamp(ts_kafka * 1000))::BIGINT AS hour "
            "FROM valid",
        ),
        "stream_late_rows": _with(
            """, sent AS (SELECT *, ts_kafka + CASE WHEN e % 23 = 0 THEN 7200000 ELSE 0 END AS arrival FROM msg),
            size AS (SELECT min(arrival) AS lo, max(arrival) AS hi, greatest(8, ceil(count(*) / 1000000.0))::BIGINT AS files FROM sent),
            slots AS (SELECT s.*, (arrival - lo) * files // (hi - lo + 1) AS slot FROM sent s, size),
            largest AS (SELECT slot, max(ts_kafka) FILTER (WHERE intact) AS most FROM slots GROUP BY slot),
            marks_l AS (SELECT slot, max(most) OVER (ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 600000 AS mark FROM largest)""",
            "SELECT seq, ts_kafka, CASE WHEN NOT intact THEN 'reject' WHEN ts_kafka <= mark THEN 'late' ELSE 'on_time' END AS fate, "
            "CASE WHEN NOT intact THEN 'corrupted' WHEN ts_kafka <= mark THEN 'behind_watermark' END AS reason FROM slots JOIN marks_l USING (slot)",
        ),
    }
