"""Snapshot histories, sliding traffic and rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from delaylens.constants import FEATURE_LABELS, TRAFFIC_WINDOWS
from delaylens.functions import text
from delaylens.operators import history, traffic
from delaylens.plans.catalog import query
from delaylens.plans.testdata import airports, flights, positions, predictions, table, weather, with_cte

_SLIDE = (
    "SELECT airport, icao24, unnest(generate_series(CAST(floor(time / 300) AS BIGINT) + 1, CAST(floor(time / 300) AS BIGINT) + {n})) * 300 "
    "AS window_end FROM sightings"
)


def _sliding_sql(hours: int) -> str:
    return with_cte(
        "airports positions sightings",
        f"SELECT airport, window_end, count(DISTINCT icao24) AS n FROM ({_SLIDE.format(n=12 * hours)}) s GROUP BY 1, 2",
    )


@query("sightings", with_cte("airports positions sightings", "SELECT airport, icao24, time FROM sightings"))
def sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.sightings(positions(spark, sf_dir))


@query("sliding_distinct_1h", _sliding_sql(1))
def sliding_distinct_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct aircraft per airport in 1h windows every 5 minutes."""
    return traffic.sliding_distinct(traffic.sightings(positions(spark, sf_dir)), 3600)


@query("sliding_distinct_3h", _sliding_sql(3))
def sliding_distinct_3h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.sliding_distinct(traffic.sightings(positions(spark, sf_dir)), 10800)


@query(
    "sliding_distinct_dense",
    "SELECT event_type AS airport, (unnest(generate_series(1, 12)) + CAST(floor(epoch(ts) / 300) AS BIGINT)) * 300 AS window_end, "
    "user_id FROM events".join(
        ["SELECT airport, window_end, count(DISTINCT user_id) AS n FROM (", ") s GROUP BY 1, 2"]
    ),
)
def sliding_distinct_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over all events by type, a few heavy keys."""
    seen = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("airport"), "user_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("time")
    )
    return traffic.sliding_distinct(seen, 3600, entity="user_id")


@query("sliding_distinct_direct", _sliding_sql(1))
def sliding_distinct_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The copy-into-windows form, for comparison."""
    return traffic.sliding_distinct_direct(traffic.sightings(positions(spark, sf_dir)), 3600)


def current_sql(carry_forward: bool) -> str:
    """Reads the adapters airports, positions and sightings."""
    newest = "" if carry_forward else " AND window_end = (latest + 300) // 300 * 300"
    picks = ", ".join(
        f"coalesce((SELECT arg_max(n, window_end) FROM (SELECT airport AS a, window_end, count(DISTINCT icao24) AS n FROM "
        f"({_SLIDE.format(n=12 * h)}) s GROUP BY 1, 2) c, (SELECT CAST(max(time) AS BIGINT) AS latest FROM positions) l "
        f"WHERE c.a = airports.airport AND window_end <= latest + 300{newest}), 0) AS traffic_{h}h"
        for h in (1, 3)
    )
    return f"SELECT airport, {picks} FROM airports"


def _current(carry_forward: bool) -> str:
    return with_cte("airports positions sightings", current_sql(carry_forward))


def _current_window(spark: SparkSession, sf_dir: str, carry_forward: bool) -> DataFrame:
    p = positions(spark, sf_dir)
    latest = p.agg(F.max("time")).scalar()
    counts = traffic.rolling_counts(traffic.sightings(p), latest=None if carry_forward else latest)
    rows = history.current_window(counts, airports(spark), latest, list(TRAFFIC_WINDOWS), carry_forward)
    return rows.select("airport", "traffic_1h", "traffic_3h")


@query("current_window", _current(True))
def current_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest non-empty window per airport, however old."""
    return _current_window(spark, sf_dir, True)


@query("current_window_strict", _current(False))
def current_window_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window of now; quiet airports get 0."""
    return _current_window(spark, sf_dir, False)


@query(
    "latest_state",
    with_cte("positions", "SELECT event_id, icao24, time FROM positions WHERE time = (SELECT max(time) FROM positions)"),
)
def latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.latest_state(positions(spark, sf_dir)).select("event_id", "icao24", "time")


@query(
    "last_n_track",
    with_cte(
        "positions",
        "SELECT icao24, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS track FROM (SELECT icao24, event_id, row_number() "
        "OVER (PARTITION BY icao24 ORDER BY time DESC, event_id DESC) AS rn FROM positions WHERE lat IS NOT NULL) p WHERE rn <= 15 GROUP BY icao24",
    ),
)
def last_n_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last 15 positions of every aircraft, oldest first."""
    located = positions(spark, sf_dir).where("lat is not null")
    tracks = history.last_n_track(located, "icao24", "time", ["event_id", "lon", "lat"])
    ids = F.transform("track", lambda s: s["event_id"].cast("string"))
    return tracks.select("icao24", F.array_join(ids, ",").alias("track"))


_RECENT = "SELECT * FROM predictions WHERE time IN (SELECT DISTINCT time FROM predictions ORDER BY time DESC LIMIT 120)"


@query(
    "aircraft_series",
    with_cte(
        "positions",
        "SELECT icao24, string_agg(coalesce(CAST(CAST(round_even(baro_altitude, 0) AS BIGINT) AS VARCHAR), 'n/a'), ',' ORDER BY event_id) AS altitude, "
        "string_agg(coalesce(CAST(CAST(round_even(velocity * 3.6::DOUBLE, 0) AS BIGINT) AS VARCHAR), 'n/a'), ',' ORDER BY event_id) AS speed FROM (SELECT *, "
        "row_number() OVER (PARTITION BY icao24 ORDER BY time DESC, event_id DESC) AS rn FROM positions WHERE lat IS NOT NULL) p WHERE rn <= 15 GROUP BY icao24",
    ),
)
def aircraft_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Altitude and speed of every aircraft over its last 15 positions."""
    located = positions(spark, sf_dir).where("lat is not null")
    tracks = history.last_n_track(located, "icao24", "time", ["event_id", "baro_altitude", "velocity"])
    altitude = F.transform("track", lambda p: text.whole_number(p["baro_altitude"]))
    speed = F.transform("track", lambda p: text.whole_number(p["velocity"] * 3.6))
    return tracks.select("icao24", F.array_join(altitude, ",").alias("altitude"), F.array_join(speed, ",").alias("speed"))


@query(
    "trend_series",
    with_cte(
        "flights predictions",
        "SELECT airport, string_agg(CAST(CAST(round_even(risk_score * 100, 0) AS BIGINT) AS VARCHAR), ',' ORDER BY time) AS series "
        f"FROM ({_RECENT}) p GROUP BY airport",
    ),
)
def trend_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Risk percentages per airport over the newest 120 snapshots."""
    rows = history.risk_trend(predictions(spark, sf_dir))
    return rows.select("airport", F.array_join(F.transform("series", lambda v: v.cast("string")), ",").alias("series"))


@query(
    "bounded_history",
    with_cte("flights predictions", f"SELECT airport, time, round(risk_score, 6) AS risk_score FROM ({_RECENT}) p"),
)
def bounded_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = history.bounded_history(predictions(spark, sf_dir))
    return rows.select("airport", "time", F.round("risk_score", 6).alias("risk_score"))


@query(
    "snapshot_delta",
    with_cte(
        "flights predictions",
        "SELECT airport, f AS from_pct, t AS to_pct, t - f AS delta_pts FROM (SELECT airport, max(CASE WHEN r = 2 THEN pct END) AS f, "
        "max(CASE WHEN r = 1 THEN pct END) AS t FROM (SELECT airport, CAST(floor(risk_score * 100 + 0.5::DOUBLE) AS BIGINT) AS pct, "
        "dense_rank() OVER (ORDER BY time DESC) AS r FROM predictions) p WHERE r <= 2 GROUP BY airport) q "
        "WHERE f <> t ORDER BY abs(t - f) DESC, airport LIMIT 6",
    ),
)
def snapshot_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changed between the two newest snapshots (a top-6 report)."""
    return history.snapshot_delta(predictions(spark, sf_dir))


@query(
    "change_series",
    with_cte(
        "flights predictions",
        "SELECT airport, time, b AS from_pct, pct AS to_pct, pct - b AS delta_pts FROM (SELECT p.airport, p.time, p.pct, q.pct AS b FROM "
        "(SELECT airport, time, CAST(floor(risk_score * 100 + 0.5::DOUBLE) AS BIGINT) AS pct, dense_rank() OVER (ORDER BY time) AS r "
        "FROM predictions) p JOIN (SELECT airport, CAST(floor(risk_score * 100 + 0.5::DOUBLE) AS BIGINT) AS pct, dense_rank() OVER "
        "(ORDER BY time) AS r FROM predictions) q ON p.airport = q.airport AND p.r = q.r + 1) z WHERE b <> pct",
    ),
)
def change_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change from one snapshot to the next, over all history."""
    return history.change_series(predictions(spark, sf_dir), "airport", "time", "risk_score")


@query(
    "load_series",
    with_cte(
        "airports positions sightings",
        "SELECT t.time, a.airport, count(s.icao24) AS n FROM (SELECT DISTINCT time FROM positions) t CROSS JOIN airports a "
        "LEFT JOIN sightings s ON s.time = t.time AND s.airport = a.airport GROUP BY 1, 2",
    ),
)
def load_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aircraft near each airport per snapshot, zeros included."""
    return traffic.load_series(positions(spark, sf_dir))


@query(
    "load_range",
    with_cte(
        "airports positions sightings",
        "SELECT airport, min(n) AS low, max(n) AS high, arg_max(n, time) AS current FROM (SELECT t.time, a.airport, count(s.icao24) AS n "
        "FROM (SELECT DISTINCT time FROM positions) t CROSS JOIN airports a LEFT JOIN sightings s ON s.time = t.time "
        "AND s.airport = a.airport GROUP BY 1, 2) x GROUP BY airport",
    ),
)
def load_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.load_range(traffic.load_series(positions(spark, sf_dir)))


_LATEST_RISK = (
    "latest AS (SELECT airport, arg_max(risk_score, time) AS risk_score, arg_max(live_traffic_count, time) AS n FROM predictions GROUP BY airport)"
)


def _latest_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = predictions(spark, sf_dir).groupBy("airport").agg(
        F.max_by("risk_score", "time").alias("risk_score"), F.max_by("live_traffic_count", "time").alias("n")
    )
    return airports(spark).join(newest, "airport")


@query(
    "rank_by_risk",
    with_cte("airports flights predictions", "SELECT 1").removesuffix(" SELECT 1")
    + f", {_LATEST_RISK} SELECT airport, round(risk_score, 6) AS risk_score, row_number() OVER (ORDER BY risk_score DESC, ordinal) AS rank "
    "FROM airports JOIN latest USING (airport)",
)
def rank_by_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airports by newest risk; the rank is over the few airports."""
    rows = history.rank_by_risk(_latest_risk(spark, sf_dir))
    rank = F.row_number().over(Window.orderBy(F.col("risk_score").desc(), "ordinal"))
    return rows.select("airport", F.round("risk_score", 6).alias("risk_score"), rank.cast("bigint").alias("rank"))


@query(
    "top1",
    with_cte(
        "airports flights predictions",
        "SELECT time, airport, round(risk_score, 6) AS risk_score FROM (SELECT time, airport, risk_score, row_number() OVER (PARTITION BY time "
        "ORDER BY risk_score DESC, ordinal) AS rn FROM predictions JOIN airports USING (airport)) p WHERE rn = 1",
    ),
)
def top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The riskiest airport of every snapshot."""
    rows = predictions(spark, sf_dir).join(F.broadcast(airports(spark)), "airport")
    peaks = history.peak(rows, ["time"], "airport", "risk_score", "ordinal")
    return peaks.withColumn("risk_score", F.round("risk_score", 6))


# three made contributions per row, from columns
_CONTRIBUTIONS = {
    "traffic_1h": "(k - 50) / 100",
    "typecode": "(user_id - 75) / 100",
    "wind_speed_10m": "CASE WHEN k % 3 = 0 THEN 0 ELSE (k % 40 - 20) / 50 END",
    "month": "CASE WHEN k % 2 = 0 THEN 0 ELSE 0.05 END",
}
_FACTOR_ROWS = " UNION ALL ".join(
    f"SELECT flight_id, {i} AS pos, '{n}' AS f, '{FEATURE_LABELS[n]}' AS l, CAST({e} AS DOUBLE) AS c, typecode FROM flights"
    for i, (n, e) in enumerate(_CONTRIBUTIONS.items())
)


@query(
    "top_factors",
    with_cte(
        "flights",
        "SELECT flight_id, coalesce(string_agg(concat(f, '|', l, '|', CASE WHEN c > 0 THEN 'increases' ELSE 'decreases' END), ';' ORDER BY rn) "
        "FILTER (rn <= 3 AND abs(c) > 0.000001), '') AS factors FROM (SELECT *, row_number() OVER (PARTITION BY flight_id ORDER BY abs(c) DESC, pos) AS rn "
        f"FROM ({_FACTOR_ROWS}) x WHERE NOT (f = 'typecode' AND typecode IS NULL)) y GROUP BY flight_id",
    ),
)
def top_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three strongest drivers of each row, tiny ones dropped."""
    names = list(_CONTRIBUTIONS)
    values = F.array(*[F.expr(e).cast("double") for e in _CONTRIBUTIONS.values()])
    rows = flights(spark, sf_dir)
    factors = history.top_factors(rows, names, values, F.array(*[F.lit("x")] * len(names)), F.col("typecode").isNull())
    lines = F.transform(factors, lambda f: F.concat_ws("|", f["feature"], f["label"], f["direction"]))
    return rows.select("flight_id", F.array_join(lines, ";").alias("factors"))


# each airport's newest weather hour, and drivers ranked by what stands out in it
_STATION = (
    "station AS (SELECT airport, arg_max(round(temperature_2m, 2), time) AS temp, arg_max(round(wind_speed_10m, 2), time) AS wind, "
    "arg_max(round(precipitation, 2), time) AS rain FROM weather GROUP BY 1)"
)
_DRIVERS = {"wind_speed_10m": ("wind", "(wind - 50) / 100"), "temperature_2m": ("temp", "(20 - temp) / 90"), "traffic_1h": ("n", "(n - 3) / 70")}
_SHOWN_SQL = {
    "wind_speed_10m": "printf('%.1f km/h', wind)",
    "temperature_2m": "printf('%.1f°C', temp)",
    "traffic_1h": "concat(CAST(n AS BIGINT), ' aircraft')",
}
_DRIVER_ROWS = " UNION ALL ".join(
    f"SELECT airport, {i} AS pos, '{FEATURE_LABELS[name]}' AS l, CAST({effect} AS DOUBLE) AS c, {_SHOWN_SQL[name]} AS v FROM seen"
    for i, (name, (_, effect)) in enumerate(_DRIVERS.items())
)
_SEEN = (
    f"{_LATEST_RISK}, {_STATION}, seen AS (SELECT airport, ordinal, risk_score, n, temp, wind, rain FROM airports JOIN latest USING (airport) "
    "LEFT JOIN station USING (airport)), drivers AS (SELECT airport, coalesce(string_agg(concat(l, ' (', v, ') ', "
    "CASE WHEN c > 0 THEN 'increases' ELSE 'decreases' END, ' risk'), '; ' ORDER BY rn) FILTER (rn <= {top} AND abs(c) > 0.000001), '') AS d FROM "
    f"(SELECT *, row_number() OVER (PARTITION BY airport ORDER BY abs(c) DESC NULLS LAST, pos) AS rn FROM ({_DRIVER_ROWS}) x) y GROUP BY airport)"
)
_WEATHER_SQL = (
    "concat('wind ', coalesce(CAST(wind AS VARCHAR) || ' km/h', 'n/a'), ', temp ', coalesce(CAST(temp AS VARCHAR) || 'C', 'n/a'), "
    "', precip ', coalesce(CAST(rain AS VARCHAR) || ' mm', 'n/a'))"
)
_BAND_SQL = "CASE WHEN risk_score < 0.25 THEN 'low' WHEN risk_score < 0.40 THEN 'medium' ELSE 'high' END"
_PCT_SQL = "CAST(CAST(round_even(risk_score * 100, 0) AS BIGINT) AS VARCHAR)"


def _seen_sql(top: int, body: str) -> str:
    head = with_cte("airports flights weather predictions", "SELECT 1").removesuffix(" SELECT 1")
    return f"{head}, {_SEEN.format(top=top)} {body}"


def _with_drivers(spark: SparkSession, sf_dir: str, top: int) -> DataFrame:
    """Each airport's newest risk and traffic, its newest weather hour as a line,
    and its strongest drivers."""
    newest = weather(spark, sf_dir).groupBy("airport").agg(
        *[F.max_by(F.round(c, 2), "time").alias(a) for c, a in (("temperature_2m", "temp"), ("wind_speed_10m", "wind"), ("precipitation", "rain"))]
    )
    seen = _latest_risk(spark, sf_dir).join(newest, "airport", "left")
    shown = F.array(*[text.format_value(F.lit(name), F.col(column).cast("double")) for name, (column, _) in _DRIVERS.items()])
    effects = F.array(*[F.expr(effect).cast("double") for _, effect in _DRIVERS.values()])
    # an airport without weather has no effect of it
    known = F.transform(effects, lambda e: F.coalesce(e, F.lit(0.0)))
    drivers = history.top_factors(seen, list(_DRIVERS), known, shown, F.lit(False), top)
    return seen.select(
        "airport", "risk_score", "n", text.weather_line(F.col("wind"), F.col("temp"), F.col("rain")).alias("weather"), drivers.alias("drivers")
    )


@query(
    "risk_summary_line",
    _seen_sql(
        2,
        f"SELECT airport, concat(airport, ': risk ', {_PCT_SQL}, '% (', {_BAND_SQL}, '), ', CAST(n AS VARCHAR), ' aircraft nearby, ', {_WEATHER_SQL}, "
        "CASE WHEN d = '' THEN '' ELSE concat(', top model drivers: ', d) END) AS line FROM seen JOIN drivers USING (airport)",
    ),
)
def risk_summary_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text line per airport with its two strongest drivers."""
    rows = _with_drivers(spark, sf_dir, 2)
    line = text.risk_line(*[F.col(c) for c in ("airport", "risk_score", "n", "weather", "drivers")], top=2)
    return rows.select("airport", line.alias("line"))


@query(
    "airport_brief",
    _seen_sql(
        3,
        f"SELECT airport, concat_ws(chr(10), 'airport: ' || airport, concat('risk: ', {_PCT_SQL}, '% ', {_BAND_SQL}), concat('traffic: ', n), "
        f"concat('weather: ', {_WEATHER_SQL}), concat('drivers: ', CASE WHEN d = '' THEN 'none' ELSE d END), concat('trend: ', series)) AS brief "
        "FROM seen JOIN drivers USING (airport) JOIN (SELECT airport, string_agg("
        f"CAST(CAST(round_even(risk_score * 100, 0) AS BIGINT) AS VARCHAR), ' ' ORDER BY time) AS series FROM ({_RECENT}) p GROUP BY airport) t USING (airport)",
    ),
)
def airport_brief(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text about each airport with its drivers and trend."""
    rows = _with_drivers(spark, sf_dir, 3).join(history.risk_trend(predictions(spark, sf_dir)), "airport")
    brief = text.airport_brief(*[F.col(c) for c in ("airport", "risk_score", "n", "weather", "drivers", "series")])
    return rows.select("airport", brief.alias("brief"))


@query(
    "latest_run",
    "SELECT o_orderpriority AS run_name, arg_max(o_orderkey, o_orderdate::DATE::VARCHAR || lpad(o_orderkey::VARCHAR, 12, '0')) AS run_id FROM orders GROUP BY 1",
)
def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest run of each name; orders play the run table."""
    runs = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("run_name"), F.col("o_orderkey").alias("run_id"), F.to_date("o_orderdate").alias("start_time")
    )
    return history.latest_run(runs).select("run_name", "run_id")
