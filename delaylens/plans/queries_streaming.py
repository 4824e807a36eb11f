"""Streaming jobs run over all available data (H1, H3, H6, H8, H9); their
results equal the batch answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from delaylens.functions.calendar import holiday_dim, years_of
from delaylens.operators import traffic as batch
from delaylens.operators.joins import match_sites
from delaylens.plans.catalog import query
from delaylens.plans.queries_history import _current, _sliding_sql
from delaylens.plans.queries_model import trained
from delaylens.plans.testdata import (
    _K,
    _POSITION,
    airports,
    flights,
    positions,
    reports,
    snapshot_time,
    table,
    weather,
    with_cte,
)
from delaylens.session import shared_dir
from delaylens.streaming import traffic as live
from delaylens.streaming.scoring import rescore_stream, score_stream


def _position_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The position adapter over the events file as a stream."""
    schema = table(spark, sf_dir, "events").schema
    raw = live.read_stream(spark, sf_dir, schema, "events.parquet")
    return raw.selectExpr("*", _K).selectExpr(*_POSITION).withColumn("time", snapshot_time(F.col("ts")))


@query(
    "stream_ingest",
    with_cte("positions", "SELECT time, icao24, round(lat, 6) AS latitude, round(lon, 6) AS longitude FROM positions"),
)
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON snapshots in, typed rows appended."""
    source, out = shared_dir(spark, "snapshots"), shared_dir(spark, "positions")
    empty = F.lit(None).cast("string")
    vector = F.array(
        F.col("icao24"),
        *[empty] * 4,
        F.col("lon").cast("string"),
        F.col("lat").cast("string"),
        *[empty] * 10,
    )
    snapshot = F.to_json(F.struct("time", F.array(vector).alias("states")), {"ignoreNullFields": "false"})
    positions(spark, sf_dir).select(snapshot).write.text(source)
    live.run_available(live.read_snapshots(spark, source), live.batch_writer(out), out)
    return spark.read.parquet(out).select(
        "time", "icao24", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude")
    )


@query("stream_sightings_windows", _sliding_sql(3))
def stream_sightings_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sightings kept by a stream, windows counted over its table."""
    out = shared_dir(spark, "sightings")
    live.write_sightings(_position_stream(spark, sf_dir), out)
    return batch.sliding_distinct(spark.read.parquet(out), 10800)


@query("stream_window_counts", "SELECT * FROM (" + _sliding_sql(1) + ") w" + f" WHERE window_end <= (SELECT CAST(floor(epoch(max(ts)) / 90) * 90 AS BIGINT) - 7200 FROM events)")
def stream_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows counted in the stream itself; those still open at the end are
    not emitted."""
    out = shared_dir(spark, "windows")
    stream = live.with_event_time(_position_stream(spark, sf_dir), "2 hours")
    live.run_available(live.window_counts(stream, 3600), live.batch_writer(out), out)
    return spark.read.parquet(out).drop("batch_id")


@query(
    "stream_latest_state",
    with_cte(
        "positions",
        "SELECT icao24, max(time) AS time, max(time) + 21600 < (SELECT max(time) FROM positions) AS evicted FROM positions "
        "WHERE lat IS NOT NULL GROUP BY icao24",
    ),
)
def stream_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last position per aircraft; gone after six hours without one."""
    out = shared_dir(spark, "latest")
    stream = live.with_event_time(_position_stream(spark, sf_dir), "0 seconds")
    live.run_available(live.track_latest(stream, 6 * 3600), live.batch_writer(out), out, "update")
    changes = spark.read.parquet(out)
    return changes.groupBy("icao24").agg(
        F.max("time").alias("time"), F.max_by(F.col("status") == "evicted", F.struct("batch_id", "status")).alias("evicted")
    )


@query(
    "stream_latest_positions",
    with_cte(
        "positions",
        "SELECT icao24, max(time) AS time FROM positions WHERE lat IS NOT NULL GROUP BY icao24",
    ),
)
def stream_latest_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest position per aircraft, without a custom state function."""
    out = shared_dir(spark, "newest")
    live.run_available(live.latest_positions(_position_stream(spark, sf_dir)), live.batch_writer(out), out, "update")
    return spark.read.parquet(out).groupBy("icao24").agg(F.max("time").alias("time"))


@query(
    "late_rows_dropped",
    "SELECT event_type, window_end, count(*) AS n FROM (SELECT event_type, CAST(epoch(date_trunc('day', ts)) AS BIGINT) + 86400 AS window_end "
    "FROM events WHERE NOT (user_id % 10 = 0 AND ts < TIMESTAMP '2024-01-10')) e "
    "WHERE window_end <= (SELECT epoch(max(ts)) - 86400 FROM events) GROUP BY 1, 2",
)
def late_rows_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts under a one-day watermark; rows that come weeks late are
    dropped. The stream is run again for each delivery: it goes on from its
    checkpoint, and judges the late rows by the watermark of the run before."""
    source, out = shared_dir(spark, "late"), shared_dir(spark, "daily")
    events = table(spark, sf_dir, "events").select("event_type", "user_id", F.col("ts").cast("timestamp").alias("event_time"))
    late = (F.col("user_id") % 10 == 0) & (F.col("event_time") < F.lit("2024-01-10").cast("timestamp"))
    for part in (events.where(~late), events.where(late)):
        part.write.mode("append").parquet(source)
        stream = live.read_stream(spark, source, events.schema).withWatermark("event_time", "1 day")
        live.run_available(live.count_per_window(stream, "event_type", "1 day"), live.batch_writer(out), out)
    return spark.read.parquet(out).drop("batch_id")


def deliveries(rows: DataFrame, n: int) -> list[DataFrame]:
    """The rows in `n` parts by time."""
    span = rows.agg(F.min("time").alias("low"), F.max("time").alias("high")).first()
    width = (span["high"] - span["low"]) // n + 1
    return [rows.where(F.floor((F.col("time") - span["low"]) / width) == i) for i in range(n)]


_DELIVERED_SQL = (
    "SELECT delivery, max(time) AS time FROM (SELECT time, CAST(floor((time - min(time) OVER ()) / (floor((max(time) OVER () - min(time) OVER ()) / 3) + 1)) AS BIGINT) "
    "AS delivery FROM positions) d GROUP BY 1"
)


@query(
    "stream_newest_snapshot",
    with_cte("positions", f"SELECT delivery, icao24, time, TRUE AS logged FROM ({_DELIVERED_SQL}) c JOIN (SELECT DISTINCT icao24, time FROM positions) p USING (time)"),
)
def stream_newest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state after each of three deliveries: the aircraft of the newest
    snapshot only, and whether the log of changes leads to just these."""
    source, path, kept = shared_dir(spark, "snapshots"), shared_dir(spark, "newest"), shared_dir(spark, "kept")
    rows = positions(spark, sf_dir).select("icao24", "time", "lat", "lon")
    for i, part in enumerate(deliveries(rows, 3)):
        part.write.mode("append").parquet(source)
        live.keep_newest_snapshot(live.read_stream(spark, source, rows.schema), path)
        state = live.newest_state(spark, path).select(F.lit(i).cast("long").alias("delivery"), "icao24", "time")
        last = F.max_by("status", "batch_id")
        alive = spark.read.parquet(f"{path}/changes").groupBy("icao24").agg(last.alias("status")).where("status = 'seen'")
        logged = state.join(alive, "icao24", "left").select("delivery", "icao24", "time", F.col("status").isNotNull().alias("logged"))
        gone = alive.join(state, "icao24", "left_anti").select(F.lit(i).cast("long").alias("delivery"), "icao24", F.lit(None).cast("long").alias("time"), F.lit(False).alias("logged"))
        logged.unionByName(gone).write.mode("append").parquet(kept)
    return spark.read.parquet(kept)


@query(
    "stream_rescore",
    with_cte(
        "airports positions sightings",
        "SELECT tick, a.airport, count(DISTINCT s.icao24) AS live_traffic_count FROM (VALUES (0), (1), (2)) t(tick) CROSS JOIN airports a "
        "LEFT JOIN (SELECT * FROM sightings WHERE time = (SELECT max(time) FROM positions)) s ON s.airport = a.airport GROUP BY 1, 2",
    ),
)
def stream_rescore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per airport at each of three ticks after the last position, each
    tick its own run from the checkpoint."""
    source, path, ticks, out = (shared_dir(spark, name) for name in ("snapshots", "newest", "ticks", "history"))
    rows = positions(spark, sf_dir).select("icao24", "time", "lat", "lon")
    rows.write.parquet(source)
    live.keep_newest_snapshot(live.read_stream(spark, source, rows.schema), path)

    def counts(state: DataFrame) -> DataFrame:
        near = match_sites(state).groupBy("airport").agg(F.count_distinct("icao24").alias("live_traffic_count"))
        return airports(spark).select("airport").join(near, "airport", "left").fillna(0)

    moment = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 30).alias("timestamp")
    for i in range(3):
        spark.range(i, i + 1).select(moment).write.mode("append").parquet(ticks)
        rescore_stream(live.read_stream(spark, ticks, spark.range(1).select(moment).schema), counts, path, out).awaitTermination()
    number = ((F.unix_seconds("tick") - 1_700_000_000) / 30).cast("int")
    return spark.read.parquet(out).select(number.alias("tick"), "airport", "live_traffic_count")


_AT_SQL = with_cte(
    "airports flights positions sightings weather",
    "SELECT t.time AS at, a.airport, count(DISTINCT s.icao24) FILTER (s.time = t.time) AS live_traffic_count, "
    "count(DISTINCT s.icao24) FILTER (floor(s.time / 300) > floor(t.time / 300) - 12) AS traffic_1h, count(DISTINCT s.icao24) AS traffic_3h, "
    "any_value(w.temperature_2m) AS temperature_2m, TRUE AS in_range FROM (SELECT DISTINCT time FROM positions) t CROSS JOIN airports a "
    "LEFT JOIN sightings s ON s.airport = a.airport AND s.time <= t.time AND floor(s.time / 300) > floor(t.time / 300) - 36 "
    "LEFT JOIN (SELECT airport, round(arg_max(temperature_2m, time), 6) AS temperature_2m FROM weather GROUP BY 1) w ON w.airport = a.airport GROUP BY 1, 2",
)


@query("stream_score", _AT_SQL)
def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scored row per airport and snapshot over three deliveries, each its own
    run, with its rolling traffic, the snapshot's own, and the newest weather."""
    model, _, _ = trained(spark, sf_dir)
    source, seen, out = (shared_dir(spark, name) for name in ("deliveries", "seen", "predictions"))
    rows = positions(spark, sf_dir)
    span = rows.agg(F.min("time").alias("low"), F.max("time").alias("high")).first()
    third = (span["high"] - span["low"]) // 3 + 1
    newest_report = reports(spark, sf_dir).groupBy("airport").agg(
        F.max_by(F.struct("visibility_mi", "ceiling_ft", "flight_category"), "hour").alias("v")
    )
    report = newest_report.select("airport", "v.*").withColumns(
        {"temperature_2m": F.lit(None).cast("double"), "wind_speed_10m": F.lit(None).cast("double")}
    )

    def newest_weather() -> DataFrame:
        values = F.struct("temperature_2m", "precipitation", "wind_speed_10m")
        return weather(spark, sf_dir).groupBy("airport").agg(F.max_by(values, "time").alias("v")).select("airport", "v.*")

    for i in range(3):
        rows.where(F.floor((F.col("time") - span["low"]) / third) == i).write.mode("append").parquet(source)
        score_stream(
            live.read_stream(spark, source, rows.schema),
            model,
            airports(spark),
            lambda: report,
            newest_weather,
            holiday_dim(years_of(flights(spark, sf_dir), "first_seen")),
            seen,
            out,
        )
    history = spark.read.parquet(out)
    return history.select(
        F.col("time").alias("at"), "airport", "live_traffic_count", "traffic_1h", "traffic_3h", F.round("temperature_2m", 6).alias("temperature_2m"),
        F.col("risk_score").between(0, 1).alias("in_range"),
    )
