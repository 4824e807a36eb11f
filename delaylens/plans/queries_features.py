"""Feature building: hourly joins, trailing windows, cold start."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from delaylens.functions.calendar import holiday_dim, years_of
from delaylens.operators.joins import hourly_lookup_join
from delaylens.operators.rolling import fill_cold_start, trailing_windows, trailing_windows_direct
from delaylens.plans import features as jobs
from delaylens.plans.catalog import query
from delaylens.plans.testdata import SCOPE, SCOPE_SQL, flights, reports, weather, with_cte
from delaylens.session import shared_dir
from delaylens.streaming.extract import extract_in_chunks

_FRAME = (
    "OVER (PARTITION BY adep ORDER BY first_seen RANGE BETWEEN INTERVAL {w} HOUR PRECEDING "
    "AND INTERVAL 1 MICROSECOND PRECEDING)"
)
_COUNT = {w: f"count(delayed_15min) {_FRAME.format(w=w)}" for w in (1, 3)}
_RATE = {w: f"avg(delayed_15min) {_FRAME.format(w=w)}" for w in (1, 3)}


@query(
    "weather_left_join",
    with_cte(
        "flights weather",
        "SELECT flight_id, round(temperature_2m, 6) AS temperature_2m, round(precipitation, 6) AS precipitation, "
        "round(wind_speed_10m, 6) AS wind_speed_10m FROM flights f LEFT JOIN weather w "
        "ON f.adep = w.airport AND strftime(f.first_seen, '%Y-%m-%dT%H:00') = w.time",
    ),
)
def weather_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = jobs.WEATHER_VALUES
    joined = hourly_lookup_join(flights(spark, sf_dir), weather(spark, sf_dir), names, lookup_hour="time")
    return joined.select("flight_id", *[F.round(n, 6).alias(n) for n in names])


@query(
    "metar_left_join",
    with_cte(
        "flights reports",
        "SELECT flight_id, round(visibility_mi, 6) AS visibility_mi, round(ceiling_ft, 6) AS ceiling_ft, flight_category "
        "FROM flights f LEFT JOIN reports r ON f.adep = r.airport AND strftime(f.first_seen, '%Y-%m-%dT%H:00') = r.hour",
    ),
)
def metar_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = hourly_lookup_join(flights(spark, sf_dir), reports(spark, sf_dir), jobs.REPORT_VALUES)
    return joined.select(
        "flight_id",
        F.round("visibility_mi", 6).alias("visibility_mi"),
        F.round("ceiling_ft", 6).alias("ceiling_ft"),
        "flight_category",
    )


@query(
    "rolling_count",
    with_cte(
        "flights",
        f"SELECT flight_id, {_COUNT[1]} AS traffic_1h, {_COUNT[3]} AS traffic_3h FROM flights",
    ),
)
def rolling_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Departures of the same airport in the trailing 1h and 3h."""
    return trailing_windows(flights(spark, sf_dir)).select("flight_id", "traffic_1h", "traffic_3h")


@query(
    "rolling_mean",
    with_cte(
        "flights",
        f"SELECT flight_id, round({_RATE[1]}, 6) AS delay_rate_1h, round({_RATE[3]}, 6) AS delay_rate_3h FROM flights",
    ),
)
def rolling_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trailing_windows(flights(spark, sf_dir))
    return rows.select("flight_id", *[F.round(c, 6).alias(c) for c in ("delay_rate_1h", "delay_rate_3h")])


@query(
    "rolling_ties",
    "WITH x AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_shipdate, CAST(l_discount > 0.085 AS BIGINT) AS y FROM lineitem) "
    "SELECT l_orderkey, l_linenumber, count(y) OVER w AS traffic_7d, round(avg(y) OVER w, 6) AS delay_rate_7d FROM x "
    "WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_shipdate RANGE BETWEEN INTERVAL 7 DAY PRECEDING "
    "AND INTERVAL 1 MICROSECOND PRECEDING)",
)
def rolling_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-grained times on three heavy keys: many ties per point."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate", (F.col("l_discount") > 0.085).cast("bigint").alias("y")
    )
    rolled = trailing_windows(rows, "l_returnflag", "l_shipdate", "y", {"7d": 7 * 86400}, cell_seconds=30 * 86400)
    return rolled.select("l_orderkey", "l_linenumber", "traffic_7d", F.round("delay_rate_7d", 6).alias("delay_rate_7d"))


@query(
    "rolling_direct",
    with_cte(
        "flights",
        f"SELECT flight_id, {_COUNT[1]} AS traffic_1h, {_COUNT[3]} AS traffic_3h, round({_RATE[3]}, 6) AS delay_rate_3h FROM flights",
    ),
)
def rolling_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plain RANGE window, for keys known to be small."""
    rows = trailing_windows_direct(flights(spark, sf_dir))
    return rows.select("flight_id", "traffic_1h", "traffic_3h", F.round("delay_rate_3h", 6).alias("delay_rate_3h"))


def _filled(default: str) -> str:
    return with_cte(
        "flights",
        f"SELECT flight_id, round(coalesce(r1, {default}), 6) AS delay_rate_1h, round(coalesce(r3, {default}), 6) AS delay_rate_3h "
        f"FROM (SELECT *, {_RATE[1]} AS r1, {_RATE[3]} AS r3 FROM flights) f",
    )


@query("cold_start_fill", _filled("avg(delayed_15min) OVER (PARTITION BY adep)"))
def cold_start_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty windows get the airport's mean."""
    rows = flights(spark, sf_dir)
    filled = fill_cold_start(trailing_windows(rows), history=rows)
    return filled.select("flight_id", *[F.round(c, 6).alias(c) for c in ("delay_rate_1h", "delay_rate_3h")])


@query("cold_start_global", _filled("avg(delayed_15min) OVER ()"))
def cold_start_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty windows get the overall mean."""
    rows = flights(spark, sf_dir)
    filled = fill_cold_start(trailing_windows(rows), fill="global", history=rows)
    return filled.select("flight_id", *[F.round(c, 6).alias(c) for c in ("delay_rate_1h", "delay_rate_3h")])


@query(
    "cold_start_as_of",
    _filled(
        "(SELECT avg(g.delayed_15min) FROM flights g WHERE g.adep = f.adep AND g.first_seen < TIMESTAMP '2024-01-15')"
    ),
)
def cold_start_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The airport's mean from labels before a cutoff only."""
    rows = flights(spark, sf_dir)
    filled = fill_cold_start(trailing_windows(rows), as_of="2024-01-15", history=rows)
    return filled.select("flight_id", *[F.round(c, 6).alias(c) for c in ("delay_rate_1h", "delay_rate_3h")])


_FEATURES_SQL = with_cte(
    "flights weather reports",
    "SELECT adep, epoch_us(first_seen) AS first_seen_us, hour(first_seen) AS hour_of_day, isodow(first_seen) - 1 AS day_of_week, "
    "month(first_seen) AS month, CAST(isodow(first_seen) >= 6 AS BIGINT) AS is_weekend, "
    "CAST(strftime(first_seen, '%m-%d') = '01-01' OR adep IN ('EPWA', 'EPGD') AND strftime(first_seen, '%m-%d') = '01-06' AS BIGINT) "
    "AS is_holiday, round(temperature_2m, 6) AS temperature_2m, round(precipitation, 6) AS precipitation, "
    "round(wind_speed_10m, 6) AS wind_speed_10m, round(visibility_mi, 6) AS visibility_mi, round(ceiling_ft, 6) AS ceiling_ft, "
    "flight_category, t1::DOUBLE AS traffic_1h, t3::DOUBLE AS traffic_3h, "
    "round(coalesce(r1, m), 6) AS delay_rate_1h, round(coalesce(r3, m), 6) AS delay_rate_3h, typecode, delayed_15min "
    f"FROM (SELECT *, {_COUNT[1]} AS t1, {_COUNT[3]} AS t3, {_RATE[1]} AS r1, {_RATE[3]} AS r3, "
    "avg(delayed_15min) OVER (PARTITION BY adep) AS m FROM flights) f "
    "LEFT JOIN weather w ON f.adep = w.airport AND strftime(first_seen, '%Y-%m-%dT%H:00') = w.time "
    "LEFT JOIN reports r ON f.adep = r.airport AND strftime(first_seen, '%Y-%m-%dT%H:00') = r.hour "
    f"WHERE f.adep IN ({SCOPE_SQL})",
)


def _shown(features: DataFrame) -> DataFrame:
    rounded = [
        "temperature_2m",
        "precipitation",
        "wind_speed_10m",
        "visibility_mi",
        "ceiling_ft",
        "delay_rate_1h",
        "delay_rate_3h",
    ]
    out = features.withColumns({c: F.round(c, 6) for c in rounded})
    return out.withColumn("first_seen_us", F.unix_micros(F.col("first_seen").cast("timestamp"))).drop("first_seen")


@query("feature_table", _FEATURES_SQL)
def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch feature job."""
    return _shown(
        jobs.build_features(flights(spark, sf_dir), weather(spark, sf_dir), reports(spark, sf_dir), SCOPE)
    )


@query("chunked_equals_whole", _FEATURES_SQL)
def chunked_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows through an incremental extract, two files at a time and in
    two runs with new files between them, and one transform over everything
    extracted."""
    raw, out = shared_dir(spark, "raw-flights"), shared_dir(spark, "extracted")
    rows = flights(spark, sf_dir)
    calendar = holiday_dim(years_of(rows, "first_seen"))
    first = F.pmod(F.xxhash64("flight_id"), F.lit(2)) == 0
    for delivery in (rows.where(first), rows.where(~first)):
        delivery.repartition(3, "flight_id").write.mode("append").parquet(raw)
        extract_in_chunks(
            spark, raw, rows.schema, weather(spark, sf_dir), reports(spark, sf_dir), calendar, SCOPE, out, files_per_chunk=2
        )
    return _shown(jobs.transform(spark.read.parquet(out)))
