"""Adapters that give TESTDATA tables the shapes of the analysis.

Row-local adapters are SQL expressions valid in Spark and in the checking
engine alike, so both sides start from the same rows; `CTE` holds the checking
side. Integer arithmetic keeps the derived numbers exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from delaylens.constants import AIRPORT_CODES, AIRPORTS
from delaylens.functions.calendar import hour_text
from delaylens.functions.weather import flight_category

SCOPE = AIRPORT_CODES
SCOPE_SQL = ", ".join(f"'{c}'" for c in SCOPE)
NATION_SCOPE = [0, 1, 2, 3, 4, 5, 6]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k"

_FLIGHT = [
    "event_id AS flight_id",
    "concat('ac', lpad(CAST(user_id AS STRING), 4, '0')) AS icao24",
    "concat('FL', CAST(event_id AS STRING)) AS flt_id",
    "CASE WHEN k % 23 = 0 THEN 'LSZH' WHEN event_type = 'click' THEN 'EDDF' WHEN event_type = 'error' THEN 'EPWA' "
    "WHEN event_type = 'purchase' THEN 'EGLL' WHEN event_type = 'signup' THEN 'LFPG' ELSE 'EHAM' END AS adep",
    "CASE user_id % 10 WHEN 0 THEN 'EDDF' WHEN 1 THEN 'EPWA' WHEN 2 THEN 'EGLL' WHEN 3 THEN 'LFPG' WHEN 4 THEN 'EHAM' "
    "WHEN 5 THEN 'EDDM' WHEN 6 THEN 'EPGD' WHEN 7 THEN 'LEMD' WHEN 8 THEN 'LIRF' ELSE 'EKCH' END AS ades",
    "ts AS first_seen",
    "CASE WHEN k % 17 = 0 THEN NULL ELSE concat('T', CAST(k % 10 AS STRING)) END AS typecode",
    "concat('OP', CAST(user_id % 7 AS STRING)) AS icao_operator",
    "value AS duration_min",
    "CAST(135 AS DOUBLE) AS expected_duration_min",
    "value - 135 AS delay_min",
    "CAST(CASE WHEN value >= 150 THEN 1 ELSE 0 END AS BIGINT) AS delayed_15min",
    "value",
    "k",
    "user_id",
]
_FLIGHT2 = ["*", "concat(adep, '-', ades) AS route"]


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("*", _K).selectExpr(*_FLIGHT).selectExpr(*_FLIGHT2)


_POSITION = [
    "event_id",
    "concat('AC', lpad(CAST(user_id AS STRING), 4, '0')) AS icao24",
    "CASE WHEN event_id % 50 = 0 THEN NULL ELSE 46 + ((user_id * 37) % 1000) / 100 END AS lat",
    "CASE WHEN event_id % 50 = 0 THEN NULL ELSE -2 + ((k * 53) % 2400) / 100 END AS lon",
    "value AS velocity",
    "CAST((k * 7) % 360 AS DOUBLE) AS true_track",
    "CASE WHEN k % 13 = 0 THEN NULL ELSE CAST(k * 110 AS DOUBLE) END AS baro_altitude",
    "CASE WHEN k % 19 = 0 THEN NULL ELSE concat('Dlh', CAST(user_id AS STRING), ' ') END AS callsign",
    "event_type AS origin_country",
    "ts",
]


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").selectExpr("*", _K).selectExpr(*_POSITION)
    return rows.withColumn("time", snapshot_time(F.col("ts")))


def snapshot_time(ts, seconds: int = 90):
    return F.floor(F.unix_seconds(ts.cast("timestamp")) / seconds) * seconds


# means to whole hundredths, so that neither engine has a rounding tie to break
_EXACT_AVG = "floor(CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / count(*)) / 100"
_AVG_K = "floor(CAST(sum(k) AS DOUBLE) * 100 / count(*)) / 100"


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly (airport, time, temperature, precipitation, wind); no LFPG."""
    rows = flights(spark, sf_dir).where("adep <> 'LFPG'")
    return rows.groupBy(F.col("adep").alias("airport"), hour_text(F.col("first_seen")).alias("time")).agg(
        F.expr(f"{_EXACT_AVG} - 20").alias("temperature_2m"),
        (F.max("k") / 50).alias("precipitation"),
        F.expr(_AVG_K).alias("wind_speed_10m"),
    )


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly (airport, hour, visibility, ceiling, category); no LFPG."""
    rows = flights(spark, sf_dir).where("adep <> 'LFPG'")
    hourly = rows.groupBy(F.col("adep").alias("airport"), hour_text(F.col("first_seen")).alias("hour")).agg(
        F.expr(f"{_EXACT_AVG} / 10").alias("visibility_mi"), (F.min("value") * 100).alias("ceiling_ft")
    )
    category = flight_category(F.col("visibility_mi"), F.col("ceiling_ft"), "fallthrough")
    return hourly.withColumn("flight_category", category.cast("double"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction history: airport, time (half hours), score, traffic."""
    rows = flights(spark, sf_dir).withColumn("time", snapshot_time(F.col("first_seen"), 1800))
    return rows.groupBy(F.col("adep").alias("airport"), "time").agg(
        F.expr(f"least(1, {_EXACT_AVG} / 100)").alias("risk_score"), F.count("*").alias("live_traffic_count")
    )


def airports(spark: SparkSession, codes: list[str] = AIRPORT_CODES) -> DataFrame:
    """The fixed airport dimension with its display order."""
    rows = ", ".join(f"('{c}', {lat}D, {lon}D, '{n}', {i})" for i, (c, lat, lon, n) in enumerate(AIRPORTS) if c in codes)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(airport, site_lat, site_lon, country, ordinal)")


AIRPORTS_SQL = (
    "airports(airport, site_lat, site_lon, country, ordinal) AS (SELECT * FROM (VALUES "
    + ", ".join(f"('{c}', {lat}::DOUBLE, {lon}::DOUBLE, '{n}', {i})" for i, (c, lat, lon, n) in enumerate(AIRPORTS))
    + ") v)"
)

_ROUTE = [
    "l_orderkey",
    "l_linenumber",
    "s_nationkey AS adep",
    "c_nationkey AS ades",
    "l_quantity AS duration_min",
    "month(l_shipdate) AS month",
    "l_shipdate AS first_seen",
]


def route_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined_lines(spark, sf_dir).selectExpr(*_ROUTE)


def _joined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    )


_LINES_SQL = (
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey "
    "JOIN supplier ON l_suppkey = s_suppkey"
)

_LABEL = "CAST(CASE WHEN l_discount > 0.085 THEN 1 ELSE 0 END AS BIGINT)"
_SCORED = [
    "l_orderkey",
    "l_linenumber",
    "l_suppkey % 7 AS adep",
    "l_shipdate AS first_seen",
    f"{_LABEL} AS label",
    f"((l_partkey * 7919) % 1000 * 7 + 1500 * {_LABEL} * (l_orderkey % 3)) / 10000 AS score",
]


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*_SCORED)


_REGISTRY = [
    "p_partkey",
    "CASE WHEN p_partkey % 97 = 0 THEN '' ELSE concat('AC', lpad(CAST(p_partkey % 140 AS STRING), 4, '0')) END AS icao24",
    "concat('D-', CAST(p_partkey AS STRING)) AS registration",
    "CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_type END AS manufacturericao",
    "CASE WHEN p_partkey % 2 = 0 THEN '' ELSE p_brand END AS manufacturername",
    "CASE WHEN p_size % 5 = 0 THEN '' ELSE p_name END AS model",
    "CASE WHEN p_partkey % 11 = 0 THEN '' ELSE concat('T', CAST(p_size % 10 AS STRING)) END AS typecode",
    "CASE WHEN p_partkey % 4 < 3 THEN '' ELSE p_brand END AS operator",
    "CASE WHEN p_partkey % 7 < 5 THEN '' ELSE p_type END AS operatorcallsign",
    "CASE WHEN p_partkey % 5 = 1 THEN '' ELSE p_name END AS operatoricao",
    "CASE WHEN p_size % 6 < 4 THEN '' ELSE p_brand END AS owner",
]


def registry_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(*_REGISTRY)


# Flights for the star schema: the interval helpers are the only words that
# differ between the two engines.
_SHIPMENT = [
    "l_orderkey",
    "l_linenumber",
    "c_mktsegment AS carrier",
    "s_nationkey AS origin",
    "c_nationkey AS destination",
    "l_suppkey AS flight_number",
    "concat('N', CAST(c_custkey % 500 AS STRING)) AS tail",
    "100 + (s_nationkey * 97 + c_nationkey * 31) % 2500 AS distance",
    "60 + l_partkey % 300 AS scheduled_time",
    "o_orderdate",
    "CAST(l_partkey % 24 AS INT) AS dep_hour",
    "l_quantity * 3 - 30 AS departure_delay",
    "l_quantity * 3 - 40 + l_suppkey % 15 AS arrival_delay",
    "CAST(50 + l_partkey % 300 + l_suppkey % 15 AS BIGINT) AS elapsed_time",
    "5 + l_linenumber * 2 AS taxi_out",
    "3 + l_linenumber AS taxi_in",
    "l_returnflag = 'R' AND l_linenumber = 1 AS cancelled",
    "l_linenumber = 7 AS diverted",
]
_CAUSES = [
    "*",
    "CAST(CASE WHEN arrival_delay > 0 AND flight_number % 5 = 0 THEN arrival_delay ELSE 0 END AS BIGINT) AS air_system_delay",
    "CAST(CASE WHEN arrival_delay > 0 AND flight_number % 5 = 1 THEN arrival_delay ELSE 0 END AS BIGINT) AS security_delay",
    "CAST(CASE WHEN arrival_delay > 0 AND flight_number % 5 = 2 THEN arrival_delay ELSE 0 END AS BIGINT) AS airline_delay",
    "CAST(CASE WHEN arrival_delay > 0 AND flight_number % 5 = 3 THEN arrival_delay ELSE 0 END AS BIGINT) AS late_aircraft_delay",
    "CAST(CASE WHEN arrival_delay > 0 AND flight_number % 5 = 4 THEN arrival_delay ELSE 0 END AS BIGINT) AS weather_delay",
]
CAUSES = ["air_system_delay", "security_delay", "airline_delay", "late_aircraft_delay", "weather_delay"]


def _times(add: str) -> list[str]:
    return [
        "*",
        add.format(base="o_orderdate", minutes="dep_hour * 60") + " AS scheduled_departure",
        add.format(base="o_orderdate", minutes="dep_hour * 60 + scheduled_time") + " AS scheduled_arrival",
        add.format(base="o_orderdate", minutes="dep_hour * 60 + departure_delay") + " AS departure",
        add.format(base="o_orderdate", minutes="dep_hour * 60 + scheduled_time + arrival_delay") + " AS arrival",
    ]


_ADD_SPARK = "{base} + make_dt_interval(0, 0, CAST({minutes} AS INT))"
_ADD_CHECK = "{base} + to_minutes(CAST({minutes} AS BIGINT))"


def shipment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipments without the columns that `shipment_details` works out of a row."""
    return _joined_lines(spark, sf_dir).selectExpr(*_SHIPMENT)


def shipment_details(rows: DataFrame) -> DataFrame:
    return rows.selectExpr(*_CAUSES).selectExpr(*_times(_ADD_SPARK))


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shipment_details(shipment_rows(spark, sf_dir))


# Station weather for the star schema, one row per (nation, hour of day)
_STATION = [
    "CAST(user_id % 23 AS INT) AS nation",
    "CAST(hour(ts) AS INT) AS hour",
    "CAST(round(value * 100) AS BIGINT) AS cents",
    "k",
]


def station_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").selectExpr("*", _K).selectExpr(*_STATION)
    return rows.groupBy("nation", "hour").agg(*[F.expr(e).alias(n) for n, e in _STATION_AGG.items()])


_STATION_AGG = {
    "temperature": "CAST(sum(cents) AS DOUBLE) / count(*) / 100 - 40",
    "humidity": "CAST(max(k) AS DOUBLE)",
    "visibility": "CAST(min(k) AS DOUBLE)",
    "wind_speed": "CAST(min(cents) / 100 AS DOUBLE)",
    "sky_cover": "CASE max(k) % 6 WHEN 0 THEN 'CLR' WHEN 1 THEN 'FEW' WHEN 2 THEN 'SCT' WHEN 3 THEN 'BKN' WHEN 4 THEN 'OVC' ELSE 'VV' END",
    "weather_condition": "CASE count(*) % 5 WHEN 0 THEN 'RA' WHEN 1 THEN 'SN' WHEN 2 THEN 'FG' WHEN 3 THEN 'TS' ELSE 'none' END",
    "pressure": "CAST(980 + count(*) % 60 AS DOUBLE)",
}


def _select(columns: list[str], source: str) -> str:
    return f"SELECT {', '.join(columns)} FROM {source}"


CTE = {
    "airports": AIRPORTS_SQL,
    "flights": "flights AS ("
    + _select(_FLIGHT2, "(" + _select(_FLIGHT, f"(SELECT *, {_K} FROM events) e") + ") f")
    + ")",
    "positions": "positions AS (SELECT *, CAST(floor(epoch(ts) / 90) * 90 AS BIGINT) AS time FROM ("
    + _select(_POSITION, f"(SELECT *, {_K} FROM events) e")
    + ") p)",
    "weather": "weather AS (SELECT adep AS airport, strftime(first_seen, '%Y-%m-%dT%H:00') AS time, "
    f"{_EXACT_AVG} - 20 AS temperature_2m, max(k) / 50 AS precipitation, {_AVG_K} AS wind_speed_10m "
    "FROM flights WHERE adep <> 'LFPG' GROUP BY 1, 2)",
    "reports": "reports AS (SELECT *, CAST(CASE WHEN visibility_mi < 1 OR ceiling_ft < 500 THEN 3 "
    "WHEN visibility_mi < 3 OR ceiling_ft < 1000 THEN 2 WHEN visibility_mi < 5 OR ceiling_ft < 3000 THEN 1 ELSE 0 END "
    "AS DOUBLE) AS flight_category FROM (SELECT adep AS airport, strftime(first_seen, '%Y-%m-%dT%H:00') AS hour, "
    f"{_EXACT_AVG} / 10 AS visibility_mi, min(value) * 100 AS ceiling_ft FROM flights WHERE adep <> 'LFPG' GROUP BY 1, 2) m)",
    "predictions": "predictions AS (SELECT adep AS airport, CAST(floor(epoch(first_seen) / 1800) * 1800 AS BIGINT) AS time, "
    f"least(1, {_EXACT_AVG} / 100) AS risk_score, count(*) AS live_traffic_count FROM flights GROUP BY 1, 2)",
    "route_facts": "route_facts AS (SELECT " + ", ".join(_ROUTE) + " " + _LINES_SQL + ")",
    "scored": "scored AS (" + _select(_SCORED, "lineitem") + ")",
    "registry_rows": "registry_rows AS (" + _select(_REGISTRY, "part") + ")",
    "registry": "registry AS (SELECT lower(trim(icao24)) AS icao24, nullif(registration, '') AS registration, "
    "coalesce(nullif(manufacturername, ''), nullif(manufacturericao, '')) AS manufacturer, nullif(model, '') AS model, "
    "nullif(typecode, '') AS typecode, coalesce(nullif(operator, ''), nullif(owner, ''), nullif(operatorcallsign, ''), "
    "nullif(operatoricao, '')) AS operator FROM (SELECT *, row_number() OVER (PARTITION BY lower(trim(icao24)) "
    "ORDER BY p_partkey) AS rn FROM registry_rows WHERE icao24 <> '') r WHERE rn = 1)",
    "sightings": "sightings AS (SELECT a.airport, p.icao24, p.time FROM positions p JOIN airports a "
    "ON abs(p.lat - a.site_lat) <= 0.5 AND abs(p.lon - a.site_lon) <= 0.5)",
    "shipments": "shipments AS ("
    + _select(
        _times(_ADD_CHECK),
        "(" + _select(_CAUSES, "(SELECT " + ", ".join(_SHIPMENT) + " " + _LINES_SQL + ") s") + ") c",
    )
    + ")",
    "station_weather": "station_weather AS (SELECT nation, hour, "
    + ", ".join(f"{e} AS {n}" for n, e in _STATION_AGG.items())
    + " FROM ("
    + _select(_STATION, f"(SELECT *, {_K} FROM events) e")
    + ") w GROUP BY nation, hour)",
}


def with_cte(names: str, body: str) -> str:
    """The check SQL `body` after the named adapters, in the order given."""
    return "WITH " + ", ".join(CTE[n] for n in names.split()) + " " + body
