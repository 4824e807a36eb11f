"""Star-schema queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from delaylens.constants import (
    CONDITION_GROUPS,
    DAY_HELPER,
    DISTANCE_BANDS,
    HUMIDITY_BANDS,
    MONTH_HELPER,
    PRESSURE_BANDS,
    SKY_GROUPS,
    TEMPERATURE_BANDS,
    VISIBILITY_BANDS,
    WIND_BANDS,
)
from delaylens.operators import warehouse as wh
from delaylens.operators.prefix import dense_ids
from delaylens.plans.catalog import ORACLES, query
from delaylens.plans.testdata import CAUSES, CTE, shipment_details, shipment_rows, shipments, station_weather, table, with_cte
from delaylens.plans.warehouse_load import load_batches, run_batch
from delaylens.session import shared_dir, stage


def _band_sql(value: str, bands: list[tuple[str, float | None]]) -> str:
    whens = " ".join(f"WHEN {value} >= {lower} THEN '{name}'" for name, lower in reversed(bands[1:]))
    return f"CASE WHEN {value} IS NULL THEN NULL {whens} ELSE '{bands[0][0]}' END"


def _names(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_ROLES = ["scheduled_departure", "scheduled_arrival", "departure", "arrival"]


@query(
    "dim_time",
    "SELECT CAST(strftime(t, '%Y%m%d%H') AS BIGINT) AS time_id, year(t) AS year, quarter(t) AS quarter, month(t) AS month, "
    f"{_names(MONTH_HELPER)}[month(t)] AS month_name, day(t) AS day, isodow(t) AS day_of_week, {_names(DAY_HELPER)}[isodow(t)] AS day_name, isodow(t) >= 6 AS weekend, "
    "['winter','spring','summer','autumn'][(month(t) % 12) // 3 + 1] AS season, hour(t) AS hour, "
    "CASE WHEN hour(t) < 6 THEN 'night' WHEN hour(t) < 12 THEN 'morning' WHEN hour(t) < 18 THEN 'afternoon' ELSE 'evening' END AS time_of_day "
    "FROM (SELECT unnest(generate_series(date_trunc('hour', min(ts)), max(ts), INTERVAL 1 HOUR)) AS t FROM events) x",
)
def dim_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours between the first and last event."""
    return wh.time_dimension(table(spark, sf_dir, "events"), ["ts"])


@query(
    "surrogate_keys",
    "SELECT row_number() OVER (ORDER BY md5(c_name)) AS customer_id, c_name, c_mktsegment FROM customer",
)
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense ids without a one-task sort."""
    rows = table(spark, sf_dir, "customer").select("c_name", "c_mktsegment")
    return dense_ids(rows, ["c_name"], "customer_id").select("customer_id", "c_name", "c_mktsegment")


@query(
    "surrogate_keys_extend",
    "SELECT customer_id, c_name FROM (SELECT row_number() OVER (ORDER BY md5(c_name)) AS customer_id, c_name FROM customer "
    "WHERE c_nationkey < 10 UNION ALL SELECT (SELECT count(*) FROM customer WHERE c_nationkey < 10) + row_number() OVER (ORDER BY md5(c_name)), "
    "c_name FROM customer WHERE c_nationkey >= 10) x",
)
def surrogate_keys_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later load keeps known ids and numbers the new keys after them."""
    rows = table(spark, sf_dir, "customer").select("c_name", "c_nationkey")
    first = wh.dimension(rows.where("c_nationkey < 10"), ["c_name"], [], "customer_id")
    return wh.extend_dimension(first, rows.select("c_name"), ["c_name"], "customer_id")


# --- the dimensions of the shipments fact ------------------------------------
_FLIGHT_KEY = ["flight_number", "tail", "origin", "destination"]


def _flight_dim(rows: DataFrame) -> DataFrame:
    dim = wh.dimension(rows.select(*_FLIGHT_KEY, "distance", "scheduled_time"), _FLIGHT_KEY, ["distance", "scheduled_time"], "flight_id")
    return dim.withColumn("distance_group", wh.band(F.col("distance"), DISTANCE_BANDS))


def _airport_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wh.dimension(
        table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")),
        ["n_nationkey"],
        ["n_name", "r_name"],
        "airport_id",
        staged=False,
    )


def _airline_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wh.dimension(table(spark, sf_dir, "customer"), ["c_mktsegment"], [], "airline_id", staged=False)


_WEATHER_BANDS = {
    "temp_group": ("temperature", TEMPERATURE_BANDS),
    "humidity_group": ("humidity", HUMIDITY_BANDS),
    "visibility_group": ("visibility", VISIBILITY_BANDS),
    "wind_group": ("wind_speed", WIND_BANDS),
    "pressure_group": ("pressure", PRESSURE_BANDS),
}


def _weather_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = ["temperature", "humidity", "visibility", "wind_speed", "sky_cover", "weather_condition", "pressure"]
    dim = wh.dimension(station_weather(spark, sf_dir), ["nation", "hour"], measures, "weather_id")
    return dim.withColumns(
        {
            **{name: wh.band(F.col(c), bands) for name, (c, bands) in _WEATHER_BANDS.items()},
            "sky_group": wh.map_group(F.col("sky_cover"), SKY_GROUPS, "unknown"),
            "weather_group": wh.map_group(F.col("weather_condition"), CONDITION_GROUPS, "clear"),
        }
    )


def _md5_key(*columns: str) -> str:
    return "md5(concat_ws(chr(31), " + ", ".join(f"CAST({c} AS VARCHAR)" for c in columns) + "))"


_DIM_SQL = {
    "d_flight": f"d_flight AS (SELECT row_number() OVER (ORDER BY {_md5_key(*_FLIGHT_KEY)}) AS flight_id, * FROM (SELECT {', '.join(_FLIGHT_KEY)}, "
    "max(s).distance AS distance, max(s).scheduled_time AS scheduled_time FROM (SELECT *, {'distance': distance, 'scheduled_time': scheduled_time} AS s "
    f"FROM shipments) x GROUP BY {', '.join(_FLIGHT_KEY)}) y)",
    "d_airport": f"d_airport AS (SELECT row_number() OVER (ORDER BY {_md5_key('n_nationkey')}) AS airport_id, n_nationkey, n_name, r_name FROM nation "
    "JOIN region ON n_regionkey = r_regionkey)",
    "d_airline": f"d_airline AS (SELECT row_number() OVER (ORDER BY {_md5_key('c_mktsegment')}) AS airline_id, c_mktsegment FROM "
    "(SELECT DISTINCT c_mktsegment FROM customer) c)",
    "d_weather": f"d_weather AS (SELECT row_number() OVER (ORDER BY {_md5_key('nation', 'hour')}) AS weather_id, *, "
    + ", ".join(f"{_band_sql(c, bands)} AS {name}" for name, (c, bands) in _WEATHER_BANDS.items())
    + " FROM station_weather)",
}


def _with_dims(needs: str, dims: str, body: str) -> str:
    parts = [CTE[n] for n in needs.split()] + [_DIM_SQL[d] for d in dims.split()]
    return "WITH " + ", ".join(parts) + " " + body


@query(
    "dim_flight",
    _with_dims(
        "shipments",
        "d_flight",
        f"SELECT flight_id, {', '.join(_FLIGHT_KEY)}, distance, scheduled_time, {_band_sql('distance', DISTANCE_BANDS)} AS distance_group FROM d_flight",
    ),
)
def dim_flight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flight_dim(shipments(spark, sf_dir))


@query(
    "dim_conformed",
    _with_dims(
        "",
        "d_airport d_airline",
        "SELECT 'airport' AS dim, airport_id AS id, n_name AS name FROM d_airport UNION ALL "
        "SELECT 'airline', airline_id, c_mktsegment FROM d_airline",
    ),
)
def dim_conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airport and airline dimensions with their keys."""
    airport = _airport_dim(spark, sf_dir).select(F.lit("airport").alias("dim"), F.col("airport_id").alias("id"), F.col("n_name").alias("name"))
    airline = _airline_dim(spark, sf_dir).select(F.lit("airline").alias("dim"), F.col("airline_id").alias("id"), F.col("c_mktsegment").alias("name"))
    return airport.unionByName(airline)


@query(
    "banding",
    _with_dims(
        "station_weather",
        "d_weather",
        f"SELECT weather_id, nation, hour, {', '.join(_WEATHER_BANDS)}, "
        "CASE WHEN sky_cover IN ('CLR', 'FEW') THEN 'clear' WHEN sky_cover = 'SCT' THEN 'partly' WHEN sky_cover = 'VV' THEN 'obscured' ELSE 'cloudy' END "
        "AS sky_group, CASE weather_condition WHEN 'RA' THEN 'rain' WHEN 'SN' THEN 'snow' WHEN 'FG' THEN 'fog' WHEN 'TS' THEN 'storm' ELSE 'clear' END "
        "AS weather_group FROM d_weather",
    ),
)
def banding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather dimension with all its group columns."""
    return _weather_dim(spark, sf_dir).select("weather_id", "nation", "hour", *_WEATHER_BANDS, "sky_group", "weather_group")


def _load(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The fact rows (four time roles, airline, two airports, flight, and two
    weather roles that may stay null) and the dimensions they point to."""
    # the joined source feeds the flight dimension and the fact; what a row says by
    # itself is worked out after the one lookup that moves rows between tasks
    narrow = stage(shipment_rows(spark, sf_dir), "shipments")
    source, flight = shipment_details(narrow), _flight_dim(narrow)
    located = wh.lookup_dimension(narrow, flight, {c: c for c in _FLIGHT_KEY}, "flight_id", "flight_id")
    rows = shipment_details(located).withColumns(
        {
            **{f"{r}_time_id": wh.time_id(F.col(r)) for r in _ROLES},
            "air_time": F.col("elapsed_time") - F.col("taxi_out") - F.col("taxi_in"),
        }
    )
    airport, weather, airline = _airport_dim(spark, sf_dir), _weather_dim(spark, sf_dir), _airline_dim(spark, sf_dir)
    fact = wh.lookup_dimension(rows, airline, {"carrier": "c_mktsegment"}, "airline_id", "airline_id")
    fact = wh.lookup_dimension(fact, airport, {"origin": "n_nationkey"}, "airport_id", "origin_airport_id")
    fact = wh.lookup_dimension(fact, airport, {"destination": "n_nationkey"}, "airport_id", "destination_airport_id")
    fact = fact.withColumns({"dep_h": F.hour("departure"), "arr_h": F.hour("arrival")})
    for role, place, hour in (("origin", "origin", "dep_h"), ("destination", "destination", "arr_h")):
        fact = wh.lookup_dimension(
            fact,
            weather,
            {place: "nation", hour: "hour"},
            "weather_id",
            f"{role}_weather_id",
            required=False,
            attributes={"temp_group": f"{role}_temp_group", "wind_group": f"{role}_wind_group", "weather_group": f"{role}_weather_group"},
        )
    dims = {"time": wh.time_dimension(source, _ROLES), "airline": airline, "airport": airport, "flight": flight, "weather": weather}
    return fact, dims


_FACT_OUT = [
    "l_orderkey",
    "l_linenumber",
    *[f"{r}_time_id" for r in _ROLES],
    "airline_id",
    "origin_airport_id",
    "destination_airport_id",
    "flight_id",
    "origin_weather_id",
    "destination_weather_id",
    "distance",
    "departure_delay",
    "arrival_delay",
    "taxi_out",
    "taxi_in",
    "elapsed_time",
    "air_time",
    "cancelled",
    "diverted",
    *CAUSES,
]


@query(
    "fact_load",
    _with_dims(
        "shipments station_weather",
        "d_flight d_airport d_airline d_weather",
        "SELECT l_orderkey, l_linenumber, "
        + ", ".join(f"CAST(strftime({r}, '%Y%m%d%H') AS BIGINT) AS {r}_time_id" for r in _ROLES)
        + ", airline_id, o.airport_id AS origin_airport_id, e.airport_id AS destination_airport_id, f.flight_id, w.weather_id AS origin_weather_id, "
        "v.weather_id AS destination_weather_id, s.distance, departure_delay, arrival_delay, taxi_out, taxi_in, elapsed_time, elapsed_time - taxi_out - taxi_in AS air_time, cancelled, diverted, "
        + ", ".join(CAUSES)
        + " FROM shipments s JOIN d_airline ON carrier = c_mktsegment JOIN d_airport o ON s.origin = o.n_nationkey "
        "JOIN d_airport e ON s.destination = e.n_nationkey JOIN d_flight f ON (s.flight_number, s.tail, s.origin, s.destination) = "
        "(f.flight_number, f.tail, f.origin, f.destination) LEFT JOIN d_weather w ON w.nation = s.origin AND w.hour = hour(departure) "
        "LEFT JOIN d_weather v ON v.nation = s.destination AND v.hour = hour(arrival)",
    ),
)
def fact_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load(spark, sf_dir)[0].select(*_FACT_OUT)


# the fact's ten keys: dimension, its key, and rows taken out of it for the audit
_KEYS = {
    **{f"{r}_time_id": ("time", "time_id", "{} % 100 = 3") for r in _ROLES},
    "airline_id": ("airline", "airline_id", "{} = 1"),
    "origin_airport_id": ("airport", "airport_id", "{} % 7 = 0"),
    "destination_airport_id": ("airport", "airport_id", "{} % 5 = 0"),
    "flight_id": ("flight", "flight_id", "{} % 11 = 0"),
    "origin_weather_id": ("weather", "weather_id", "{} % 3 = 0"),
    "destination_weather_id": ("weather", "weather_id", "{} % 4 = 0"),
}


@query(
    "fact_audit",
    f"WITH fact AS ({ORACLES['fact_load']}) SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT 'foreign_key:{role}' AS \"check\", count(*) AS n FROM fact WHERE {hole.format(role)}" for role, (_, _, hole) in _KEYS.items()
    )
    + "".join(f" UNION ALL SELECT 'not_null:{c}', count(*) FROM fact WHERE {c} IS NULL" for c in ("flight_id", "arrival_delay", "origin_weather_id"))
    + ") c WHERE n > 0",
)
def fact_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loaded fact and its ten keys against dimensions with rows taken out."""
    fact, dims = _load(spark, sf_dir)
    keys = {role: (dims[dim].where(f"NOT ({hole.format(key)})"), key) for role, (dim, key, hole) in _KEYS.items()}
    return wh.audit_fact(stage(fact.select(*_FACT_OUT), "fact"), ["flight_id", "arrival_delay", "origin_weather_id"], keys)


@query("fact_ids", "SELECT CAST(1 AS BIGINT) AS first_id, count(*) AS last_id, count(*) AS n_ids FROM lineitem")
def fact_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense ids over the whole fact, repeated natural keys included."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    ids = dense_ids(rows, rows.columns, "fact_id")
    return ids.agg(
        F.min("fact_id").alias("first_id"), F.max("fact_id").alias("last_id"), F.count_distinct("fact_id").alias("n_ids")
    )


@query(
    "fk_audit",
    "SELECT 'foreign_key:customer' AS \"check\", count(*) AS n FROM orders WHERE o_custkey % 10 = 3 UNION ALL "
    "SELECT 'foreign_key:status', count(*) FROM orders WHERE o_orderstatus = 'P' UNION ALL "
    "SELECT 'not_null:priority', count(*) FROM orders WHERE o_orderpriority = '5-LOW'",
)
def fk_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against dimensions with holes and a column with nulls."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer"),
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"),
    )
    customers = table(spark, sf_dir, "customer").where("c_custkey % 10 <> 3")
    statuses = orders.select("status").where("status <> 'P'").distinct()
    return wh.audit_fact(
        orders, ["customer", "priority"], {"customer": (customers, "c_custkey"), "status": (statuses, "status")}
    )


_KPIS = {
    "on_time_ratio": "count(*) FILTER (NOT cancelled AND arrival_delay < 15) / count(*) FILTER (NOT cancelled)",
    "delay_recovery_ratio": "count(*) FILTER (NOT cancelled AND departure_delay > 0 AND arrival_delay < departure_delay) "
    "/ count(*) FILTER (NOT cancelled AND departure_delay > 0)",
    "weather_delay_ratio": "sum(weather_delay) FILTER (NOT cancelled) / sum(arrival_delay) FILTER (NOT cancelled AND arrival_delay > 0)",
    "cancellation_ratio": "count(*) FILTER (cancelled) / count(*)",
    "avg_arrival_delay": "avg(arrival_delay) FILTER (NOT cancelled)",
}


def _kpis_sql(keys: str) -> str:
    return f"SELECT {keys}, " + ", ".join(f"round({e}, 6) AS {n}" for n, e in _KPIS.items()) + " FROM shipments GROUP BY 1"


@query("kpi_ratios", with_cte("shipments", _kpis_sql("carrier")))
def kpi_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = wh.kpi_ratios(shipments(spark, sf_dir), ["carrier"])
    return rows.withColumns({n: F.round(n, 6) for n in _KPIS})


@query(
    "kpi_status_trend",
    with_cte(
        "shipments",
        "SELECT month, on_time_ratio, CASE WHEN on_time_ratio >= 0.9 THEN 'good' WHEN on_time_ratio >= 0.85 THEN 'warning' ELSE 'critical' END AS status, "
        "CAST(sign(on_time_ratio - lag(on_time_ratio) OVER (ORDER BY month)) AS BIGINT) AS trend FROM (SELECT strftime(scheduled_departure, '%Y-%m') AS month, "
        f"round({_KPIS['on_time_ratio'].replace('< 15', '< 95')}, 6) AS on_time_ratio FROM shipments GROUP BY 1) m",
    ),
)
def kpi_status_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly on-time ratio with status and direction. The made delays are
    long, so the limit here is 95 minutes."""
    rows = shipments(spark, sf_dir).withColumn("arrival_delay", F.col("arrival_delay") - 80)
    monthly = wh.kpi_ratios(rows, [F.date_format("scheduled_departure", "yyyy-MM").alias("month")])
    ratio = monthly.select("month", F.round("on_time_ratio", 6).alias("on_time_ratio"))
    return wh.kpi_status_trend(ratio, [], "month", "on_time_ratio")


_WEATHER_JOIN = "FROM shipments s LEFT JOIN d_weather w ON w.nation = origin AND w.hour = hour(departure)"


def _weathered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shipments(spark, sf_dir).withColumn("dep_h", F.hour("departure"))
    return wh.lookup_dimension(
        rows,
        _weather_dim(spark, sf_dir),
        {"origin": "nation", "dep_h": "hour"},
        "weather_id",
        "origin_weather_id",
        required=False,
        attributes={"temp_group": "temp_group", "wind_group": "wind_group", "weather_group": "weather_group"},
    )


@query(
    "cube_breakdown",
    _with_dims(
        "shipments station_weather",
        "d_weather",
        "SELECT carrier, wind_group, CAST(grouping_id(carrier, wind_group) AS BIGINT) AS level, count(*) AS flights, "
        f"round({_KPIS['on_time_ratio']}, 6) AS on_time_ratio, round(avg(departure_delay), 6) AS avg_departure_delay {_WEATHER_JOIN} GROUP BY CUBE (carrier, wind_group)",
    ),
)
def cube_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On-time ratio by carrier and wind band, with all totals."""
    measures = {
        "flights": F.count("*"),
        "on_time_ratio": F.round(wh.kpi_columns()["on_time_ratio"], 6),
        "avg_departure_delay": F.round(F.avg("departure_delay"), 6),
    }
    return wh.cube_ratio(_weathered(spark, sf_dir), ["carrier", "wind_group"], measures)


@query(
    "rollup_time",
    with_cte(
        "shipments",
        "SELECT year(scheduled_departure) AS year, quarter(scheduled_departure) AS quarter, month(scheduled_departure) AS month, "
        "CAST(grouping_id(year(scheduled_departure), quarter(scheduled_departure), month(scheduled_departure)) AS BIGINT) AS level, count(*) AS flights, "
        f"round({_KPIS['cancellation_ratio']}, 6) AS cancellation_ratio FROM shipments "
        "GROUP BY ROLLUP (year(scheduled_departure), quarter(scheduled_departure), month(scheduled_departure))",
    ),
)
def rollup_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume and cancellations by year, quarter and month."""
    at = "scheduled_departure"
    rows = shipments(spark, sf_dir).withColumns({n: f(at).cast("bigint") for n, f in (("year", F.year), ("quarter", F.quarter), ("month", F.month))})
    measures = {"flights": F.count("*"), "cancellation_ratio": F.round(wh.kpi_columns()["cancellation_ratio"], 6)}
    return wh.rollup_ratio(rows, ["year", "quarter", "month"], measures)


_CONDITIONS = ["rain", "snow", "fog", "storm", "clear"]


@query(
    "pivot_ratio",
    _with_dims(
        "shipments station_weather",
        "d_weather",
        "SELECT carrier, "
        + ", ".join(f"round(count(*) FILTER (NOT cancelled AND arrival_delay < 15 AND g = '{c}') / count(*) FILTER (NOT cancelled AND g = '{c}'), 6) AS {c}" for c in _CONDITIONS)
        + " FROM (SELECT s.*, CASE weather_condition WHEN 'RA' THEN 'rain' WHEN 'SN' THEN 'snow' WHEN 'FG' THEN 'fog' WHEN 'TS' THEN 'storm' "
        f"WHEN 'none' THEN 'clear' END AS g {_WEATHER_JOIN}) x GROUP BY carrier",
    ),
)
def pivot_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On-time ratio by carrier, one column per weather condition."""
    rows = _weathered(spark, sf_dir)
    pivoted = wh.pivot_ratio(rows, "carrier", "weather_group", _CONDITIONS, wh.kpi_columns()["on_time_ratio"])
    return pivoted.select("carrier", *[F.round(c, 6).alias(c) for c in _CONDITIONS])


@query(
    "cancellation_by_temperature",
    _with_dims(
        "shipments station_weather",
        "d_weather",
        "SELECT temp_group, month(departure) AS month, count(*) AS flights, "
        f"round({_KPIS['cancellation_ratio']}, 6) AS cancellation_ratio {_WEATHER_JOIN} GROUP BY 1, 2",
    ),
)
def cancellation_by_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _weathered(spark, sf_dir).groupBy("temp_group", F.month("departure").cast("bigint").alias("month"))
    return rows.agg(
        F.count("*").alias("flights"), F.round(wh.kpi_columns()["cancellation_ratio"], 6).alias("cancellation_ratio")
    )


@query(
    "share_by_key",
    with_cte(
        "shipments",
        "SELECT origin, minutes, round(minutes / sum(minutes) OVER (), 6) AS share FROM (SELECT origin, CAST(sum(weather_delay) AS BIGINT) AS minutes "
        "FROM shipments GROUP BY origin) x",
    ),
)
def share_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather delay minutes by origin and their share of all."""
    rows = wh.share_by_key(shipments(spark, sf_dir), "origin", F.sum("weather_delay"), "minutes")
    return rows.withColumn("share", F.round("share", 6))


@query(
    "hourly_profile",
    with_cte(
        "shipments",
        "SELECT hour(scheduled_departure) AS hour, count(*) AS flights, round(avg(departure_delay), 6) AS avg_delay FROM shipments GROUP BY 1",
    ),
)
def hourly_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shipments(spark, sf_dir).withColumn("hour", F.hour("scheduled_departure").cast("bigint"))
    return wh.hourly_profile(rows, "hour", "departure_delay").withColumn("avg_delay", F.round("avg_delay", 6))


@query(
    "cause_unpivot",
    with_cte(
        "shipments",
        " UNION ALL ".join(f"SELECT carrier, '{c}' AS cause, CAST(sum({c}) AS BIGINT) AS minutes FROM shipments GROUP BY carrier" for c in CAUSES),
    ),
)
def cause_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wh.delay_by_cause(shipments(spark, sf_dir), ["carrier"], CAUSES)


@query(
    "batch_rerun",
    "SELECT CAST(year(o_orderdate) AS BIGINT) AS batch_id, count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents "
    "FROM orders WHERE year(o_orderdate) <> 1996 GROUP BY 1",
)
def batch_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders loaded in yearly batches: one batch is loaded twice and counts
    once; a repeat of another fails half way and leaves the good load; a first
    load of a third fails and leaves nothing behind."""
    target = shared_dir(spark, "fact")
    orders = table(spark, sf_dir, "orders").withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("bigint"))
    rows = orders.select("o_orderkey", "cents", F.year("o_orderdate").alias("batch_id"))
    load_batches(rows.where("batch_id <> 1996"), target)
    run_batch(rows.where("batch_id = 1998").drop("batch_id"), target, 1998)
    half = F.when(F.col("o_orderkey") % 2 == 0, F.col("cents")).otherwise(F.raise_error(F.lit("made failure")).cast("bigint"))
    for year in (1996, 1997):
        try:
            run_batch(rows.where(F.col("batch_id") == year).select("o_orderkey", half.alias("cents")), target, year)
        except Exception as error:
            if "made failure" not in str(error):
                raise
    return (
        spark.read.parquet(target + "/rows")
        .groupBy(F.col("batch_id").cast("bigint").alias("batch_id"))
        .agg(F.count("*").alias("n"), F.sum("cents").alias("cents"))
    )
