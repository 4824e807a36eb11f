"""Row-local expressions over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from delaylens.functions import geo, text, weather as wx
from delaylens.functions.calendar import holiday_dim, hour_floor, hour_text, with_calendar, with_holiday, years_of
from delaylens.plans.catalog import query
from delaylens.plans.queries_sources import _VISIBILITY_MILES, _VISIBILITY_TEXT
from delaylens.plans.testdata import flights, positions, registry_rows, scored, table, with_cte


@query(
    "calendar_features",
    with_cte(
        "flights",
        "SELECT flight_id, hour(first_seen) AS hour_of_day, isodow(first_seen) - 1 AS day_of_week, "
        "month(first_seen) AS month, CAST(isodow(first_seen) >= 6 AS BIGINT) AS is_weekend FROM flights",
    ),
)
def calendar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_calendar(flights(spark, sf_dir))
    return rows.select("flight_id", "hour_of_day", "day_of_week", "month", "is_weekend")


# Holidays by their dates in the span of the orders table, worked out by hand
# rules in SQL: Easter by its published table of dates.
_EASTER_DATES = [
    "1995-04-16", "1996-04-07", "1997-03-30", "1998-04-12", "1999-04-04", "2000-04-23", "2001-04-15",
]
_EASTER_SQL = "easter(e) AS (VALUES " + ", ".join(f"(DATE '{d}')" for d in _EASTER_DATES) + ")"


@query(
    "holiday_dim",
    f"WITH {_EASTER_SQL}, y AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders), d AS ("
    "SELECT country, make_date(y, m, d) AS date FROM y, (VALUES "
    "('DE',1,1),('DE',5,1),('DE',10,3),('DE',12,25),('DE',12,26),"
    "('PL',1,1),('PL',5,1),('PL',5,3),('PL',8,15),('PL',11,1),('PL',11,11),('PL',12,25),('PL',12,26),"
    "('FR',1,1),('FR',5,1),('FR',5,8),('FR',7,14),('FR',8,15),('FR',11,1),('FR',11,11),('FR',12,25),"
    "('NL',1,1),('NL',12,25),('NL',12,26),('GB',1,1),('GB',12,25),('GB',12,26)) f(country, m, d) "
    "UNION SELECT country, CAST(e + o AS DATE) FROM easter, (VALUES ('DE',-2),('DE',1),('DE',39),('DE',50),"
    "('PL',0),('PL',1),('PL',49),('PL',60),('GB',-2),('FR',1),('FR',39),('FR',50),"
    "('NL',0),('NL',1),('NL',39),('NL',49),('NL',50)) v(country, o) WHERE year(e) IN (SELECT y FROM y) "
    "UNION SELECT 'NL', make_date(y, 5, 5) FROM y WHERE y % 5 = 0 "
    # Mondays in Great Britain, by looking at every day of May
    "UNION SELECT 'GB', CAST(m AS DATE) FROM y, LATERAL (SELECT unnest(generate_series(make_date(y, 5, 1)::TIMESTAMP, "
    "make_date(y, 5, 31)::TIMESTAMP, INTERVAL 1 DAY)) AS m) s WHERE isodow(m) = 1 AND (day(m) <= 7 OR day(m) > 24) "
    # moved days
    "UNION SELECT 'GB', CASE isodow(make_date(y, 1, 1)) WHEN 6 THEN make_date(y, 1, 3) ELSE make_date(y, 1, 2) END FROM y "
    "WHERE isodow(make_date(y, 1, 1)) >= 6 "
    "UNION SELECT 'GB', CAST(make_date(y, 12, d) + 2 AS DATE) FROM y, (VALUES (25), (26)) v(d) "
    "WHERE isodow(make_date(y, 12, d)) >= 6) "
    "SELECT country, strftime(date, '%Y-%m-%d') AS date FROM d",
)
def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """National calendars for the years the orders span."""
    dim = holiday_dim(years_of(table(spark, sf_dir, "orders"), "o_orderdate"))
    return dim.select("country", F.date_format("date", "yyyy-MM-dd").alias("date"))


@query(
    "holiday_flag",
    with_cte(
        "flights",
        "SELECT flight_id, adep, CAST(adep <> 'LSZH' AND strftime(first_seen, '%m-%d') = '01-01' "
        "OR adep IN ('EPWA', 'EPGD') AND strftime(first_seen, '%m-%d') = '01-06' AS BIGINT) AS is_holiday FROM flights",
    ),
)
def holiday_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flag of each departure; the events cover January 2024."""
    rows = flights(spark, sf_dir)
    return with_holiday(rows, holiday_dim(years_of(rows, "first_seen"))).select("flight_id", "adep", "is_holiday")


@query(
    "hour_floor",
    with_cte(
        "flights",
        "SELECT flight_id, epoch_us(date_trunc('hour', first_seen)) AS hour_us, "
        "strftime(first_seen, '%Y-%m-%dT%H:00') AS hour_key FROM flights",
    ),
)
def hour_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("first_seen")
    return flights(spark, sf_dir).select(
        "flight_id", F.unix_micros(hour_floor(ts).cast("timestamp")).alias("hour_us"), hour_text(ts).alias("hour_key")
    )


_CAT = (
    "CAST(CASE WHEN visibility < 1 OR ceiling < 500 THEN 3 WHEN visibility < 3 OR ceiling < 1000 THEN 2 "
    "WHEN visibility < 5 OR ceiling < 3000 THEN 1 ELSE 0 END AS BIGINT)"
)


@query(
    "flight_category",
    with_cte(
        "flights",
        f"SELECT flight_id, CASE WHEN visibility IS NULL OR ceiling IS NULL THEN NULL ELSE {_CAT} END AS code, "
        f"CASE WHEN visibility IS NULL OR ceiling IS NULL THEN NULL ELSE ['VFR','MVFR','IFR','LIFR'][({_CAT}) + 1] END AS label, "
        f"{_CAT} AS fallthrough FROM (SELECT flight_id, CASE WHEN k % 9 = 0 THEN NULL ELSE k / 10 END AS visibility, "
        "CASE WHEN k % 14 = 0 THEN NULL ELSE value * 40 END AS ceiling FROM flights) f",
    ),
)
def category(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    vis, ceil = F.when(k % 9 != 0, k / 10), F.when(k % 14 != 0, F.col("value") * 40)
    code = wx.flight_category(vis, ceil, "null")
    return flights(spark, sf_dir).select(
        "flight_id",
        code.alias("code"),
        wx.category_label(code).alias("label"),
        wx.flight_category(vis, ceil, "fallthrough").alias("fallthrough"),
    )


@query(
    "visibility_parse",
    with_cte(
        "flights",
        f"SELECT flight_id, CAST({_VISIBILITY_MILES} AS DOUBLE) AS plain, "
        f"CAST(CASE WHEN k % 8 = 4 THEN 1.5 ELSE {_VISIBILITY_MILES} END AS DOUBLE) AS mixed FROM flights",
    ),
)
def visibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = F.expr(_VISIBILITY_TEXT)
    return flights(spark, sf_dir).select(
        "flight_id", wx.parse_visibility(shown).alias("plain"), wx.parse_visibility(shown, mixed=True).alias("mixed")
    )


@query(
    "ceiling_wide",
    with_cte(
        "flights",
        "SELECT flight_id, coalesce(least(CASE WHEN k % 3 = 0 THEN k * 100 END, CASE WHEN k % 4 = 0 AND k % 8 <> 0 THEN k * 30 END), "
        "12000)::DOUBLE AS ceiling_ft FROM flights",
    ),
)
def ceiling_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    wide = flights(spark, sf_dir).withColumns(
        {
            "skyc1": F.when(k % 3 == 0, "BKN").otherwise("SCT"),
            "skyl1": k * 100,
            "skyc2": F.when(k % 4 == 0, "VV").otherwise("FEW"),
            "skyl2": F.when(k % 8 != 0, k * 30),
        }
    )
    return wide.select("flight_id", wx.ceiling_from_columns(["skyc1", "skyc2"], ["skyl1", "skyl2"]).alias("ceiling_ft"))


@query(
    "ceiling_array",
    with_cte(
        "flights",
        "SELECT flight_id, coalesce(list_min(list_transform(list_filter([{'c': CASE WHEN k % 3 = 0 THEN 'BKN' ELSE 'SCT' END, "
        "'b': k * 100}, {'c': CASE WHEN k % 4 = 0 THEN 'OVC' ELSE 'FEW' END, 'b': CASE WHEN k % 8 <> 0 THEN k * 30 END}], "
        "lambda x: x.c IN ('BKN', 'OVC', 'VV') AND x.b IS NOT NULL), lambda x: x.b)), 12000)::DOUBLE AS ceiling_ft FROM flights",
    ),
)
def ceiling_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    layers = F.array(
        F.struct(F.when(k % 3 == 0, "BKN").otherwise("SCT").alias("cover"), (k * 100).alias("base")),
        F.struct(F.when(k % 4 == 0, "OVC").otherwise("FEW").alias("cover"), F.when(k % 8 != 0, k * 30).alias("base")),
    )
    return flights(spark, sf_dir).select("flight_id", wx.ceiling_from_layers(layers).alias("ceiling_ft"))


@query(
    "unit_convert",
    "SELECT event_id, round(value * 1.852::DOUBLE, 6) AS from_knots, round(value * 3.6::DOUBLE, 6) AS from_mps FROM events",
)
def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("value")
    return table(spark, sf_dir, "events").select(
        "event_id", F.round(wx.knots_to_kmh(v), 6).alias("from_knots"), F.round(wx.mps_to_kmh(v), 6).alias("from_mps")
    )


@query(
    "first_nonempty",
    with_cte(
        "registry_rows",
        "SELECT p_partkey, coalesce(nullif(manufacturername, ''), nullif(manufacturericao, '')) AS manufacturer, "
        "coalesce(nullif(operator, ''), nullif(owner, ''), nullif(operatorcallsign, ''), nullif(operatoricao, '')) AS operator "
        "FROM registry_rows",
    ),
)
def nonempty(spark: SparkSession, sf_dir: str) -> DataFrame:
    def first(*names: str):
        return text.first_nonempty(*[F.col(n) for n in names])

    return registry_rows(spark, sf_dir).select(
        "p_partkey",
        first("manufacturername", "manufacturericao").alias("manufacturer"),
        first("operator", "owner", "operatorcallsign", "operatoricao").alias("operator"),
    )


@query(
    "normalise_keys",
    with_cte(
        "positions",
        "SELECT event_id, lower(trim(icao24)) AS icao24, upper(trim(callsign)) AS callsign FROM positions WHERE trim(callsign) <> ''",
    ),
)
def normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        positions(spark, sf_dir)
        .where(F.trim("callsign") != "")
        .select(
            "event_id",
            text.normalise_id(F.col("icao24")).alias("icao24"),
            text.normalise_code(F.col("callsign")).alias("callsign"),
        )
    )


@query(
    "risk_band",
    with_cte(
        "scored",
        "SELECT l_orderkey, l_linenumber, score, CASE WHEN score < 0.25 THEN 'low' WHEN score < 0.40 THEN 'medium' ELSE 'high' END "
        "AS risk_level FROM scored",
    ),
)
def bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(spark, sf_dir)
    return rows.select("l_orderkey", "l_linenumber", "score", text.risk_band(F.col("score")).alias("risk_level"))


_SHOWN = {
    "hour_of_day": "printf('%02d:00', k % 24)",
    "day_of_week": "['Mon','Tue','Wed','Thu','Fri','Sat','Sun'][k % 7 + 1]",
    "month": "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'][k % 12 + 1]",
    "delay_rate_1h": "concat(CAST(k AS VARCHAR), '%')",
    "flight_category": "['VFR','MVFR','IFR','LIFR'][k % 4 + 1]",
    "wind_speed_10m": "concat(CAST(k AS VARCHAR), '.0 km/h')",
    "temperature_2m": "concat(CAST(k - 50 AS VARCHAR), '.0°C')",
    "precipitation": "concat(CAST(k AS VARCHAR), '.0 mm')",
    "traffic_3h": "concat(CAST(k AS VARCHAR), ' aircraft')",
    "is_holiday": "CASE WHEN k % 2 = 1 THEN 'yes' ELSE 'no' END",
    "visibility_mi": "concat(CAST(k AS VARCHAR), '.0 mi')",
    "ceiling_ft": "CASE WHEN k * 200 >= 12000 THEN 'unlimited' ELSE concat(CAST(k * 200 AS VARCHAR), '.0 ft') END",
}


@query(
    "format_value",
    with_cte(
        "flights",
        "SELECT flight_id, "
        + ", ".join(f"CASE WHEN k % 29 = 0 THEN 'n/a' ELSE {sql} END AS {name}" for name, sql in _SHOWN.items())
        + ", coalesce(typecode, 'n/a') AS typecode FROM flights",
    ),
)
def formatted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Display text of one value per feature."""
    k = F.col("k")
    numbers = {
        "hour_of_day": k % 24,
        "day_of_week": k % 7,
        "month": k % 12 + 1,
        "delay_rate_1h": k / 100,
        "flight_category": k % 4,
        "wind_speed_10m": k,
        "temperature_2m": k - 50,
        "precipitation": k,
        "traffic_3h": k,
        "is_holiday": k % 2,
        "visibility_mi": k,
        "ceiling_ft": k * 200,
    }
    shown = {n: text.format_value(F.lit(n), F.when(k % 29 != 0, v.cast("double"))) for n, v in numbers.items()}
    shown["typecode"] = text.format_value(F.lit("typecode"), F.lit(None).cast("double"), F.col("typecode"))
    return flights(spark, sf_dir).select("flight_id", *[c.alias(n) for n, c in shown.items()])


@query(
    "dead_reckoning",
    with_cte(
        "positions",
        "SELECT event_id, round(lat + velocity * cos(radians(true_track)) / 111320 * 90, 6) AS lat, "
        "round(lon + velocity * sin(radians(true_track)) / (111320 * cos(radians(lat))) * 90, 6) AS lon "
        "FROM positions WHERE lat IS NOT NULL",
    ),
)
def reckoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions carried on for one poll interval at reported speed."""
    lat, lon = geo.project_position(
        F.col("lat"), F.col("lon"), F.col("velocity"), F.col("true_track"), F.lit(90)
    )
    rows = positions(spark, sf_dir).where("lat is not null")
    return rows.select("event_id", F.round(lat, 6).alias("lat"), F.round(lon, 6).alias("lon"))


@query(
    "bbox_filter",
    with_cte(
        "airports positions",
        "SELECT event_id, icao24 FROM positions, (SELECT min(site_lat) - 2 AS a, max(site_lat) + 2 AS b, "
        "min(site_lon) - 2 AS c, max(site_lon) + 2 AS d FROM airports) x WHERE lat BETWEEN a AND b AND lon BETWEEN c AND d",
    ),
)
def in_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = positions(spark, sf_dir)
    return rows.where(geo.in_box(F.col("lat"), F.col("lon"), geo.bounding_box())).select("event_id", "icao24")


@query(
    "percent_round",
    with_cte(
        "scored",
        "SELECT l_orderkey, l_linenumber, CAST(round_even(score * 100, 0) AS BIGINT) AS half_even, "
        "CAST(floor(score * 100 + 0.5::DOUBLE) AS BIGINT) AS half_up FROM scored",
    ),
)
def percents(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("score")
    return scored(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        text.percent_half_even(s).alias("half_even"),
        text.percent_half_up(s).alias("half_up"),
    )
