"""Proximity, registry, merge and search joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from delaylens.functions import geo
from delaylens.functions.text import aircraft_line
from delaylens.constants import TRAFFIC_WINDOWS
from delaylens.operators import joins
from delaylens.operators.history import current_window, latest_state
from delaylens.operators.traffic import rolling_counts, sightings
from delaylens.plans.catalog import query
from delaylens.plans.queries_history import current_sql
from delaylens.plans.testdata import (
    airports,
    flights,
    positions,
    predictions,
    registry_rows,
    reports,
    table,
    weather,
    with_cte,
)
from delaylens.sources.files import load_registry


@query(
    "proximity_join",
    with_cte(
        "airports positions",
        "SELECT event_id, icao24, airport FROM positions JOIN airports "
        "ON abs(lat - site_lat) <= 0.5 AND abs(lon - site_lon) <= 0.5",
    ),
)
def proximity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.match_sites(positions(spark, sf_dir)).select("event_id", "icao24", "airport")


# suppliers as a site table that grows with the data
_SITES = "SELECT s_suppkey AS site, 46 + (s_suppkey * 131 % 1000) / 100 AS site_lat, -2 + (s_suppkey * 277 % 2400) / 100 AS site_lon"


@query(
    "proximity_grid",
    with_cte(
        "positions",
        f"SELECT event_id, site FROM positions JOIN ({_SITES} FROM supplier) s "
        "ON abs(lat - site_lat) <= 0.25 AND abs(lon - site_lon) <= 0.25",
    ),
)
def proximity_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions against a large site table by grid cells."""
    sites = table(spark, sf_dir, "supplier").selectExpr(*_SITES.removeprefix("SELECT ").split(", "))
    return joins.grid_match(positions(spark, sf_dir), sites, radius=0.25).select("event_id", "site")


@query(
    "proximity_grid_equals_bnl",
    with_cte(
        "airports positions",
        "SELECT event_id, icao24, airport FROM positions JOIN airports "
        "ON abs(lat - site_lat) <= 0.5 AND abs(lon - site_lon) <= 0.5",
    ),
)
def proximity_grid_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid join over the fixed airports gives the inline match's rows."""
    return joins.grid_match(positions(spark, sf_dir), airports(spark)).select("event_id", "icao24", "airport")


@query(
    "nearest_grid",
    with_cte(
        "positions",
        "SELECT event_id, site FROM (SELECT event_id, site, row_number() OVER (PARTITION BY event_id ORDER BY "
        "(lat - site_lat) * (lat - site_lat) + (lon - site_lon) * (lon - site_lon), site) AS rn "
        f"FROM positions, ({_SITES} FROM supplier) s WHERE lat IS NOT NULL) q WHERE rn = 1",
    ),
)
def nearest_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The closest site of a table to every position, by rings of grid cells."""
    sites = table(spark, sf_dir, "supplier").selectExpr(*_SITES.removeprefix("SELECT ").split(", "))
    return joins.nearest_grid(positions(spark, sf_dir), sites, "event_id", "site")


@query(
    "nearest_airport",
    with_cte(
        "airports positions",
        "SELECT event_id, arg_min(airport, d * 1000000 + ordinal) AS airport FROM (SELECT event_id, airport, ordinal, "
        "row_number() OVER (PARTITION BY event_id ORDER BY (lat - site_lat) * (lat - site_lat) + (lon - site_lon) * (lon - site_lon), "
        "ordinal) AS d FROM positions, airports WHERE lat IS NOT NULL) x GROUP BY event_id",
    ),
)
def nearest_airport(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = positions(spark, sf_dir).where("lat is not null")
    return rows.select("event_id", geo.nearest_site(F.col("lat"), F.col("lon")).alias("airport"))


_HAVERSINE = (
    "power(sin(radians(lat - site_lat) / 2), 2) + cos(radians(lat)) * cos(radians(site_lat)) * power(sin(radians(lon - site_lon) / 2), 2)"
)


@query(
    "nearest_airport_sphere",
    with_cte(
        "airports positions",
        f"SELECT airport, count(*) AS n FROM (SELECT event_id, airport, row_number() OVER (PARTITION BY event_id ORDER BY {_HAVERSINE}, ordinal) AS d "
        "FROM positions, airports WHERE lat IS NOT NULL) x WHERE d = 1 GROUP BY airport",
    ),
)
def nearest_airport_sphere(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions by their closest airport on the sphere."""
    rows = positions(spark, sf_dir).where("lat is not null")
    return rows.groupBy(geo.nearest_site(F.col("lat"), F.col("lon"), metric="haversine").alias("airport")).agg(F.count("*").alias("n"))


@query(
    "registry_join",
    with_cte(
        "positions registry_rows registry",
        "SELECT event_id, p.icao24, r.typecode, r.manufacturer, r.model, r.operator, r.registration "
        "FROM positions p LEFT JOIN registry r ON lower(p.icao24) = r.icao24",
    ),
)
def registry_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = load_registry(registry_rows(spark, sf_dir), "p_partkey")
    rows = joins.lookup_registry(positions(spark, sf_dir), registry)
    return rows.select(
        "event_id", "icao24", *[f"registry.{c}" for c in ("typecode", "manufacturer", "model", "operator", "registration")]
    )


def _latest_per_airport(df: DataFrame, hour: str, values: list[str]) -> DataFrame:
    newest = df.groupBy("airport").agg(F.max_by(F.struct(*values), hour).alias("v"))
    return newest.select("airport", "v.*")


def _context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged live inputs per airport: the newest hour of each source, the rolling
    windows that end now (airports without one have no row), and the newest
    snapshot. The report side lacks precipitation."""
    report = _latest_per_airport(reports(spark, sf_dir), "hour", ["visibility_mi", "ceiling_ft", "flight_category"]).withColumns({"temperature_2m": F.col("visibility_mi") - 3, "wind_speed_10m": F.col("ceiling_ft") / 100})
    model = _latest_per_airport(weather(spark, sf_dir), "time", ["temperature_2m", "precipitation", "wind_speed_10m"])
    seen = positions(spark, sf_dir)
    latest = seen.agg(F.max("time")).scalar()
    counts = rolling_counts(sightings(seen), latest=latest)
    traffic = current_window(counts, airports(spark).select("airport"), latest, list(TRAFFIC_WINDOWS)).where("traffic_3h > 0")
    now = joins.match_sites(latest_state(seen))
    instant = now.groupBy("airport").agg(F.count_distinct("icao24").alias("live_traffic_count"))
    return joins.live_context(airports(spark), report, model, traffic, instant)


_CONTEXT_CTE = (
    "rep AS (SELECT airport, arg_max(visibility_mi, hour) AS visibility_mi, arg_max(ceiling_ft, hour) AS ceiling_ft, "
    "arg_max(flight_category, hour) AS flight_category FROM reports GROUP BY 1), "
    "mod AS (SELECT airport, arg_max(temperature_2m, time) AS t, arg_max(precipitation, time) AS p, "
    "arg_max(wind_speed_10m, time) AS w FROM weather GROUP BY 1), "
    "tra AS (SELECT airport, traffic_1h AS a, traffic_3h AS b FROM (" + current_sql(False) + ") t WHERE traffic_3h > 0), "
    "ins AS (SELECT airport, count(DISTINCT icao24) AS n FROM positions JOIN airports ON abs(lat - site_lat) <= 0.5 "
    "AND abs(lon - site_lon) <= 0.5 WHERE time = (SELECT max(time) FROM positions) GROUP BY 1), "
    "context AS (SELECT airport, ordinal, coalesce(n, 0) AS live_traffic_count, coalesce(a, n, 0) AS traffic_1h, "
    "coalesce(b, n, 0) AS traffic_3h, round(coalesce(visibility_mi - 3, t), 6) AS temperature_2m, "
    "round(coalesce(ceiling_ft / 100, w), 6) AS wind_speed_10m, round(p, 6) AS precipitation, flight_category "
    "FROM airports LEFT JOIN rep USING (airport) LEFT JOIN mod USING (airport) LEFT JOIN tra USING (airport) "
    "LEFT JOIN ins USING (airport)) "
)
_CONTEXT_NEEDS = "airports flights positions sightings weather reports"


def _with_context(body: str) -> str:
    return with_cte(_CONTEXT_NEEDS, "SELECT 1").removesuffix(" SELECT 1") + ", " + _CONTEXT_CTE + body


_CONTEXT_OUT = ["airport", "live_traffic_count", "traffic_1h", "traffic_3h"]
_CONTEXT_ROUND = ["temperature_2m", "wind_speed_10m", "precipitation"]


@query(
    "live_context",
    _with_context(f"SELECT {', '.join(_CONTEXT_OUT + _CONTEXT_ROUND)}, flight_category FROM context"),
)
def live_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _context(spark, sf_dir)
    return rows.select(
        *_CONTEXT_OUT,
        *[F.round(c, 6).alias(c) for c in _CONTEXT_ROUND],
        F.col("metar.flight_category").alias("flight_category"),
    )


@query("source_precedence", _with_context("SELECT airport, temperature_2m, wind_speed_10m, precipitation FROM context"))
def source_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station reading first, weather model second, per field."""
    return _context(spark, sf_dir).select("airport", *[F.round(c, 6).alias(c) for c in _CONTEXT_ROUND])


@query("traffic_fallback", _with_context("SELECT airport, live_traffic_count, traffic_1h, traffic_3h FROM context"))
def traffic_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rolling counts where they exist, the count of this instant elsewhere."""
    return _context(spark, sf_dir).select(*_CONTEXT_OUT)


@query(
    "entity_enrich_reasons",
    with_cte(
        "airports positions flights predictions registry_rows registry",
        "SELECT event_id, nearest_airport, typecode, CASE WHEN lat IS NULL THEN 'no position' WHEN rid IS NULL THEN 'not in registry' "
        "WHEN typecode IS NULL THEN 'no aircraft type' WHEN ctx IS NULL THEN 'no context for airport' END AS reason, "
        "live_traffic_count FROM (SELECT p.event_id, p.lat, r.icao24 AS rid, r.typecode, n.airport AS nearest_airport, "
        "c.airport AS ctx, c.live_traffic_count FROM positions p LEFT JOIN registry r ON lower(p.icao24) = r.icao24 "
        "LEFT JOIN (SELECT event_id, airport FROM (SELECT event_id, airport, row_number() OVER (PARTITION BY event_id ORDER BY "
        "(lat - site_lat) * (lat - site_lat) + (lon - site_lon) * (lon - site_lon), ordinal) AS rn FROM positions, airports "
        "WHERE lat IS NOT NULL) q WHERE rn = 1) n ON n.event_id = p.event_id "
        "LEFT JOIN (SELECT airport, arg_max(live_traffic_count, time) AS live_traffic_count FROM predictions GROUP BY 1) c "
        "ON c.airport = n.airport) z",
    ),
)
def entity_enrich_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every position with its nearest airport's newest context, or why not.
    EDDM and EPGD have no predictions in this data."""
    registry = load_registry(registry_rows(spark, sf_dir), "p_partkey")
    context = _latest_per_airport(predictions(spark, sf_dir), "time", ["risk_score", "live_traffic_count"])
    rows = joins.entity_context(positions(spark, sf_dir), registry, context)
    return rows.select(
        "event_id",
        "nearest_airport",
        F.col("registry.typecode").alias("typecode"),
        "reason",
        F.col("context.live_traffic_count").alias("live_traffic_count"),
    )


@query(
    "substring_topk",
    with_cte(
        "positions",
        "SELECT query, rank, event_id FROM (SELECT query, event_id, row_number() OVER (PARTITION BY query ORDER BY event_id) AS rank "
        "FROM positions JOIN (VALUES ('DLH14'), ('C00'), ('AC0101'), ('NOSUCH')) v(query) "
        "ON upper(callsign) LIKE '%' || query || '%' OR upper(icao24) LIKE '%' || query || '%') x WHERE rank <= 5",
    ),
)
def substring_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five matches of several search texts in one scan."""
    rows = joins.find_matches(
        positions(spark, sf_dir), ["dlh14", "c00", " ac0101 ", "nosuch"], ["callsign", "icao24"], "event_id"
    )
    return rows.select("query", F.col("rank").cast("bigint").alias("rank"), "event_id")


@query(
    "substring_many",
    with_cte(
        "positions",
        "SELECT query, rank, event_id FROM (SELECT query, event_id, row_number() OVER (PARTITION BY query ORDER BY event_id) AS rank "
        "FROM positions JOIN (SELECT DISTINCT upper(trim(t)) AS query FROM (SELECT substr(callsign, 2, 4) AS t FROM positions UNION ALL "
        "SELECT right(icao24, 2) FROM positions UNION ALL VALUES ('NOSUCH'), (''))) v "
        "ON contains(upper(callsign), query) OR contains(upper(icao24), query)) x WHERE rank <= 5",
    ),
)
def substring_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five matches of every text of a table: parts of all callsigns and
    ids, one that is nowhere and an empty one."""
    rows = positions(spark, sf_dir)
    texts = F.array(F.substring("callsign", 2, 4), F.right("icao24", F.lit(2)), F.lit("NOSUCH"), F.lit(" "))
    found = joins.find_many(rows, rows.select(F.explode(texts).alias("text")), "text", ["callsign", "icao24"], "event_id")
    return found.select("query", F.col("rank").cast("bigint").alias("rank"), "event_id")


@query(
    "aircraft_lines",
    with_cte(
        "positions",
        "SELECT event_id, concat(coalesce(trim(callsign), '(no callsign)'), ' (icao24=', icao24, '): origin ', origin_country, "
        "', altitude ', coalesce(CAST(CAST(round_even(baro_altitude, 0) AS BIGINT) AS VARCHAR), 'n/a'), ' m, speed ', "
        "CAST(CAST(round_even(velocity * 3.6::DOUBLE, 0) AS BIGINT) AS VARCHAR), ' km/h, heading ', "
        "CAST(CAST(round_even(true_track, 0) AS BIGINT) AS VARCHAR), '°, position (', coalesce(CAST(lat AS VARCHAR), 'n/a'), ', ', "
        "coalesce(CAST(lon AS VARCHAR), 'n/a'), ')') AS line FROM positions "
        "WHERE time = (SELECT max(time) FROM positions)",
    ),
)
def aircraft_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text line per aircraft of the newest snapshot."""
    fields = ["callsign", "icao24", "origin_country", "baro_altitude", "velocity", "true_track", "lat", "lon"]
    rows = latest_state(positions(spark, sf_dir))
    return rows.select("event_id", aircraft_line(*[F.col(c) for c in fields]).alias("line"))
