"""Sources and sinks over the given tables (A*, B1, B2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from delaylens.constants import AIRPORT_CODES, EXTRACTED_SCHEMA
from delaylens.plans.catalog import query
from delaylens.plans.testdata import (
    SCOPE,
    SCOPE_SQL,
    flights,
    positions,
    registry_rows,
    weather,
    with_cte,
)
from delaylens.session import shared_dir
from delaylens.sources import files

_FLIGHT_OUT = "flight_id, icao24, adep, ades, typecode, delayed_15min"


@query(
    "scan_pruned",
    "SELECT event_id, event_type, value FROM events WHERE event_type IN ('click', 'view')",
)
def scan_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three columns and one filter, both in the Parquet scan."""
    path = f"{sf_dir}/events.parquet"
    rows = files.load_flights(spark, path, columns=["event_id", "event_type", "value"])
    return rows.where(files.in_scope("event_type", ["click", "view"]))


@query(
    "union_all",
    with_cte(
        "flights",
        "SELECT adep, count(*) AS n, CAST(sum(delayed_15min) AS BIGINT) AS delayed FROM ("
        "SELECT adep, delayed_15min FROM flights WHERE k < 50 UNION ALL "
        "SELECT adep, delayed_15min FROM flights WHERE k >= 30) u GROUP BY adep",
    ),
)
def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping parts flattened, duplicates kept."""
    rows = flights(spark, sf_dir).select("adep", "delayed_15min", "k")
    both = files.union_files([rows.where("k < 50").drop("k"), rows.where("k >= 30").drop("k")])
    return both.groupBy("adep").agg(F.count("*").alias("n"), F.sum("delayed_15min").alias("delayed"))


@query(
    "filter_rewrite",
    with_cte("flights", f"SELECT {_FLIGHT_OUT} FROM flights WHERE adep IN ({SCOPE_SQL}) OR ades IN ({SCOPE_SQL})"),
)
def filter_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Either-end filter rewritten as a partitioned copy and read back."""
    path = shared_dir(spark, "filter-rewrite")
    rows = flights(spark, sf_dir).select(*[c.strip() for c in _FLIGHT_OUT.split(",")])
    files.rewrite_filtered(rows, files.either_end(SCOPE), path, ["adep"])
    return spark.read.parquet(path).select(*[c.strip() for c in _FLIGHT_OUT.split(",")])


@query("head_sample", with_cte("flights", "SELECT flight_id, icao24, adep FROM flights ORDER BY flight_id LIMIT 500"))
def head_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows in a stated order (a sampling operator)."""
    return files.head_rows(flights(spark, sf_dir).select("flight_id", "icao24", "adep"), ["flight_id"], 500)


@query(
    "csv_null_token",
    with_cte(
        "flights",
        "SELECT adep AS airport, strftime(first_seen, '%Y-%m-%dT%H:00') AS hour, "
        "round(avg(CASE WHEN k % 7 <> 0 THEN CAST(k AS DOUBLE) / 10 END), 6) AS visibility_mi, "
        "min(CASE WHEN k % 3 = 0 THEN k * 100.0::DOUBLE ELSE 12000.0::DOUBLE END) AS ceiling_ft "
        "FROM flights GROUP BY 1, 2",
    ),
)
def csv_null_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations written as CSV with M for missing, read back with a fixed
    schema and collapsed to hours."""
    path = shared_dir(spark, "observations")
    blank = F.lit("M")
    rows = flights(spark, sf_dir).select(
        F.col("adep").alias("station"),
        F.date_format("first_seen", "yyyy-MM-dd'T'HH:mm:ss").alias("valid"),
        F.when(F.col("k") % 7 == 0, blank).otherwise((F.col("k") / 10).cast("string")).alias("vsby"),
        blank.alias("gust"),
        F.when(F.col("k") % 3 == 0, "OVC").otherwise("FEW").alias("skyc1"),
        (F.col("k") * 100).cast("string").alias("skyl1"),
        F.lit("BKN").alias("skyc2"),
        blank.alias("skyl2"),
        *[blank.alias(c) for c in ("skyc3", "skyl3", "skyc4", "skyl4")],
    )
    files.write_csv(rows, path)
    hourly = files.hourly_observations(files.read_observations(spark, path))
    return hourly.select("airport", "hour", F.round("visibility_mi", 6).alias("visibility_mi"), "ceiling_ft")


@query("registry_load", with_cte("registry_rows registry", "SELECT * FROM registry"))
def registry_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First row per aircraft, attributes by first filled sibling column."""
    return files.load_registry(registry_rows(spark, sf_dir), "p_partkey")


@query(
    "registry_csv",
    with_cte(
        "registry_rows registry",
        "SELECT icao24, count(*) AS n, count(DISTINCT registration) AS n_registrations FROM registry GROUP BY icao24",
    ),
)
def registry_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry through its CSV form: all strings, blanks kept."""
    path = shared_dir(spark, "registry")
    files.write_csv(registry_rows(spark, sf_dir).drop("p_partkey"), path)
    loaded = files.load_registry(files.read_registry(spark, path))
    return loaded.groupBy("icao24").agg(F.count("*").alias("n"), F.count_distinct("registration").alias("n_registrations"))


@query(
    "json_arrays_to_rows",
    with_cte(
        "flights weather",
        "SELECT airport, time, round(temperature_2m, 6) AS temperature_2m, round(precipitation, 6) AS precipitation, "
        "round(wind_speed_10m, 6) AS wind_speed_10m FROM weather",
    ),
)
def json_arrays_to_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly weather as one JSON of parallel arrays per airport and day, turned
    back into rows."""
    names = ["time", "temperature_2m", "precipitation", "wind_speed_10m"]
    days = (
        weather(spark, sf_dir)
        .groupBy("airport", F.substring("time", 1, 10).alias("day"))
        .agg(F.sort_array(F.collect_list(F.struct(*names))).alias("h"))
    )
    hourly = F.struct(*[F.col("h")[n].alias(n) for n in names]).alias("hourly")
    documents = days.select("airport", F.to_json(F.struct(hourly)).alias("json"))
    rows = files.hourly_arrays_to_rows(documents)
    return rows.select("airport", "time", *[F.round(n, 6).alias(n) for n in names[1:]])


@query(
    "state_vectors",
    with_cte(
        "positions",
        "SELECT time, icao24, trim(callsign) AS callsign, round(lat, 6) AS latitude, round(lon, 6) AS longitude, "
        "round(velocity, 6) AS velocity FROM positions",
    ),
)
def state_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions as 17-field state vectors in JSON, typed again by position."""
    p = positions(spark, sf_dir)
    fields = [
        F.col("icao24"),
        F.col("callsign"),
        F.col("origin_country"),
        F.col("time"),
        F.col("time"),
        F.col("lon"),
        F.col("lat"),
        F.col("baro_altitude"),
        F.lit(False),
        F.col("velocity"),
        F.col("true_track"),
        *[F.lit(None)] * 6,
    ]
    snapshots = p.select(
        F.to_json(
            F.struct("time", F.array(F.array(*[f.cast("string") for f in fields])).alias("states")),
            {"ignoreNullFields": "false"},
        ).alias("json")
    )
    rows = files.parse_states(snapshots)
    return rows.select(
        "time", "icao24", "callsign", *[F.round(c, 6).alias(c) for c in ("latitude", "longitude", "velocity")]
    )


_VISIBILITY_TEXT = (
    "CASE k % 8 WHEN 0 THEN '10+' WHEN 1 THEN '3' WHEN 2 THEN '1/2' WHEN 3 THEN 'M1/4' WHEN 4 THEN '1 1/2' "
    "WHEN 5 THEN '1/0' WHEN 6 THEN NULL ELSE '2.5' END"
)
_VISIBILITY_MILES = "CASE k % 8 WHEN 0 THEN 10 WHEN 1 THEN 3 WHEN 2 THEN 0.5 WHEN 3 THEN 0.25 WHEN 7 THEN 2.5 ELSE NULL END"
_CEILING = (
    "least(CASE WHEN k % 3 = 0 THEN CAST(k AS DOUBLE) * 100 ELSE 12000 END, "
    "CASE WHEN k % 5 = 0 THEN CAST(k AS DOUBLE) * 50 ELSE 12000 END)"
)


@query(
    "report_parse",
    with_cte(
        "flights",
        "SELECT flight_id, airport, visibility_mi, ceiling_ft, temperature_2m, wind_speed_10m, "
        "CAST(CASE WHEN visibility_mi IS NULL THEN NULL WHEN visibility_mi < 1 OR ceiling_ft < 500 THEN 3 "
        "WHEN visibility_mi < 3 OR ceiling_ft < 1000 THEN 2 WHEN visibility_mi < 5 OR ceiling_ft < 3000 THEN 1 ELSE 0 END AS BIGINT) "
        "AS flight_category FROM (SELECT flight_id, adep AS airport, "
        f"CAST({_VISIBILITY_MILES} AS DOUBLE) AS visibility_mi, least({_CEILING}, 12000) AS ceiling_ft, "
        "CAST(k AS DOUBLE) - 40 AS temperature_2m, round(k * CAST(1.852 AS DOUBLE), 6) AS wind_speed_10m "
        f"FROM flights WHERE adep IN ({SCOPE_SQL})) r",
    ),
)
def report_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live reports through their JSON form; LSZH is no known station."""
    k = F.col("k")

    def layer(cover, base):
        return F.struct(cover.alias("cover"), base.cast("double").alias("base"))

    clouds = F.array(
        layer(F.when(k % 3 == 0, "OVC").otherwise("FEW"), k * 100),
        layer(F.when(k % 5 == 0, "BKN").otherwise("SCT"), k * 50),
        layer(F.lit("VV"), F.lit(None)),
    )
    documents = flights(spark, sf_dir).select(
        "flight_id",
        F.to_json(
            F.struct(
                F.col("adep").alias("icaoId"),
                F.expr(_VISIBILITY_TEXT).alias("visib"),
                clouds.alias("clouds"),
                (k - 40).alias("temp"),
                k.alias("wspd"),
            )
        ).alias("json"),
    )
    rows = files.parse_reports(documents, AIRPORT_CODES)
    return rows.drop("flight_category_label").withColumn("wind_speed_10m", F.round("wind_speed_10m", 6))


@query(
    "schema_conform",
    with_cte(
        "flights",
        "SELECT adep, CAST(epoch_us(first_seen) AS BIGINT) AS first_seen_us, CAST(hour(first_seen) AS BIGINT) AS hour_of_day, "
        "CAST(k AS DOUBLE) AS temperature_2m, typecode, delayed_15min FROM flights",
    ),
)
def schema_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows cast to the fixed extract schema, written and read back."""
    path = shared_dir(spark, "conform")
    rows = flights(spark, sf_dir).withColumns(
        {
            "hour_of_day": F.hour("first_seen"),
            "temperature_2m": F.col("k"),
            **{n: F.lit(None) for n, _ in EXTRACTED_SCHEMA[3:7] + EXTRACTED_SCHEMA[8:13]},
        }
    )
    files.write_conformed(rows, EXTRACTED_SCHEMA, path)
    return spark.read.parquet(path).select(
        "adep",
        F.unix_micros(F.col("first_seen").cast("timestamp")).alias("first_seen_us"),
        "hour_of_day",
        "temperature_2m",
        "typecode",
        "delayed_15min",
    )


@query(
    "scope_filter",
    with_cte("flights", f"SELECT flight_id, adep FROM flights WHERE adep IN ({SCOPE_SQL})"),
)
def scope_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flights(spark, sf_dir).where(files.in_scope("adep", SCOPE)).select("flight_id", "adep")


@query(
    "either_end_filter",
    with_cte(
        "flights",
        f"SELECT flight_id, adep, ades, (adep IN ({SCOPE_SQL}) AND ades IN ({SCOPE_SQL})) AS internal "
        f"FROM flights WHERE adep IN ({SCOPE_SQL}) OR ades IN ({SCOPE_SQL})",
    ),
)
def either_end_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    internal = files.in_scope("adep", SCOPE) & files.in_scope("ades", SCOPE)
    rows = flights(spark, sf_dir).where(files.either_end(SCOPE))
    return rows.select("flight_id", "adep", "ades", internal.alias("internal"))
