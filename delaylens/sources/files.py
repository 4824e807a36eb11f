"""File sources and sinks. Readers prune columns and push filters to the scan;
writers leave the file count to Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from delaylens.constants import FLIGHT_COLUMNS, REGISTRY_COLUMNS, STATE_FIELDS
from delaylens.functions.calendar import hour_text
from delaylens.functions.text import first_nonempty, normalise_id
from delaylens.functions.weather import (
    category_label,
    ceiling_from_columns,
    ceiling_from_layers,
    flight_category,
    knots_to_kmh,
    parse_visibility,
)
from delaylens.operators.joins import keep_first

OBSERVATION_SCHEMA = (
    "station string, valid timestamp_ntz, vsby double, gust double, "
    "skyc1 string, skyl1 double, skyc2 string, skyl2 double, skyc3 string, skyl3 double, skyc4 string, skyl4 double"
)
STATES_SCHEMA = "time bigint, states array<array<string>>"
REPORT_SCHEMA = "icaoId string, visib string, clouds array<struct<cover:string, base:double>>, temp double, wspd double"
HOURLY_SCHEMA = (
    "hourly struct<time:array<string>, temperature_2m:array<double>, "
    "precipitation:array<double>, wind_speed_10m:array<double>>"
)


def load_flights(
    spark: SparkSession, paths: list[str] | str, scope: list[str] | None = None, columns: list[str] = FLIGHT_COLUMNS
) -> DataFrame:
    """Named columns of one or many flight files, departures in scope only; both
    reach the Parquet scan."""
    paths = [paths] if isinstance(paths, str) else paths
    flights = spark.read.parquet(*paths).select(*columns)
    return flights if scope is None else flights.where(in_scope("adep", scope))


def in_scope(column: str, scope: list[str]) -> Column:
    return F.col(column).isin(scope)


def either_end(scope: list[str], origin: str = "adep", destination: str = "ades") -> Column:
    return in_scope(origin, scope) | in_scope(destination, scope)


def union_files(frames: list[DataFrame]) -> DataFrame:
    """All rows of frames whose columns may differ; absent columns are null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def rewrite_filtered(df: DataFrame, condition: Column, path: str, partition_by: list[str]) -> None:
    """Filtered copy in partition folders. The rebalance hint gathers each
    folder's rows and lets adaptive execution cut a heavy one into files of the
    advisory size, and join small ones."""
    kept = df.where(condition).hint("rebalance", *partition_by)
    kept.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def head_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first n rows in a stated order."""
    return df.orderBy(*order).limit(n)


def sample_rows(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """A random sample over the whole range; the first rows of a file sorted by
    time would cover its oldest part only."""
    return df.sample(fraction=fraction, seed=seed)


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    """Station reports as CSV with M for missing, tagged with their airport."""
    rows = spark.read.schema(OBSERVATION_SCHEMA).option("header", True).option("nullValue", "M").csv(path)
    return rows.withColumnRenamed("station", "airport")


def hourly_observations(observations: DataFrame) -> DataFrame:
    """One row per (airport, hour): mean visibility, lowest ceiling, category."""
    covers, bases = [f"skyc{i}" for i in (1, 2, 3, 4)], [f"skyl{i}" for i in (1, 2, 3, 4)]
    tagged = observations.withColumns({"hour": hour_text(F.col("valid")), "_ceiling": ceiling_from_columns(covers, bases)})
    hourly = tagged.groupBy("airport", "hour").agg(
        F.avg("vsby").alias("visibility_mi"), F.min("_ceiling").alias("ceiling_ft")
    )
    return hourly.withColumn(
        "flight_category", flight_category(F.col("visibility_mi"), F.col("ceiling_ft"), "fallthrough").cast("double")
    )


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Aircraft registry CSV, all strings, blanks kept as empty text, with the
    position of each row for keep-first."""
    rows = spark.read.option("header", True).option("emptyValue", "").option("nullValue", "\u0000").csv(path)
    # ids grow within a split; file and split offset order the splits themselves
    position = F.struct("_metadata.file_name", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    return rows.select(*REGISTRY_COLUMNS, position.alias("position"))


def load_registry(rows: DataFrame, position: str = "position") -> DataFrame:
    """One row per aircraft: first by position, lower-case id, attributes from
    the first filled sibling column, blanks as null."""
    named = rows.where(F.coalesce("icao24", F.lit("")) != "").withColumn("icao24", normalise_id(F.col("icao24")))

    def filled(*names: str) -> Column:
        return first_nonempty(*[F.col(n) for n in names])

    return keep_first(named, ["icao24"], [position]).select(
        "icao24",
        filled("registration").alias("registration"),
        filled("manufacturername", "manufacturericao").alias("manufacturer"),
        filled("model").alias("model"),
        filled("typecode").alias("typecode"),
        filled("operator", "owner", "operatorcallsign", "operatoricao").alias("operator"),
    )


def hourly_arrays_to_rows(df: DataFrame, json: str = "json") -> DataFrame:
    """Parallel hourly arrays in a JSON text become one row per hour."""
    rest = [c for c in df.columns if c != json]
    hourly = F.from_json(json, HOURLY_SCHEMA)["hourly"]
    fields = ["time", "temperature_2m", "precipitation", "wind_speed_10m"]
    return df.select(*rest, hourly.alias("_h")).select(
        *rest, F.inline(F.arrays_zip(*[F.col("_h")[f].alias(f) for f in fields]))
    )


def parse_states(df: DataFrame, json: str = "json") -> DataFrame:
    """State-vector snapshots {time, states: [[...]]} as one typed row per
    aircraft with its position in the snapshot; a null list gives none."""
    parsed = df.select(F.from_json(json, STATES_SCHEMA).alias("s"))
    vectors = parsed.select(F.col("s.time").alias("time"), F.posexplode("s.states").alias("pos", "v"))

    def field(i: int, name: str, kind: str) -> Column:
        raw = F.get(F.col("v"), F.lit(i))
        return (F.trim(raw) if name == "callsign" else raw.try_cast(kind)).alias(name)

    return vectors.select("time", "pos", *[field(i, n, k) for i, (n, k) in enumerate(STATE_FIELDS)])


def parse_reports(df: DataFrame, stations: list[str], json: str = "json") -> DataFrame:
    """Live weather reports as typed rows for known stations; others are
    dropped."""
    rest = [c for c in df.columns if c != json]
    r = df.select(*rest, F.from_json(json, REPORT_SCHEMA).alias("r")).where(F.col("r.icaoId").isin(stations))
    shaped = r.select(
        *rest,
        F.col("r.icaoId").alias("airport"),
        parse_visibility(F.col("r.visib")).alias("visibility_mi"),
        ceiling_from_layers(F.col("r.clouds")).alias("ceiling_ft"),
        F.col("r.temp").alias("temperature_2m"),
        knots_to_kmh(F.col("r.wspd")).alias("wind_speed_10m"),
    )
    category = flight_category(F.col("visibility_mi"), F.col("ceiling_ft"), "null")
    return shaped.withColumn("flight_category", category).withColumn(
        "flight_category_label", category_label(F.col("flight_category"))
    )


def conform(df: DataFrame, schema: list[tuple[str, str]]) -> DataFrame:
    """Columns of a fixed schema, in order and cast; others are dropped."""
    return df.select(*[F.col(name).cast(kind).alias(name) for name, kind in schema])


def write_conformed(df: DataFrame, schema: list[tuple[str, str]], path: str) -> None:
    """A fresh folder per run: stale parts of an earlier run cannot be counted."""
    conform(df, schema).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
