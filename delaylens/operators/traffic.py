"""Distinct aircraft per airport in sliding windows, and load series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from delaylens.constants import AIRPORTS, MATCH_RADIUS_DEG, SLIDE_SECONDS, TRAFFIC_WINDOWS
from delaylens.operators.joins import match_sites


def sightings(positions: DataFrame, sites: list[tuple] = AIRPORTS, radius: float = MATCH_RADIUS_DEG) -> DataFrame:
    """(airport, icao24, time) of every position near an airport."""
    return match_sites(positions, "lat", "lon", sites, radius).select("airport", "icao24", "time")


def sliding_distinct(
    seen: DataFrame,
    size: int,
    key: str = "airport",
    entity: str = "icao24",
    time: str = "time",
    slide: int = SLIDE_SECONDS,
) -> DataFrame:
    """Distinct entities per (key, window) for windows [end - size, end) every
    `slide` seconds; `time` is in epoch seconds. Empty windows give no row.

    Each window is a run of `slide`-second cells, so sightings shrink to one
    per (key, entity, cell) first. Instead of copying each into size/slide
    windows, an entity adds 1 at its cell and takes 1 away when that sighting
    leaves the window or its next one takes over; running totals of these
    changes over the cells of a key are the counts. A key has one row per cell
    by then, however many entities it saw.
    """
    if size % slide:
        raise ValueError("window size must be a multiple of the slide")
    span = size // slide
    cells = seen.select(key, entity, F.floor(F.col(time) / slide).alias("cell")).where("cell is not null").distinct()
    next_cell = F.lead("cell").over(Window.partitionBy(key, entity).orderBy("cell"))
    gone = F.least(F.col("cell") + span, F.coalesce(next_cell, F.col("cell") + span))
    changes = cells.select(key, "cell", gone.alias("gone")).select(
        key,
        F.inline(
            F.array(
                F.struct(F.col("cell").alias("at"), F.lit(1).alias("change")),
                F.struct(F.col("gone").alias("at"), F.lit(-1).alias("change")),
            )
        ),
    )
    per_cell = changes.groupBy(key, "at").agg(F.sum("change").alias("change"))
    by_time = Window.partitionBy(key).orderBy("at")
    steps = per_cell.select(
        key,
        "at",
        F.sum("change").over(by_time.rowsBetween(Window.unboundedPreceding, 0)).alias("n"),
        F.lead("at").over(by_time).alias("until"),
    ).where("n > 0")
    # n stays the same until the next change; a window ends one cell after its last
    return steps.select(
        key, "n", F.explode(F.sequence(F.col("at"), F.col("until") - 1)).alias("last_cell")
    ).select(key, ((F.col("last_cell") + 1) * slide).alias("window_end"), F.col("n").cast("bigint").alias("n"))


def sliding_distinct_direct(
    seen: DataFrame,
    size: int,
    key: str = "airport",
    entity: str = "icao24",
    time: str = "time",
    slide: int = SLIDE_SECONDS,
) -> DataFrame:
    """The same by copying every sighting into its windows; the check of
    sliding_distinct."""
    when = F.window(F.timestamp_seconds(F.col(time)), f"{size} seconds", f"{slide} seconds")
    return (
        seen.groupBy(key, when.alias("w"))
        .agg(F.count_distinct(entity).alias("n"))
        .select(key, F.unix_seconds("w.end").alias("window_end"), "n")
    )


def rolling_counts(
    seen: DataFrame, windows: dict[str, int] = TRAFFIC_WINDOWS, latest: Column | None = None
) -> DataFrame:
    """(airport, label, window_end, n) for every window length.

    With `latest`, only what the window of that time can hold is read: the
    longest window before it instead of the whole history."""
    if latest is not None:
        seen = seen.where(F.col("time") >= latest - F.lit(max(windows.values())))
    parts = [sliding_distinct(seen, size).withColumn("label", F.lit(label)) for label, size in windows.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def load_series(positions: DataFrame, sites: list[tuple] = AIRPORTS, radius: float = MATCH_RADIUS_DEG) -> DataFrame:
    """Positions near each airport per snapshot, zeros included."""
    counts = sightings(positions, sites, radius).groupBy("time", "airport").agg(F.count("*").alias("n"))
    every = positions.select("time").distinct().select("time", F.explode(F.array(*[F.lit(s[0]) for s in sites])).alias("airport"))
    return every.join(counts, ["time", "airport"], "left").fillna(0, ["n"])


def load_range(series: DataFrame, key: str = "airport") -> DataFrame:
    """Minimum, maximum and newest load per airport."""
    return series.groupBy(key).agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max_by("n", "time").alias("current"))
