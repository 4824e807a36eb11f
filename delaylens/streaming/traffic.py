"""Positions as a stream: ingest, sightings, window counts, latest state,
scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from delaylens.constants import SLIDE_SECONDS
from delaylens.operators.joins import match_sites
from delaylens.session import discard
from delaylens.sources.files import parse_states


def read_stream(
    spark: SparkSession, path: str, schema: StructType, pattern: str | None = None, files: int | None = None
) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.parquet(path)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """State-vector snapshots, one JSON text per line, as typed position rows."""
    lines = spark.readStream.text(path)
    return parse_states(lines, "value")


def checkpoint_of(target: str) -> str:
    """Where the stream that fills `target` keeps its progress: beside it, so
    that both are kept, or thrown away, together."""
    return f"{target.rstrip('/')}.checkpoint"


def run_available(df: DataFrame, batch: Callable[[DataFrame, int], None], target: str, mode: str = "append") -> None:
    """Runs a stream over everything not seen yet, one call of `batch` per
    micro-batch. Its checkpoint lies beside `target`: a later call with the same
    target goes on with new files and new batch ids."""
    job = (
        df.writeStream.outputMode(mode)
        .foreachBatch(batch)
        .option("checkpointLocation", checkpoint_of(target))
        .trigger(availableNow=True)
        .start()
    )
    job.awaitTermination()


def batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Writes each micro-batch under its id, so that a repeated one replaces
    itself."""

    def write(rows: DataFrame, batch_id: int) -> None:
        (
            rows.withColumn("batch_id", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(path)
        )

    return write


def with_event_time(positions: DataFrame, delay: str, time: str = "time") -> DataFrame:
    """A watermarked timestamp from epoch seconds."""
    return positions.withColumn("event_time", F.timestamp_seconds(time)).withWatermark("event_time", delay)


def write_sightings(positions: DataFrame, path: str) -> None:
    """Keeps a table of sightings, one per (airport, aircraft, 5-minute cell)
    and micro-batch. Window counts read its last hours; no state is kept."""

    def per_cell(rows: DataFrame, batch_id: int) -> None:
        cell = (F.floor(F.col("time") / SLIDE_SECONDS) * SLIDE_SECONDS).alias("time")
        batch_writer(path)(match_sites(rows).select("airport", "icao24", cell).distinct(), batch_id)

    run_available(positions, per_cell, path)


def window_counts(positions: DataFrame, size: int, slide: int = SLIDE_SECONDS) -> DataFrame:
    """Distinct aircraft per airport and sliding window with a watermark: each
    window is final, and emitted once, when the watermark passes its end.

    State is one entry per (window, airport, aircraft), spread by all three."""
    seen = match_sites(positions).select(
        "airport", "icao24", F.window("event_time", f"{size} seconds", f"{slide} seconds").alias("window")
    )
    return (
        seen.dropDuplicates(["window", "airport", "icao24"])
        .groupBy("window", "airport")
        .agg(F.count("*").alias("n"))
        .select("airport", F.unix_seconds("window.end").alias("window_end"), "n")
    )


def count_per_window(events: DataFrame, key: str, size: str) -> DataFrame:
    """Rows per key and fixed window of a watermarked stream; rows later than
    the watermark are dropped."""
    counts = events.groupBy(F.window("event_time", size).alias("window"), key).agg(F.count("*").alias("n"))
    return counts.select(key, F.unix_seconds("window.end").alias("window_end"), "n")


def latest_positions(positions: DataFrame) -> DataFrame:
    """Newest position per aircraft as a running aggregate: rows are combined
    before the shuffle, so a busy aircraft costs one row per task. Readers drop
    aircraft whose time is too old."""
    located = positions.where("lat is not null and lon is not null")
    newest = F.max(F.struct("time", "lat", "lon"))
    return located.groupBy("icao24").agg(newest.alias("p")).select("icao24", "p.*")


_STATE = "time bigint, lat double, lon double"
_CHANGE = "icao24 string, time bigint, lat double, lon double, status string"


def track_latest(positions: DataFrame, ttl_seconds: int) -> DataFrame:
    """Latest position per aircraft as a changelog: `seen` on every newer
    position, `evicted` once event time has moved `ttl_seconds` past it.

    State is one row per aircraft; rows arrive grouped per micro-batch only."""

    def newest(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            last = state.get
            state.remove()
            yield pd.DataFrame([(key[0], *last, "evicted")], columns=["icao24", "time", "lat", "lon", "status"])
            return
        known = state.get if state.exists else None
        best = known
        for batch in batches:
            row = batch.loc[batch["time"].idxmax()]
            if best is None or row["time"] > best[0]:
                best = (int(row["time"]), float(row["lat"]), float(row["lon"]))
        if best is None or best == known:  # nothing newer came
            if known is not None:
                state.setTimeoutTimestamp(max((known[0] + ttl_seconds) * 1000, state.getCurrentWatermarkMs() + 1))
            return
        state.update(best)
        state.setTimeoutTimestamp(max((best[0] + ttl_seconds) * 1000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame([(key[0], *best, "seen")], columns=["icao24", "time", "lat", "lon", "status"])

    located = positions.where("lat is not null and lon is not null").select("icao24", "time", "lat", "lon", "event_time")
    return located.groupBy("icao24").applyInPandasWithState(
        newest, _CHANGE, _STATE, "update", GroupStateTimeout.EventTimeTimeout
    )


def _batches(spark: SparkSession, path: str) -> list[int]:
    """Ids of the micro-batches whose rows lie below `path` as a whole."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [f.getPath().getName() for f in files.listStatus(folder)]
    whole = [n for n in names if n.startswith("batch_id=") and files.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    return sorted(int(n.split("=")[1]) for n in whole)


def newest_state(spark: SparkSession, path: str) -> DataFrame | None:
    """The state that `keep_newest_snapshot` last completed, None before the first."""
    found = _batches(spark, f"{path}/state")
    return spark.read.parquet(f"{path}/state/batch_id={found[-1]}") if found else None


def keep_newest_snapshot(positions: DataFrame, path: str, entity: str = "icao24", time: str = "time") -> None:
    """Keeps the newest snapshot as state, and what changed as a log.

    The state's clock is the time of its rows. A micro-batch with a newer snapshot
    replaces it, so an entity that the newer snapshot lacks is gone at once, however
    recent its last row; rows of the same time are added, older ones change nothing.
    Each micro-batch writes its own state below `path`/state and its changes
    (`entity`, time, `seen` or `gone`) below `path`/changes; both hold one snapshot's
    rows at most. A repeated micro-batch starts from the state before it and
    replaces its own, and a state counts only once it is whole. Of several rows of
    an entity in one snapshot the first by the other columns stays; null times are
    no snapshot."""
    spark = positions.sparkSession

    def step(rows: DataFrame, batch_id: int) -> None:
        before = [b for b in _batches(spark, f"{path}/state") if b < batch_id]
        known = spark.read.parquet(f"{path}/state/batch_id={before[-1]}") if before else rows.limit(0)
        both = rows.where(F.col(time).isNotNull()).unionByName(known)
        # one number: the clock
        clock = both.agg(F.max(time)).first()[0]
        rest = [c for c in rows.columns if c not in (entity, time)]
        newest = both.where(F.col(time) == F.lit(clock)).groupBy(entity, time).agg(F.min(F.struct(*rest)).alias("__rest"))
        newest = newest.select(*[F.col(c) if c in (entity, time) else F.col(f"__rest.{c}").alias(c) for c in rows.columns])
        newest.write.mode("overwrite").parquet(f"{path}/state/batch_id={batch_id}")
        now = spark.read.parquet(f"{path}/state/batch_id={batch_id}")
        old = known.select(F.col(entity).alias("__old"), F.col(time).alias("__before"))
        met = now.select(entity, time).join(old, F.col(entity).eqNullSafe(F.col("__old")), "full_outer")
        gone = F.col(time).isNull()
        changes = met.where(gone | F.col("__before").isNull() | (F.col("__before") < F.col(time))).select(
            F.when(gone, F.col("__old")).otherwise(F.col(entity)).alias(entity), F.lit(clock).alias(time), F.when(gone, "gone").otherwise("seen").alias("status")
        )
        changes.write.mode("overwrite").parquet(f"{path}/changes/batch_id={batch_id}")
        for past in before[:-1]:  # the one before this batch stays, for a repetition
            discard(spark, f"{path}/state/batch_id={past}")

    run_available(positions, step, path)
