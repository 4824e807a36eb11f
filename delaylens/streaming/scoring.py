"""Live scoring as a stream: each micro-batch of positions extends the sightings
and appends one scored row per airport and snapshot to the prediction history."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from delaylens.constants import SLIDE_SECONDS, TRAFFIC_WINDOWS
from delaylens.operators.joins import live_context, match_sites
from delaylens.operators.model import TrainedModel
from delaylens.plans.scoring import live_features, score_context
from delaylens.streaming.traffic import checkpoint_of, newest_state, run_available


def _write(rows: DataFrame, path: str, batch_id: int) -> None:
    """Rows by event day and batch: a repeated batch replaces itself, and readers
    of the last hours open no older folder."""
    tagged = rows.withColumns({"day": F.to_date(F.timestamp_seconds("time")), "batch_id": F.lit(batch_id)})
    (
        tagged.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day", "batch_id")
        .parquet(path)
    )


def traffic_at(snapshots: DataFrame, seen: DataFrame) -> DataFrame:
    """(time, airport, traffic_1h, traffic_3h): distinct aircraft of the windows
    that are current at each snapshot, of sightings up to that moment.

    `seen` has the first time of each (airport, aircraft, cell). An aircraft counts
    from a sighting until the cell's window ends or its next sighting takes over, so
    a sighting is one step up and one down of the airport's count, and the count at
    a snapshot is the sum of the steps until then: rows by moment, not by snapshot
    and sighting. Aircraft without an address show that there is traffic only."""
    cell = F.floor(F.col("time") / SLIDE_SECONDS)
    taken_over = F.lead("time").over(Window.partitionBy("airport", "icao24").orderBy("time"))
    named = F.col("icao24").isNotNull().cast("long")
    ends = {label: F.least((cell + size // SLIDE_SECONDS) * SLIDE_SECONDS, taken_over) for label, size in TRAFFIC_WINDOWS.items()}
    longest = max(TRAFFIC_WINDOWS, key=TRAFFIC_WINDOWS.get)
    lasting = seen.where(F.col("time").isNotNull()).select("airport", "time", named.alias("named"), *[end.alias(label) for label, end in ends.items()])

    def step(moment: str, sign: int, labels: list[str]) -> Column:
        steps = [(F.col("named") * sign if label in labels else F.lit(0).cast("long")).alias(f"traffic_{label}") for label in ends]
        return F.struct(F.col(moment).cast("long").alias("time"), *steps, F.lit(sign if longest in labels else 0).cast("long").alias("any"))

    steps = lasting.select("airport", F.inline(F.array(step("time", 1, [*ends]), *[step(label, -1, [label]) for label in ends])))
    sums = [*[f"traffic_{label}" for label in ends], "any"]
    moments = steps.groupBy("airport", "time").agg(*[F.sum(c).alias(c) for c in sums], F.lit(False).alias("asked"))
    asked = steps.select("airport").distinct().crossJoin(snapshots.select(F.col("time").cast("long").alias("time")))  # airports x snapshots
    both = moments.unionByName(asked.select("airport", "time", *[F.lit(0).cast("long").alias(c) for c in sums], F.lit(True).alias("asked")))
    until = Window.partitionBy("airport").orderBy("time").rangeBetween(Window.unboundedPreceding, 0)
    counted = both.select("airport", "time", "asked", *[F.sum(c).over(until).alias(c) for c in sums])
    return counted.where(F.col("asked") & (F.col("any") > 0)).select("time", "airport", *sums[:-1])


def score_stream(
    positions: DataFrame,
    model: TrainedModel,
    airports: DataFrame,
    reports: Callable[[], DataFrame],
    weather: Callable[[], DataFrame],
    holidays: DataFrame,
    sightings_path: str,
    history_path: str,
) -> None:
    """Scores every airport at every snapshot of each micro-batch.

    `reports` and `weather` are called in each micro-batch, so that what has come
    in since the start is seen. Rolling traffic comes from the sightings table, of
    which only the days of the longest window are read; the instant's count is the
    snapshot's own. A repeated micro-batch changes nothing."""
    spark = positions.sparkSession
    # the sites of the job: a dimension
    codes = F.array(*[F.lit(r[0]) for r in airports.select("airport").collect()])

    def predict(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        near = match_sites(rows)
        cell = F.floor(F.col("time") / SLIDE_SECONDS).alias("cell")
        first = near.groupBy("airport", "icao24", cell).agg(F.min("time").alias("time"))
        _write(first.select("airport", "icao24", "time"), sightings_path, batch_id)

        snapshots = rows.select("time").distinct()
        # one row: how far back the first snapshot looks
        oldest = snapshots.agg(F.to_date(F.timestamp_seconds(F.min("time") - max(TRAFFIC_WINDOWS.values())))).first()[0]
        if oldest is None:
            rows.unpersist()
            return
        seen = spark.read.parquet(sightings_path).where(F.col("day") >= F.lit(oldest))
        each = snapshots.select("time", F.explode(codes).alias("airport")).join(F.broadcast(airports), "airport")
        instant = near.groupBy("time", "airport").agg(F.count_distinct("icao24").alias("live_traffic_count"))
        context = live_context(each, reports(), weather(), traffic_at(snapshots, seen), instant, ("airport", "time"))
        moment = F.timestamp_seconds("time").cast("timestamp_ntz")
        scored = score_context(live_features(context.withColumn("at", moment), holidays, model.rates), model)
        history = scored.select(
            "airport", "time", "at", "risk_score", "risk_level", "live_traffic_count", "traffic_1h", "traffic_3h", "temperature_2m", "top_factors"
        )
        _write(history, history_path, batch_id)
        rows.unpersist()

    run_available(positions, predict, history_path)


def rescore_stream(ticks: DataFrame, predict: Callable[[DataFrame], DataFrame], state_path: str, history_path: str, interval: str | None = None) -> StreamingQuery:
    """Scores the newest state again at every tick, whether or not positions came.

    `ticks` is any stream with a `timestamp`, on a cluster the rate source; each
    micro-batch counts as one tick, that of its newest timestamp. `predict` gets the
    rows of the newest state (operators that read what is live are called in it) and
    returns scored rows, which are appended under the tick and its batch id: a
    repeated batch replaces itself, and a restart goes on behind the last tick of
    its checkpoint. Before the first state a tick scores nothing. With an
    `interval` the query runs until it is stopped, otherwise over all ticks that
    have come."""
    spark = ticks.sparkSession

    def tick(rows: DataFrame, batch_id: int) -> None:
        at, state = rows.agg(F.max("timestamp")).first()[0], newest_state(spark, state_path)
        if at is not None and state is not None:
            scored = predict(state).withColumns({"tick": F.lit(at), "batch_id": F.lit(batch_id)})
            scored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(history_path)

    job = ticks.writeStream.foreachBatch(tick).option("checkpointLocation", checkpoint_of(history_path))
    return (job.trigger(processingTime=interval) if interval else job.trigger(availableNow=True)).start()
