"""State by snapshot clock and timed scoring, delivery by delivery."""

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from delaylens.operators.history import latest_state
from delaylens.session import shared_dir
from delaylens.streaming import traffic as live
from delaylens.streaming.scoring import rescore_stream, traffic_at

DDL = "icao24 string, time long, lat double, lon double"


def test_state_is_the_newest_snapshot_after_every_delivery(spark):
    source, path = shared_dir(spark, "in"), shared_dir(spark, "newest")
    parts = [
        [("a", 1, 1.0, 1.0), ("b", 1, 2.0, 2.0), ("a", 1, 1.0, 1.0)],
        [("a", 2, 1.5, 1.0), ("c", 2, None, None), (None, 2, 0.0, 0.0)],  # b is gone at once
        [("b", 1, 2.0, 2.0), ("d", None, 3.0, 3.0)],  # late, and without a time
        [("d", 2, 3.0, 3.0)],  # the rest of the same snapshot
        [("b", 9, 4.0, 4.0)],
    ]
    told, seen = set(), []
    for rows in parts:
        seen += rows
        spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(source)
        live.keep_newest_snapshot(live.read_stream(spark, source, spark.createDataFrame([], DDL).schema), path)
        want = {tuple(r) for r in latest_state(spark.createDataFrame(seen, DDL)).distinct().collect()}
        state = live.newest_state(spark, path).collect()
        assert {tuple(r) for r in state} == want and len(state) == len(want)
        last = spark.read.parquet(f"{path}/changes").groupBy("icao24").agg(F.max_by("status", "batch_id").alias("s")).where("s = 'seen'")
        told = {r.icao24 for r in last.collect()}
        assert told == {r.icao24 for r in state}
    assert len(live._batches(spark, f"{path}/state")) == 2


def test_a_half_written_state_does_not_count(spark):
    path = shared_dir(spark, "newest")
    assert live.newest_state(spark, path) is None
    spark.createDataFrame([("a", 1, 0.0, 0.0)], DDL).write.parquet(f"{path}/state/batch_id=0")
    spark.createDataFrame([("b", 2, 0.0, 0.0)], DDL).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/state/batch_id=1")
    assert [r.icao24 for r in live.newest_state(spark, path).collect()] == ["a"]


def batches(spark, path):
    try:
        return sorted(r[0] for r in spark.read.parquet(path).select("batch_id").distinct().collect())
    except AnalysisException:  # nothing written yet
        return []


def test_ticks_score_without_positions_and_go_on_after_a_stop(spark):
    path, out = shared_dir(spark, "newest"), shared_dir(spark, "history")
    spark.createDataFrame([("a", 1, 0.0, 0.0), ("b", 1, 0.0, 0.0)], DDL).write.parquet(f"{path}/state/batch_id=0")

    def run(until):
        ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
        job = rescore_stream(ticks, lambda state: state.select("icao24", F.lit(0.5).alias("risk_score")), path, out, "1 second")
        try:
            for _ in range(120):
                job.awaitTermination(1)
                done = batches(spark, out)
                if len(done) >= until:
                    return done
        finally:
            job.stop()
        raise AssertionError("no ticks")

    first = run(2)
    second = run(len(first) + 1)
    assert set(first) < set(second)
    rows = spark.read.parquet(out)
    assert rows.groupBy("batch_id").agg(F.count("*").alias("n"), F.count_distinct("tick").alias("t")).where("n <> 2 or t <> 1").count() == 0


def test_traffic_at_counts_each_sighting_in_steps(spark):
    rng = np.random.default_rng(5)
    sightings = sorted({(f"A{rng.integers(2)}", f"ac{k}" if (k := rng.integers(5)) else None, int(rng.integers(40_000)) // 90 * 90) for _ in range(300)}, key=str)
    sightings += sightings[:20] + [("B", None, 100)]  # repeated by a second batch; no address
    seen = spark.createDataFrame([*sightings, ("B", "ac9", None)], "airport string, icao24 string, time long")
    moments = [*range(0, 52_000, 450), 899, 900, 901]
    rows = traffic_at(spark.createDataFrame([(m,) for m in moments], "time long"), seen)
    expected = {}
    for at in moments:
        for airport in ("A0", "A1", "B"):
            spans = {s: {(i, t) for a, i, t in sightings if a == airport and t <= at and t // 300 > at // 300 - s} for s in (12, 36)}
            if spans[36]:
                expected[at, airport] = tuple(len({i for i, _ in spans[s] if i}) for s in (12, 36))
    assert {(r.time, r.airport): (r.traffic_1h, r.traffic_3h) for r in rows.collect()} == expected
    # what becomes of a sighting does not depend on how many snapshots look back at it
    assert "explode(sequence(" not in rows._jdf.queryExecution().toString()
