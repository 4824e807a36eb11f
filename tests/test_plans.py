"""What the plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from delaylens.operators import joins, rolling
from delaylens.operators.history import last_n_track
from delaylens.plans.testdata import flights, positions
from delaylens.streaming.traffic import window_counts, with_event_time

SF_DIR = "/root/testdata/sf0.001"
# these build several jobs or a model before they return
EAGER = ("stream_", "cv_", "train_", "score_", "entity_risk", "early_", "importance", "attribution", "stored_", "late_", "chunked", "batch_rerun", "final_run")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if not n.startswith(EAGER)))
def test_no_cross_join_and_no_python(spark, name):
    shown = plan(entry.queries()[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in shown


def test_scan_is_pruned_and_filtered(spark):
    shown = plan(entry.queries()["scan_pruned"](spark, SF_DIR))
    assert "PushedFilters: [In(event_type, [click,view])]" in shown
    assert "ReadSchema: struct<event_id:bigint,event_type:string,value:double>" in shown


def test_top_per_key_is_cut_before_the_shuffle(spark):
    located = positions(spark, SF_DIR).where("lat is not null")
    assert "WindowGroupLimit" in plan(last_n_track(located, "icao24", "time", ["lon", "lat"]))
    assert "WindowGroupLimit" in plan(joins.keep_first(located, ["icao24"], ["event_id"]))


def test_trailing_windows_have_no_sliding_frame(spark):
    shown = plan(rolling.trailing_windows(flights(spark, SF_DIR)))
    assert "RangeFrame, unboundedpreceding$(), -1" in shown
    assert "RangeFrame, -" not in shown


def test_features_read_only_what_they_need(spark):
    shown = plan(flights(spark, SF_DIR).groupBy("adep").agg(F.sum("delayed_15min")))
    assert "ReadSchema: struct<event_type:string,value:double,props:string>" in shown


def test_stream_state_is_keyed_by_aircraft(spark):
    stream = spark.readStream.schema("icao24 string, lat double, lon double, time bigint").parquet("/root/testdata/sf0.001")
    counts = window_counts(with_event_time(stream, "1 hour"), 3600)
    assert counts.isStreaming and counts.columns == ["airport", "window_end", "n"]
