"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints
one JSON line. Every query runs over its whole tables; building the plan
counts, and the rows go to the no-op sink so that nothing is pruned away."""

from __future__ import annotations

import json
import os
import time

from delaylens.plans import catalog
from delaylens.session import get_session

HEADLINE = [
    "scan_pruned",
    "filter_rewrite",
    "calendar_features",
    "holiday_flag",
    "weather_left_join",
    "metar_left_join",
    "rolling_count",
    "rolling_ties",
    "feature_table",
    "chunked_equals_whole",
    "proximity_join",
    "proximity_grid",
    "nearest_airport",
    "registry_join",
    "entity_enrich_reasons",
    "expected_and_label",
    "describe",
    "sliding_distinct_1h",
    "sliding_distinct_3h",
    "current_window",
    "last_n_track",
    "trend_series",
    "pr_curve",
    "per_key_eval",
    "dim_flight",
    "fact_load",
    "fk_audit",
    "cube_breakdown",
    "rollup_time",
    "stream_sightings_windows",
    "stream_window_counts",
    "cv_metrics",  # builds the features and runs the walk-forward search
    "train_model",  # fits the final model and scores the test part
    "stored_model",  # loads the newest model and scores every flight twice
    "score_flights",  # scores and explains every flight
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = get_session("delaylens-bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    catalog.load_all()
    # start the JVM's reader and code generator outside the timings
    catalog.QUERIES["group_sizes"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
