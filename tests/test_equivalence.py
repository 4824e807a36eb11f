"""The split forms give what the plain forms give, also on heavy keys."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from delaylens.functions import geo
from delaylens.operators import joins, prefix, rolling, traffic
from delaylens.operators.history import last_n_track


def same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows, and one instant a third of them."""
    rng = np.random.default_rng(7)
    n = 3000
    seconds = rng.integers(0, 4 * 86400, n)
    seconds[: n // 3] = 5000
    rows = pd.DataFrame(
        {
            "id": np.arange(n),
            "adep": np.where(rng.random(n) < 0.8, "HOT", "COLD"),
            "first_seen": pd.Timestamp("2024-01-01") + pd.to_timedelta(seconds, unit="s"),
            "delayed_15min": (rng.random(n) < 0.2).astype("int64"),
        }
    )
    return spark.createDataFrame(rows).withColumn("first_seen", F.col("first_seen").cast("timestamp_ntz")).cache()


@pytest.mark.parametrize("cell", [600, 3600, 10**6])
def test_trailing_windows(skewed, cell):
    a = rolling.trailing_windows(skewed, cell_seconds=cell)
    b = rolling.trailing_windows_direct(skewed)
    rounded = ["id", "traffic_1h", "traffic_3h", *[F.round(c, 9).alias(c) for c in ("delay_rate_1h", "delay_rate_3h")]]
    same(a.select(rounded), b.select(rounded))


def test_trailing_windows_equal_pandas(skewed):
    ours = rolling.trailing_windows(skewed).where("adep = 'COLD'").toPandas()
    theirs = skewed.where("adep = 'COLD'").toPandas().set_index("first_seen").sort_index()
    window = theirs["delayed_15min"].rolling("3h", closed="left")
    assert ours["traffic_3h"].sum() == window.count().fillna(0).sum()
    assert np.isclose(ours["delay_rate_3h"].sum(), window.mean().sum())


def test_exact_quantiles(skewed):
    values = skewed.withColumn("v", F.unix_seconds(F.col("first_seen").cast("timestamp")) % 7919 / 7)
    ours = prefix.exact_quantiles(values, ["adep"], "v", {"p10": 0.1, "p50": 0.5}, F.floor(F.col("v") / 50))
    plain = values.groupBy("adep").agg(F.percentile("v", 0.1).alias("p10"), F.percentile("v", 0.5).alias("p50"))
    rounded = ["adep", F.round("p10", 9), F.round("p50", 9)]
    same(ours.select(rounded), plain.select(rounded))


def test_running_totals_treat_null_as_a_key(spark):
    points = spark.createDataFrame([(None, 1, 2), (None, 2, 3), ("a", 1, 5)], "k string, o int, n bigint")
    rows = prefix.running_totals(points, ["k"], "o", ["n"], F.col("o")).orderBy("k", "o").collect()
    assert [(r["n_before"], r["n_total"]) for r in rows] == [(0, 5), (2, 5), (0, 5)]


def test_dense_ids_are_dense_and_stable(spark):
    rows = spark.range(5000).select(F.concat(F.lit("same prefix "), F.col("id")).alias("k"))
    once = prefix.dense_ids(rows, ["k"], "id")
    assert once.agg(F.min("id"), F.max("id"), F.count_distinct("id")).first() == (1, 5000, 5000)
    same(once, prefix.dense_ids(rows.repartition(3), ["k"], "id"))


@pytest.mark.parametrize("size", [300, 3600])
def test_sliding_distinct(spark, size):
    rng = np.random.default_rng(3)
    n = 2000
    rows = pd.DataFrame(
        {
            "airport": np.where(rng.random(n) < 0.9, "HOT", "COLD"),
            "icao24": [f"a{i}" for i in rng.integers(0, 40, n)],
            "time": rng.integers(0, 2 * 86400, n) // 90 * 90,
        }
    )
    seen = spark.createDataFrame(rows)
    same(traffic.sliding_distinct(seen, size), traffic.sliding_distinct_direct(seen, size))


def test_grid_equals_inline_match(spark):
    rng = np.random.default_rng(5)
    crowd = np.where(rng.random(2000) < 0.4, 0.0, 1.0)  # many positions in one cell
    rows = spark.createDataFrame(
        pd.DataFrame({"id": range(2000), "lat": 50 + crowd * rng.uniform(-3, 3, 2000), "lon": 8.5 + crowd * rng.uniform(-3, 3, 2000)})
    )
    sites = [("A", 50.0379, 8.5622), ("B", 50.4, 8.9), ("C", -1.0, -1.0)]
    table = spark.createDataFrame(sites, "airport string, site_lat double, site_lon double")
    inline = joins.match_sites(rows, sites=sites).select("id", "airport")
    for salt in (1, 8):
        same(joins.grid_match(rows, table, salt=salt).select("id", "airport"), inline)


def test_track_keeps_the_last_positions(spark):
    rows = spark.createDataFrame([("a", t, float(t)) for t in range(40)], "icao24 string, time int, lat double")
    (track,) = last_n_track(rows, "icao24", "time", ["lat"], 15).collect()
    assert [p["lat"] for p in track["track"]] == [float(t) for t in range(25, 40)]


def many_sites(n=400):
    rng = np.random.default_rng(4)
    return [(f"S{i:03d}", float(a), float(o)) for i, (a, o) in enumerate(zip(rng.uniform(35, 60, n), rng.uniform(-10, 25, n)))]


def test_four_hundred_sites(spark):
    """Inline forms, grid forms and plain loops agree, ties to the first listed."""
    sites = many_sites()
    sites.append(("TWIN", *sites[7][1:]))
    rng = np.random.default_rng(5)
    points = [(i, float(a), float(o)) for i, (a, o) in enumerate(zip(rng.uniform(30, 65, 300), rng.uniform(-60, 40, 300)))]
    points += [(300, *sites[7][1:]), (301, None, 3.0)]
    df = spark.createDataFrame(points, "id int, lat double, lon double").cache()
    table = spark.createDataFrame([(i, *s) for i, s in enumerate(sites)], "place int, site string, site_lat double, site_lon double")
    near = {i: min(range(len(sites)), key=lambda k: ((a - sites[k][1]) ** 2 + (o - sites[k][2]) ** 2, k)) for i, a, o in points[:-1]}
    inline = df.select("id", geo.nearest_site(F.col("lat"), F.col("lon"), sites).alias("site"))
    assert {r.id: r.site for r in inline.collect()} == {**{i: sites[k][0] for i, k in near.items()}, 301: None}
    grid = joins.nearest_grid(df, table, "id", "site", order="place")
    assert {r.id: r.site for r in grid.collect()} == {i: sites[k][0] for i, k in near.items()}
    same(joins.match_sites(df, sites=sites).select("id", "airport"), joins.grid_match(df, table).select("id", F.col("site").alias("airport")))


def test_direct_windows_only_grow_within_cells(spark):
    """One key that holds all rows: its windows are cut by time as well, none
    slides, and they count as a plain loop does, over cell borders and ties."""
    rng = np.random.default_rng(3)
    times = [int(t) for t in rng.integers(0, 5 * 10_800, 400)] + [10_800, 21_600, 21_600]
    labels = [None if x < 0.1 else int(x < 0.4) for x in rng.random(len(times))]
    rows = spark.createDataFrame([(i, "A", t, y) for i, (t, y) in enumerate(zip(times, labels))] + [(999, "A", None, 1)], "id int, adep string, s bigint, delayed_15min int")
    rolled = rolling.trailing_windows_direct(rows.withColumn("first_seen", F.timestamp_seconds("s").cast("timestamp_ntz")))
    got = {r.id: (r.traffic_1h, r.traffic_3h, r.delay_rate_3h) for r in rolled.collect()}
    plain = {999: (0, 0, None)}
    for i, t in enumerate(times):
        one, three = ([y for u, y in zip(times, labels) if t - w <= u < t and y is not None] for w in (3600, 10_800))
        plain[i] = (len(one), len(three), sum(three) / len(three) if three else None)
    assert got == plain
    text = rolled._jdf.queryExecution().optimizedPlan().toString()
    assert "_cell" in text and "RangeFrame, -" not in text


def test_crowded_sites(spark, monkeypatch):
    """Sites crowded on a spot and copies at one place: no position is measured
    against more than the limit, and the closest is found."""
    rng = np.random.default_rng(8)
    sites = [(50 + a, 8 + o) for a, o in rng.uniform(0, 1e-4, (600, 2))] + [(40.0, 3.0)] * 300 + [tuple(p) for p in rng.uniform(30, 60, (100, 2))]
    points = [(i, float(a), float(o)) for i, (a, o) in enumerate([*(50 + rng.uniform(0, 1e-4, (100, 2)) - [0, 42]), *rng.uniform(-89, 89, (100, 2)), (40.0, 3.0)])]
    kept, stage = [], joins.stage
    monkeypatch.setattr(joins, "stage", lambda df, label: kept.append((label, stage(df, label))) or kept[-1][1])
    table = spark.createDataFrame([(i, float(a), float(o)) for i, (a, o) in enumerate(sites)], "site int, site_lat double, site_lon double")
    grid = joins.nearest_grid(spark.createDataFrame(points, "id int, lat double, lon double"), table, "id", "site")
    near = {i: min(range(len(sites)), key=lambda k: ((a - sites[k][0]) ** 2 + (o - sites[k][1]) ** 2, k)) for i, a, o in points}
    assert {r.id: r.site for r in grid.collect()} == near
    cells = [df.agg(F.min("sites")).first()[0] for label, df in kept if label == "cells"]
    assert cells[-1] <= joins.NEAR_SITES and len(cells) > 3
    assert dict(kept)["sites"].count() == 701
    assert joins.nearest_grid(spark.createDataFrame(points, "id int, lat double, lon double"), table.limit(0), "id", "site").count() == 0


def test_changes_across_days(spark):
    from delaylens.operators.history import change_series

    rows = [("A", 10, 0.1), ("A", 86000, 0.2), ("A", 3 * 86400, 0.3), ("B", 10, 0.5), ("B", 3 * 86400, 0.9), ("A", 3 * 86400 + 5, 0.3)]
    got = change_series(spark.createDataFrame(rows, "airport string, time bigint, risk double"), "airport", "time", "risk").collect()
    assert {(r.airport, r.time, r.from_pct, r.to_pct) for r in got} == {("A", 86000, 10, 20), ("A", 3 * 86400, 20, 30)}


def test_cells_follow_the_values(spark):
    """One far outlier, and scores crowded near 0.03: no cell holds many rows, and
    the statistics are exact."""
    from delaylens.operators import metrics, profile

    rng = np.random.default_rng(9)
    values = np.append(rng.normal(0, 1, 4000), 1e12)
    scores = np.round(0.03 + rng.random(4001) * 1e-3, 7)
    df = spark.createDataFrame(pd.DataFrame({"v": values, "s": scores, "y": (rng.random(4001) < 0.05).astype("int64")})).cache()
    for column in ("v", "s"):
        largest = df.groupBy(prefix.value_cells(df, column).alias("cell")).count().agg(F.max("count")).first()[0]
        assert largest < 4001 / 64
    stats = profile.summary_statistics(df, ["v", "s"]).toPandas().set_index("column")
    for column, plain in (("v", values), ("s", scores)):
        assert np.allclose(stats.loc[column, ["p25", "p50", "p75"]].astype(float), np.percentile(plain, [25, 50, 75]))
    area = metrics.ranking_metrics(df, "s", "y").first()["auc"]
    y = df.toPandas().sort_values("s")
    ranks = y["s"].rank().to_numpy()
    positive = y["y"].to_numpy() == 1
    p, q = positive.sum(), (~positive).sum()
    assert np.isclose(area, (ranks[positive].sum() - p * (p + 1) / 2) / (p * q))


def test_many_searches_equal_the_direct_form(spark):
    rows = [(1, "ABCD", "xy"), (2, "abce", None), (3, None, None), (4, "ZABC ", "abab"), (5, "", "q"), (6, "ÄBC", "bc")]
    df = spark.createDataFrame(rows, "i long, a string, b string")
    texts = ["abc", " ABCD", "b", "bc", "", "äb", "abcx", "abab", "q", "zz"]
    searches = spark.createDataFrame([(t,) for t in [*texts, *texts, None]], "t string")
    direct = {(r["query"], r["rank"], r["i"]) for r in joins.find_matches(df, texts, ["a", "b"], "i", 2).collect()}
    for limit in (joins.BROADCAST_GRAMS, 0):
        joins.BROADCAST_GRAMS, before = limit, joins.BROADCAST_GRAMS
        try:
            found = joins.find_many(df, searches, "t", ["a", "b"], "i", 2).collect()
        finally:
            joins.BROADCAST_GRAMS = before
        assert {(r["query"], r["rank"], r["i"]) for r in found} == direct and len(found) == len(direct)
    assert joins.find_many(df.limit(0), searches, "t", ["a"], "i").count() == 0


def test_fact_load_moves_narrow_rows(spark, monkeypatch):
    """What a row says by itself is not written with the joined source, and the
    audited fact has its own columns only; ids keep the order of the hex digest."""
    from delaylens.plans import queries_warehouse as qw

    staged, stage = {}, qw.stage
    monkeypatch.setattr(qw, "stage", lambda df, label: staged.setdefault(label, stage(df, label)))
    qw.fact_audit(spark, "/root/testdata/sf0.001")
    assert not {"departure", "arrival", *qw.CAUSES} & set(staged["shipments"].columns)
    assert staged["fact"].columns == qw._FACT_OUT
    ids = prefix.dense_ids(spark.range(300).selectExpr("CAST(id AS STRING) AS k"), ["k"], "n").withColumn("h", F.md5("k")).orderBy("n").collect()
    assert [r.n for r in ids] == list(range(1, 301)) and [r.h for r in ids] == sorted(r.h for r in ids)
