"""Snapshot histories: bounded buffers, tracks, trends, changes, drivers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from delaylens.constants import PREDICTION_HISTORY, SLIDE_SECONDS, TRACK_LENGTH
from delaylens.functions.text import feature_label, percent_half_even, percent_half_up


def bounded_history(df: DataFrame, time: str = "time", keep: int = PREDICTION_HISTORY) -> DataFrame:
    """Rows of the newest `keep` snapshot times. The time list has at most
    `keep` rows, so it is broadcast."""
    newest = df.select(time).distinct().orderBy(F.col(time).desc()).limit(keep)
    return df.join(F.broadcast(newest), time, "left_semi")


def latest_state(df: DataFrame, time: str = "time") -> DataFrame:
    """Rows of the newest snapshot; entities absent from it are gone."""
    return df.where(F.col(time) == df.agg(F.max(time)).scalar())


def last_n_track(df: DataFrame, entity: str, time: str, point: list[str], n: int = TRACK_LENGTH) -> DataFrame:
    """The last n positions per entity as an array, oldest first. Ranks are cut
    to n rows per entity in every map partition before the shuffle."""
    newest = Window.partitionBy(entity).orderBy(F.col(time).desc(), *[F.col(c).desc() for c in point])
    kept = df.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") <= n)
    steps = F.sort_array(F.collect_list(F.struct((-F.col("_rn")).alias("_o"), *point)))
    return kept.groupBy(entity).agg(F.transform(steps, lambda s: F.struct(*[s[c].alias(c) for c in point])).alias("track"))


def trend_series(
    df: DataFrame, entity: str, time: str, value: Column, keep: int = PREDICTION_HISTORY, name: str = "series"
) -> DataFrame:
    """Each entity's values over the bounded history, oldest first, without
    nulls; one value per entity and snapshot (the largest, should there be
    more), so a list has at most `keep` entries."""
    recent = bounded_history(df, time, keep).withColumn("_v", value).where("_v is not null")
    recent = recent.groupBy(entity, time).agg(F.max("_v").alias("_v"))
    steps = F.sort_array(F.collect_list(F.struct(F.col(time).alias("t"), F.col("_v").alias("v"))))
    return recent.groupBy(entity).agg(F.transform(steps, lambda s: s["v"]).alias(name))


def risk_trend(df: DataFrame, entity: str = "airport", time: str = "time", score: str = "risk_score") -> DataFrame:
    return trend_series(df, entity, time, percent_half_even(F.col(score)))


def snapshot_delta(
    df: DataFrame, entity: str = "airport", time: str = "time", score: str = "risk_score", top: int | None = 6
) -> DataFrame:
    """Whole-percent change between the two newest snapshots, changed entities
    only, largest change first."""
    two = bounded_history(df, time, 2)
    newest = two.agg(F.max(time)).scalar()
    seen = two.withColumn("_new", F.col(time) == newest)
    pairs = seen.groupBy(entity).agg(
        F.max(F.when(~F.col("_new"), percent_half_up(F.col(score)))).alias("from_pct"),
        F.max(F.when(F.col("_new"), percent_half_up(F.col(score)))).alias("to_pct"),
    )
    changed = pairs.where("from_pct <> to_pct").withColumn("delta_pts", F.col("to_pct") - F.col("from_pct"))
    if top is None:
        return changed
    return changed.orderBy(F.abs("delta_pts").desc(), entity).limit(top)


def change_series(df: DataFrame, entity: str, time: str, score: str) -> DataFrame:
    """Change against the entity's previous snapshot, over the whole history.

    The previous snapshot of a time is looked up among the distinct times, day by
    day; the first of a day follows the last of the newest day before it (one row
    a day), so neither an entity's history nor the times are ordered in one task."""
    day = F.floor(F.col(time) / 86400) if dict(df.dtypes)[time] in ("bigint", "int", "double") else F.unix_date(F.to_date(time))
    times = df.select(time, day.alias("_day")).distinct()
    days = times.groupBy("_day").agg(F.max(time).alias("_last"))
    before_day = days.select("_day", F.lag("_last").over(Window.orderBy("_day")).alias("_last_before"))
    in_day = Window.partitionBy("_day").orderBy(time)
    previous = times.withColumn("_lag", F.lag(time).over(in_day)).join(before_day, "_day").select(time, F.coalesce("_lag", "_last_before").alias("_prev"))
    now = df.join(previous, time)
    before = df.select(F.col(entity), F.col(time).alias("_prev"), F.col(score).alias("_before"))
    pct = percent_half_up
    return (
        now.join(before, [entity, "_prev"])
        .select(entity, time, pct(F.col("_before")).alias("from_pct"), pct(F.col(score)).alias("to_pct"))
        .where("from_pct <> to_pct")
        .withColumn("delta_pts", F.col("to_pct") - F.col("from_pct"))
    )


def current_window(
    counts: DataFrame,
    airports: DataFrame,
    latest: Column,
    labels: list[str],
    carry_forward: bool = False,
    slack: int = SLIDE_SECONDS,
) -> DataFrame:
    """Per (airport, label), the count of the newest window ending at or before
    latest + slack seconds; 0 where there is none.

    `counts(airport, label, window_end, n)` holds non-empty windows only. With
    carry_forward=True a quiet airport keeps the count of its own newest window
    however old it is; otherwise only the newest possible window counts."""
    usable = counts.where(F.col("window_end") <= latest + F.lit(slack))
    if not carry_forward:
        newest_end = F.floor((latest + F.lit(slack)) / F.lit(SLIDE_SECONDS)) * F.lit(SLIDE_SECONDS)
        usable = usable.where(F.col("window_end") == newest_end)
    best = usable.groupBy("airport").agg(
        *[
            F.max_by(F.when(F.col("label") == w, F.col("n")), F.when(F.col("label") == w, F.col("window_end"))).alias(f"traffic_{w}")
            for w in labels
        ]
    )
    return airports.join(best, "airport", "left").fillna(0, [f"traffic_{w}" for w in labels])


def top_factors(
    df: DataFrame,
    names: list[str],
    contributions: Column,
    shown: Column,
    missing_type: Column,
    top: int = 3,
    minimum: float = 1e-6,
) -> Column:
    """Array of the strongest drivers of each row.

    `contributions` and `shown` are arrays in the order of `names`; a missing
    aircraft type is left out before ranking, and tiny effects among the first
    `top` are dropped after it. Ties keep the order of `names`."""
    # zipped as arguments, so that the texts are worked out once a row
    labels = F.array(*[F.lit(n) for n in names])
    placed = F.transform(F.zip_with(shown, contributions, lambda v, c: F.struct(v.alias("value"), c.alias("contribution"))), lambda p, i: F.struct(i.alias("i"), p.alias("p")))
    pairs = F.zip_with(
        placed,
        labels,
        lambda p, n: F.struct(
            (-F.abs(p["p"]["contribution"])).alias("rank"),
            p["i"].alias("position"),
            n.alias("feature"),
            p["p"]["value"].alias("value"),
            p["p"]["contribution"].alias("contribution"),
        ),
    )
    usable = F.filter(pairs, lambda p: ~((p["feature"] == "typecode") & missing_type))
    strongest = F.filter(F.slice(F.sort_array(usable), 1, top), lambda p: F.abs(p["contribution"]) > minimum)
    return F.transform(
        strongest,
        lambda p: F.struct(
            p["feature"].alias("feature"),
            feature_label(p["feature"]).alias("label"),
            p["value"].alias("value"),
            F.round(p["contribution"], 4).alias("contribution"),
            F.when(p["contribution"] > 0, "increases").otherwise("decreases").alias("direction"),
        ),
    )


def latest_run(runs: DataFrame, name: str = "run_name", started: str = "start_time", run_id: str = "run_id") -> DataFrame:
    """Newest run of each name."""
    rest = [c for c in runs.columns if c != name]
    return runs.groupBy(name).agg(F.max_by(F.struct(*rest), F.struct(started, run_id)).alias("_r")).select(name, "_r.*")


def rank_by_risk(df: DataFrame, score: str = "risk_score", tie: str = "ordinal") -> DataFrame:
    """Highest risk first, ties in display order."""
    return df.orderBy(F.col(score).desc(), tie)


def peak(df: DataFrame, keys: list[str], what: str, score: str, tie: str) -> DataFrame:
    """The `what` with the highest score per key, ties to the lowest `tie`."""
    best = F.struct(-F.col(score), F.col(tie))
    return df.groupBy(*keys).agg(F.min_by(what, best).alias(what), F.max(score).alias(score))
