"""Profiling aggregates: counts, shares, statistics, histograms, networks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from delaylens.constants import DELAY_THRESHOLD_MIN
from delaylens.operators.prefix import exact_quantiles


def value_counts(df: DataFrame, column: str, normalise: bool = False, dropna: bool = True) -> DataFrame:
    """Rows per value; normalise=True adds each value's share of the counted rows."""
    rows = df.where(F.col(column).isNotNull()) if dropna else df
    counts = rows.groupBy(column).agg(F.count("*").alias("n"))
    if not normalise:
        return counts
    return counts.withColumn("share", F.col("n") / counts.agg(F.sum("n")).scalar())


def summary_statistics(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max per column, one row each.

    One scan gives the moments; the quartiles are exact and computed over
    distinct values in spans that hold about equally many, so neither a column nor
    its crowded part has to fit one task."""
    moments = df.agg(
        *[
            F.struct(
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(F.col(c).cast("double")).alias("min"),
                F.max(F.col(c).cast("double")).alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    stacked = moments.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("s")) for c in columns]))
    ).select("column", "s.*")
    long = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]))
    )
    quartiles = exact_quantiles(long, ["column"], "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return stacked.join(quartiles, "column", "left")


def missing_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null count and share per column, in one scan."""
    flags = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return flags.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.col(c).alias("n_missing"),
                        F.try_divide(F.col(c).cast("double"), F.col("_rows")).alias("share_missing"),
                    )
                    for c in columns
                ]
            )
        )
    )


def correlation_with_target(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """Pearson correlation of each column with the target over rows where both
    are present."""
    pairs = [(F.col(c).cast("double"), F.col(target).cast("double")) for c in columns]
    one_row = df.agg(*[F.corr(x, y).alias(c) for c, (x, y) in zip(columns, pairs)])
    return one_row.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("correlation")) for c in columns]))
    )


def rate_by_key(df: DataFrame, key: str, label: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(F.col(label).cast("double")).alias("mean"), F.count(label).alias("count"))


def either_role_counts(df: DataFrame, scope: list[str], origin: str = "adep", destination: str = "ades") -> DataFrame:
    """Rows per scope member that is origin or destination, once per row."""
    ends = F.array_distinct(F.array_compact(F.array(*[F.when(F.col(c).isin(scope), F.col(c)) for c in (origin, destination)])))
    return df.select(F.explode(ends).alias("airport")).groupBy("airport").agg(F.count("*").alias("n"))


def monthly_counts(df: DataFrame, ts: str) -> DataFrame:
    return df.groupBy(F.date_format(ts, "yyyy-MM").alias("month")).agg(F.count("*").alias("n"))


def date_span(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.min(ts).alias("first"), F.max(ts).alias("last"))


def match_ratio(df: DataFrame, condition: Column) -> DataFrame:
    counts = df.agg(F.count("*").alias("total"), F.count_if(condition).alias("matched"))
    return counts.withColumn("percent", F.try_divide(F.col("matched") * 100.0, F.col("total")))


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int, cut: float | None = None) -> DataFrame:
    """Counts in equal bins of the values clipped to [low, high]; empty bins are
    kept and the last bin is closed. `cut` marks the bins at or above it."""
    width = (high - low) / bins
    clipped = F.greatest(F.lit(low), F.least(F.lit(high), F.col(column)))
    index = F.least(F.floor((clipped - low) / width), F.lit(bins - 1)).cast("bigint")
    counts = df.where(F.col(column).isNotNull()).groupBy(index.alias("bin")).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    out = every.join(counts, "bin", "left").select(
        "bin", (F.lit(low) + F.col("bin") * width).alias("lower"), F.coalesce("n", F.lit(0)).alias("n")
    )
    return out if cut is None else out.withColumn("above_cut", F.col("lower") >= cut)


def route_edges(df: DataFrame, nodes: list[str], origin: str = "adep", destination: str = "ades") -> DataFrame:
    """Directed edge weights between nodes; a node without any outgoing edge
    stays as one row with a null destination and weight 0."""
    both = F.col(origin).isin(nodes) & F.col(destination).isin(nodes)
    edges = df.where(both).groupBy(F.col(origin).alias("src"), F.col(destination).alias("dst")).agg(F.count("*").alias("weight"))
    every = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(n) for n in nodes])).alias("src"))
    return every.join(edges, "src", "left").fillna(0, ["weight"])


def top_other_ends(df: DataFrame, scope: list[str], k: int = 15, origin: str = "adep", destination: str = "ades") -> DataFrame:
    """Busiest partners outside the scope of flights with exactly one end in it."""
    inside_origin, inside_destination = F.col(origin).isin(scope), F.col(destination).isin(scope)
    external = df.where((inside_origin | inside_destination) & ~(inside_origin & inside_destination))
    other = F.when(inside_origin, F.col(destination)).otherwise(F.col(origin)).alias("airport")
    return top_k(external.groupBy(other).agg(F.count("*").alias("n")), [F.col("n").desc(), F.col("airport")], k)


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def expected_and_label(
    df: DataFrame,
    group: list[str],
    actual: str = "duration_min",
    threshold: float = DELAY_THRESHOLD_MIN,
    inclusive: bool = True,
    cell_minutes: float = 60.0,
) -> DataFrame:
    """Adds expected_duration_min (exact median of `actual` per group),
    delay_min and delayed_15min (delay >= threshold, or > if not inclusive)."""
    cell = F.floor(F.col(actual) / cell_minutes)
    expected = exact_quantiles(df, group, actual, {"expected_duration_min": 0.5}, cell)
    delay = F.col(actual) - F.col("expected_duration_min")
    late = (F.col("delay_min") >= threshold) if inclusive else (F.col("delay_min") > threshold)
    return df.join(expected, group, "left").withColumn("delay_min", delay).withColumn("delayed_15min", late.cast("bigint"))


def class_balance(df: DataFrame, label: str, multiplier: float = 1.0) -> DataFrame:
    """Negatives, positives and the weight of a positive row."""
    counts = df.agg(
        F.count_if(F.col(label) == 0).alias("n_negative"), F.count_if(F.col(label) == 1).alias("n_positive")
    )
    return counts.withColumn("positive_weight", F.try_divide(F.col("n_negative") * multiplier, F.col("n_positive")))


def rates_with_default(df: DataFrame, wanted: DataFrame, key: str = "adep", label: str = "delayed_15min") -> DataFrame:
    """Mean label for every key in `wanted`; an unknown key gets the mean of
    the keys' rates (not of the rows)."""
    rates = df.groupBy(key).agg(F.avg(F.col(label).cast("double")).alias("rate"))
    default = rates.agg(F.avg("rate")).scalar()
    return wanted.join(rates, key, "left").withColumn("rate", F.coalesce("rate", default))
