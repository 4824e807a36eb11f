"""Ranking metrics and thresholds from score-grouped counts.

Rows shrink to one per distinct score before anything is ordered, and the
cumulative counts are split over score cells, so neither a score nor the whole
table has to fit one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from delaylens.operators.prefix import running_totals, value_cells
from delaylens.session import stage


def score_table(df: DataFrame, score: str, label: str, keys: list[str] | None = None) -> DataFrame:
    """Per distinct score, highest first: positives `p` and negatives `q` at the
    score, `tp` and `fp` at or above it, and the totals `positives` and `negatives`."""
    keys = keys or []
    rows = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    points = rows.groupBy(*keys, F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("q")
    )
    # written once: scoring is costly, and cells, offsets and ranks all read it
    points = stage(points, "score-counts")
    ranked = running_totals(points, keys, "score", ["p", "q"], value_cells(points, "score"), descending=True)
    return ranked.select(
        *keys,
        "score",
        "p",
        "q",
        (F.col("p_before") + F.col("p")).alias("tp"),
        (F.col("q_before") + F.col("q")).alias("fp"),
        F.col("p_total").alias("positives"),
        F.col("q_total").alias("negatives"),
    )


def ranking_metrics(df: DataFrame, score: str, label: str, keys: list[str] | None = None) -> DataFrame:
    """ROC AUC (ties count half) and average precision (step sum), null where a
    key has one class only."""
    table = score_table(df, score, label, keys)
    # doubles, because the pair count overflows a long at 10^10 rows
    twice_area = F.sum((2 * F.col("tp") - F.col("p")).cast("double") * F.col("q"))
    precision_steps = F.sum(F.col("p") * F.col("tp") / (F.col("tp") + F.col("fp")))
    positives, negatives = F.max("positives"), F.max("negatives")
    return table.groupBy(*(keys or [])).agg(
        F.try_divide(twice_area, positives.cast("double") * negatives * 2).alias("auc"),
        F.try_divide(precision_steps, positives).alias("average_precision"),
    )


def pr_curve(df: DataFrame, score: str, label: str, keys: list[str] | None = None) -> DataFrame:
    """Precision, recall and F1 at every distinct score used as threshold."""
    table = score_table(df, score, label, keys)
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    recall = F.try_divide(F.col("tp").cast("double"), F.col("positives"))
    return table.select(
        *(keys or []),
        F.col("score").alias("threshold"),
        precision.alias("precision"),
        recall.alias("recall"),
        F.try_divide(2.0 * F.col("tp"), F.col("tp") + F.col("fp") + F.col("positives")).alias("f1"),
    )


def best_f1(df: DataFrame, score: str, label: str, keys: list[str] | None = None) -> DataFrame:
    """The threshold with the highest F1, ties to the lowest threshold."""
    curve = pr_curve(df, score, label, keys)
    return curve.groupBy(*(keys or [])).agg(
        F.max_by("threshold", F.struct("f1", -F.col("threshold"))).alias("threshold"), F.max("f1").alias("f1")
    )


def confusion_metrics(df: DataFrame, score: str, label: str, threshold) -> DataFrame:
    """Counts, F1, precision and recall of score >= threshold (a number or a
    scalar column). Zero where a ratio has no cases."""
    flagged, positive = F.col(score) >= threshold, F.col(label) == 1
    counts = df.agg(
        F.count_if(flagged & positive).alias("tp"),
        F.count_if(flagged & ~positive).alias("fp"),
        F.count_if(~flagged & positive).alias("fn"),
        F.count_if(~flagged & ~positive).alias("tn"),
    )

    def ratio(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns(
        {"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "f1": ratio(2 * tp, 2 * tp + fp + fn)}
    )


def per_key_evaluation(df: DataFrame, key: str, score: str, label: str) -> DataFrame:
    """Rows, actual rate, mean score and AUC per key (null AUC for one class)."""
    basics = df.groupBy(key).agg(
        F.count("*").alias("n"),
        F.avg(F.col(label).cast("double")).alias("actual_rate"),
        F.avg(score).alias("mean_score"),
    )
    return basics.join(ranking_metrics(df, score, label, [key]).select(key, "auc"), key, "left")


def temporal_split(df: DataFrame, ts: str, cutoff: str) -> tuple[DataFrame, DataFrame]:
    """(rows before the cutoff, rows at or after it)."""
    at = F.lit(cutoff).cast("timestamp_ntz")
    return df.where(F.col(ts) < at), df.where(F.col(ts) >= at)


def fold_windows(end: str, months: int, folds: int) -> list[tuple[str, str]]:
    """Consecutive [start, end) validation windows of `months`, oldest first,
    the last one ending at `end`. Month arithmetic on the calendar."""
    year, month, day = (int(x) for x in end.split("-"))

    def back(n: int) -> str:
        index = year * 12 + month - 1 - n
        return f"{index // 12:04d}-{index % 12 + 1:02d}-{day:02d}"

    if day > 28:
        raise ValueError("fold ends must fall on day 1..28")
    return [(back(months * (i + 1)), back(months * i)) for i in reversed(range(folds))]


def fold_sizes(df: DataFrame, ts: str, folds: list[tuple[str, str]], cutoff: str) -> DataFrame:
    """Rows of every fold's training part (all before its start), of its
    validation window, and of the held-out test set, in one scan."""
    t = F.col(ts)

    def at(text: str):
        return F.lit(text).cast("timestamp_ntz")

    rows = []
    for i, (start, end) in enumerate(folds):
        rows += [(i, "train", t < at(start)), (i, "validation", (t >= at(start)) & (t < at(end)))]
    rows.append((len(folds), "test", t >= at(cutoff)))
    counts = df.agg(*[F.count_if(c).alias(f"c{j}") for j, (_, _, c) in enumerate(rows)])
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(i).cast("bigint").alias("fold"), F.lit(role).alias("role"), F.col(f"c{j}").alias("n"))
                    for j, (i, role, _) in enumerate(rows)
                ]
            )
        )
    )


def fold_summary(scores: DataFrame, keys: list[str], metrics: list[str], iteration: str | None = None) -> DataFrame:
    """Mean and population deviation of fold scores per configuration, and the
    mean best iteration rounded to even halves."""
    aggregates = []
    for m in metrics:
        aggregates += [F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std")]
    if iteration:
        aggregates.append(F.bround(F.avg(iteration), 0).cast("bigint").alias(f"{iteration}_mean"))
    return scores.groupBy(*keys).agg(*aggregates)
