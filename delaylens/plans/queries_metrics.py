"""Evaluation queries over scored rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from delaylens.operators import metrics
from delaylens.plans.catalog import query
from delaylens.plans.testdata import scored, with_cte
from delaylens.session import shared_dir
from delaylens.sources.files import write_csv

_FOLD_END = "2001-01-01"
_FOLDS = metrics.fold_windows(_FOLD_END, 6, 4)

_CURVE = (
    "curve AS (SELECT score, p, q, sum(p) OVER (ORDER BY score DESC) AS tp, sum(q) OVER (ORDER BY score DESC) AS fp, "
    "sum(p) OVER () AS pp, sum(q) OVER () AS nn FROM (SELECT score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS q "
    "FROM scored GROUP BY score) s)"
)


def _with_curve(body: str) -> str:
    return with_cte("scored", "SELECT 1").removesuffix(" SELECT 1") + ", " + _CURVE + " " + body


@query(
    "temporal_split",
    with_cte(
        "scored",
        "SELECT CASE WHEN first_seen < TIMESTAMP '2001-01-01' THEN 'train' ELSE 'test' END AS part, l_orderkey, l_linenumber FROM scored",
    ),
)
def temporal_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = metrics.temporal_split(scored(spark, sf_dir), "first_seen", _FOLD_END)
    return train.select(F.lit("train").alias("part"), "l_orderkey", "l_linenumber").unionByName(
        test.select(F.lit("test").alias("part"), "l_orderkey", "l_linenumber")
    )


@query(
    "fold_sizes",
    with_cte(
        "scored",
        "SELECT i AS fold, role, count(*) FILTER (CASE role WHEN 'train' THEN first_seen < s WHEN 'validation' THEN first_seen >= s AND first_seen < e "
        "ELSE first_seen >= TIMESTAMP '2001-01-01' END) AS n FROM scored, (SELECT i, TIMESTAMP '1999-01-01' + to_months(CAST(6 * i AS INT)) AS s, "
        "TIMESTAMP '1999-01-01' + to_months(CAST(6 * i + 6 AS INT)) AS e, role FROM range(5) r(i), (VALUES ('train'), ('validation'), ('test')) v(role) "
        "WHERE (i < 4) = (role <> 'test')) f GROUP BY 1, 2",
    ),
)
def fold_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of four expanding half-year folds and the test part."""
    return metrics.fold_sizes(scored(spark, sf_dir), "first_seen", _FOLDS, _FOLD_END)


@query(
    "roc_auc",
    with_cte(
        "scored",
        "SELECT round((sum(CASE WHEN label = 1 THEN rk END) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2) "
        "/ (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)::DOUBLE), 6) AS auc FROM (SELECT label, avg(rn) OVER (PARTITION BY score) AS rk "
        "FROM (SELECT label, score, row_number() OVER (ORDER BY score) AS rn FROM scored) a) b",
    ),
)
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUC; the check computes it by rank sums instead."""
    return metrics.ranking_metrics(scored(spark, sf_dir), "score", "label").select(F.round("auc", 6).alias("auc"))


@query("average_precision", _with_curve("SELECT round(sum(p / pp * tp / (tp + fp)), 6) AS average_precision FROM curve"))
def average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = metrics.ranking_metrics(scored(spark, sf_dir), "score", "label")
    return rows.select(F.round("average_precision", 6).alias("average_precision"))


@query(
    "pr_curve",
    _with_curve(
        "SELECT score AS threshold, round(tp / (tp + fp), 6) AS precision, round(tp / pp, 6) AS recall, "
        "round(2 * tp / (tp + fp + pp), 6) AS f1 FROM curve"
    ),
)
def pr_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = metrics.pr_curve(scored(spark, sf_dir), "score", "label")
    return rows.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


_BEST = "SELECT score AS threshold, 2 * tp / (tp + fp + pp) AS f1 FROM curve ORDER BY f1 DESC, score LIMIT 1"


@query("best_f1", _with_curve(f"SELECT threshold, round(f1, 6) AS f1 FROM ({_BEST}) b"))
def best_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.best_f1(scored(spark, sf_dir), "score", "label").withColumn("f1", F.round("f1", 6))


@query(
    "confusion_metrics",
    _with_curve(
        "SELECT tp, fp, fn, tn, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, "
        "round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM (SELECT count(*) FILTER (s AND label = 1) AS tp, count(*) FILTER (s AND label = 0) AS fp, "
        "count(*) FILTER (NOT s AND label = 1) AS fn, count(*) FILTER (NOT s AND label = 0) AS tn FROM "
        f"(SELECT label, score >= (SELECT threshold FROM ({_BEST}) b) AS s FROM scored WHERE first_seen >= TIMESTAMP '2001-01-01') x) y"
    ),
)
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test-part counts at the threshold with the best F1 over all rows."""
    rows = scored(spark, sf_dir)
    threshold = metrics.best_f1(rows, "score", "label").select("threshold").scalar()
    _, test = metrics.temporal_split(rows, "first_seen", _FOLD_END)
    out = metrics.confusion_metrics(test, "score", "label", threshold)
    return out.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(
    "per_key_eval",
    with_cte(
        "scored",
        "SELECT adep, count(*) AS n, round(avg(label), 6) AS actual_rate, round(avg(score), 6) AS mean_score, "
        "round((sum(CASE WHEN label = 1 THEN rk END) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2) "
        "/ (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)::DOUBLE), 6) AS auc FROM (SELECT *, avg(rn) OVER (PARTITION BY adep, score) AS rk "
        "FROM (SELECT *, row_number() OVER (PARTITION BY adep ORDER BY score) AS rn FROM scored) a) b GROUP BY adep",
    ),
)
def per_key_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation per key, through its CSV artifact."""
    path = shared_dir(spark, "per-key-eval")
    rows = metrics.per_key_evaluation(scored(spark, sf_dir), "adep", "score", "label")
    write_csv(rows.withColumns({c: F.round(c, 6) for c in ("actual_rate", "mean_score", "auc")}), path)
    schema = "adep bigint, n bigint, actual_rate double, mean_score double, auc double"
    return spark.read.schema(schema).option("header", True).csv(path)


_FOLD_SCORES = (
    "(SELECT l_linenumber % 3 AS trial, CAST(floor((date_part('year', first_seen) - 1995) / 2) AS BIGINT) AS fold, avg(score) AS val_pr_auc, "
    "count(*) AS best_iteration FROM scored GROUP BY 1, 2) f"
)


@query(
    "fold_summary",
    with_cte(
        "scored",
        "SELECT trial, round(avg(val_pr_auc), 6) AS val_pr_auc_mean, round(stddev_pop(val_pr_auc), 6) AS val_pr_auc_std, "
        f"CAST(round_even(avg(best_iteration), 0) AS BIGINT) AS best_iteration_mean FROM {_FOLD_SCORES} GROUP BY trial",
    ),
)
def fold_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fold means and population deviations per trial."""
    folds = scored(spark, sf_dir).groupBy(
        (F.col("l_linenumber") % 3).alias("trial"), F.floor((F.year("first_seen") - 1995) / 2).alias("fold")
    ).agg(F.avg("score").alias("val_pr_auc"), F.count("*").alias("best_iteration"))
    rows = metrics.fold_summary(folds, ["trial"], ["val_pr_auc"], "best_iteration")
    return rows.withColumns({c: F.round(c, 6) for c in ("val_pr_auc_mean", "val_pr_auc_std")})
