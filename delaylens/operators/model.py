"""Delay-risk model: boosted trees on binned rows, walk-forward search, scoring.

Fitting is operators.boosting on blocks written once; scoring and evaluation are
DataFrame jobs. The driver keeps trees and metrics only.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from delaylens.constants import (
    BOOST_ROUNDS,
    CATEGORICAL_COLUMNS,
    EARLY_STOPPING_ROUNDS,
    FEATURE_COLUMNS,
    SEARCH_SPACE,
    TARGET_COLUMN,
)
from delaylens.operators import boosting, metrics
from delaylens.operators.boosting import Bins, Blocks, Booster, Fit, Rules
from delaylens.operators.history import latest_run
from delaylens.session import discard, stage


@dataclass
class FeatureSpec:
    """What the model sees: columns, label and time."""

    numeric: list[str] = field(default_factory=lambda: [c for c in FEATURE_COLUMNS if c not in CATEGORICAL_COLUMNS])
    categorical: list[str] = field(default_factory=lambda: list(CATEGORICAL_COLUMNS))
    label: str = TARGET_COLUMN
    time: str = "first_seen"

    @property
    def names(self) -> list[str]:
        return self.categorical + self.numeric


@dataclass
class TrainedModel:
    booster: Booster
    spec: FeatureSpec
    threshold: float
    config: dict
    rounds: int
    #: long-run delay rate of each airport in the training rows
    rates: dict[str, float] = field(default_factory=dict)
    #: explain.paths_of each tree, worked out at the first use
    paths: list | None = None


def learn_bins(df: DataFrame, spec: FeatureSpec) -> Bins:
    return boosting.learn_bins(df, spec.categorical, spec.numeric)


def binned(df: DataFrame, spec: FeatureSpec, parts: list[Column], bins: Bins | None = None) -> Blocks:
    """The rows as blocks; bit i of a row says whether it is in part i."""
    bits = [F.when(part, F.lit(1 << i)).otherwise(0) for i, part in enumerate(parts)]
    return boosting.write_blocks(df, bins or learn_bins(df, spec), spec.label, sum(bits[1:], bits[0]))


def as_fit(config: dict, train_bit: int, valid_bit: int | None = None) -> Fit:
    rules = Rules(config["num_leaves"], config["learning_rate"], config["min_data_in_leaf"])
    return Fit(rules, config["pos_weight_mult"], train_bit, valid_bit)


def fit(train: DataFrame, spec: FeatureSpec, config: dict, rounds: int = BOOST_ROUNDS, bins: Bins | None = None) -> Booster:
    """Fits a boosted classifier of `rounds` trees with weighted positives."""
    blocks = binned(train, spec, [F.lit(True)], bins)
    booster = boosting.boost(blocks, [as_fit(config, 0)], rounds)[0]
    discard(train.sparkSession, blocks.path)
    return booster


def fit_early_stopping(
    train: DataFrame,
    validation: DataFrame,
    spec: FeatureSpec,
    config: dict,
    rounds: int = BOOST_ROUNDS,
    patience: int = EARLY_STOPPING_ROUNDS,
) -> tuple[Booster, Fit]:
    """Fits until the validation AUC has not risen for `patience` rounds. Returns
    the model of the best round, and the fit with the AUC of every round."""
    columns = [*spec.names, spec.label]
    both = train.select(*columns, F.lit(True).alias("__train")).unionByName(validation.select(*columns, F.lit(False).alias("__train")))
    blocks = binned(both, spec, [F.col("__train"), ~F.col("__train")], learn_bins(train, spec))
    one = as_fit(config, 0, 1)
    booster = boosting.boost(blocks, [one], rounds, patience)[0]
    discard(train.sparkSession, blocks.path)
    return booster, one


def score(booster: Booster, df: DataFrame, spec: FeatureSpec, name: str = "risk_score") -> DataFrame:
    """Adds the probability of a delay. Only feature columns cross to Python."""
    shared = df.sparkSession.sparkContext.broadcast(booster)  # bounded by rounds x leaves

    @F.arrow_udf("double")
    def probability(*columns: pa.Array) -> pa.Array:
        model = shared.value
        return pa.array(1.0 / (1.0 + np.exp(-model.margins(model.bins.codes(list(columns))))))

    return df.withColumn(name, probability(*booster.bins.columns()))


def staged_scores(booster: Booster, df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """The rows' label with the score after each round: (label, round, risk_score).
    One row becomes as many as there are rounds; for checks of a fold."""
    shared = df.sparkSession.sparkContext.broadcast(booster)

    @F.arrow_udf("array<double>")
    def rounds(*columns: pa.Array) -> pa.Array:
        model = shared.value
        codes = model.bins.codes(list(columns))
        margins = np.cumsum([np.full(codes.shape[1], model.base), *(t.value[t.leaf_of(codes)] for t in model.trees)], axis=0)[1:]
        each = 1.0 / (1.0 + np.exp(-margins.T))
        return pa.ListArray.from_arrays(pa.array(np.arange(len(each) + 1) * each.shape[1], pa.int32()), pa.array(each.ravel()))

    scored = df.select(spec.label, F.posexplode(rounds(*booster.bins.columns())).alias("round", "risk_score"))
    return scored.withColumn("round", F.col("round") + 1)


def log_metrics(spark: SparkSession, path: str, run: str, rows: list[tuple[str, int, int, str, float]]) -> None:
    """Appends (name, trial, fold, metric, value) rows of one run to the metric
    table. A handful of numbers per fit."""
    started = int(time.time() * 1000)
    table = spark.createDataFrame(
        [(run, started, *r) for r in rows],
        "run_id string, start_time bigint, run_name string, trial int, fold int, metric string, value double",
    )
    table.coalesce(1).write.mode("append").parquet(path)


def params_path(log_path: str) -> str:
    return f"{log_path.rstrip('/')}.params"


def log_params(spark: SparkSession, log_path: str, run_id: str, run_name: str, params: dict) -> None:
    """Appends the run's settings, as text, to the table beside the metric log."""
    rows = [(run_id, run_name, key, json.dumps(value)) for key, value in sorted(params.items())]
    table = spark.createDataFrame(rows, "run_id string, run_name string, key string, value string")
    table.coalesce(1).write.mode("append").parquet(params_path(log_path))


def save_model(model: TrainedModel, models_path: str, run_id: str) -> str:
    """Writes all that scoring needs below `models_path`/`run_id`."""
    folder = f"{models_path.rstrip('/')}/{run_id}"
    rest = {"spec": asdict(model.spec), "threshold": model.threshold, "config": model.config, "rounds": model.rounds, "rates": model.rates}
    plain = model.booster.plain()
    trees = [(i, json.dumps(t)) for i, t in enumerate(plain.pop("trees"))]
    spark = SparkSession.getActiveSession()
    spark.createDataFrame(trees, "tree int, value string").coalesce(1).write.mode("overwrite").parquet(f"{folder}/trees")
    spark.createDataFrame([(json.dumps({**rest, "booster": plain}),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/rest")
    return folder


def load_model(spark: SparkSession, models_path: str, run_id: str) -> TrainedModel:
    folder = f"{models_path.rstrip('/')}/{run_id}"
    rest = json.loads(spark.read.text(f"{folder}/rest").first()["value"])
    trees = [json.loads(r["value"]) for r in spark.read.parquet(f"{folder}/trees").orderBy("tree").collect()]
    spec, booster = FeatureSpec(**rest.pop("spec")), Booster.of({**rest.pop("booster"), "trees": trees})
    return TrainedModel(booster, spec, **rest)


def search(
    df: DataFrame,
    spec: FeatureSpec,
    folds: list[tuple[str, str]],
    log_path: str,
    configs: list[dict] = SEARCH_SPACE,
    rounds: int = BOOST_ROUNDS,
    patience: int = EARLY_STOPPING_ROUNDS,
    scores_path: str | None = None,
) -> tuple[dict, int]:
    """Walk-forward search: every configuration is fitted before each fold and
    stopped by its AUC there, all of them side by side on one binned table, whose
    edges come from the rows before the last fold's end. Returns the configuration
    with the best mean average precision and its mean best round; all metrics are
    in the log, and each fold's (trial, fold, risk_score, label) rows under
    `scores_path`."""
    spark, run = df.sparkSession, uuid.uuid4().hex[:12]
    parts = [c for start, end in folds for c in (F.col(spec.time) < _at(start), (F.col(spec.time) >= _at(start)) & (F.col(spec.time) < _at(end)))]
    seen = df.where(F.col(spec.time) < _at(max(end for _, end in folds)))
    blocks = binned(seen, spec, parts)
    fits = [as_fit(config, 2 * i, 2 * i + 1) for config in configs for i in range(len(folds))]
    boosters = boosting.boost(blocks, fits, rounds, patience)
    discard(spark, blocks.path)
    scored = None
    for i, (start, end) in enumerate(folds):
        part = seen.where((F.col(spec.time) >= _at(start)) & (F.col(spec.time) < _at(end)))
        names = [f"__s{t}" for t in range(len(configs))]
        for t, name in enumerate(names):
            part = score(boosters[t * len(folds) + i], part, spec, name)
        each = F.inline(F.array(*[F.struct(F.lit(t).alias("trial"), F.col(n).alias("risk_score")) for t, n in enumerate(names)]))
        rows = part.select(F.lit(i).alias("fold"), F.col(spec.label).alias("label"), each)
        scored = rows if scored is None else scored.unionByName(rows)
    scored = scored.select("trial", "fold", "risk_score", "label")
    if scores_path:
        scored.write.mode("append").parquet(scores_path)
        scored = spark.read.parquet(scores_path)
    else:
        scored = stage(scored, "fold-scores")
    rows = []
    for r in metrics.ranking_metrics(scored, "risk_score", "label", ["trial", "fold"]).collect():
        found = {"val_auc": r["auc"], "val_pr_auc": r["average_precision"], "best_iteration": float(fits[r["trial"] * len(folds) + r["fold"]].best_round)}
        rows += [("search", r["trial"], r["fold"], name, value) for name, value in found.items()]
    log_metrics(spark, log_path, run, rows)
    summary = search_summary(spark.read.parquet(log_path).where(F.col("run_id") == run))
    winner = summary.orderBy(F.col("val_pr_auc_mean").desc(), "trial").first()
    chosen = {"trial": winner["trial"], "chosen": configs[winner["trial"]], "configs": configs, "folds": folds, "rounds": rounds, "patience": patience}
    log_params(spark, log_path, run, "search", chosen)
    return configs[winner["trial"]], max(1, winner["best_iteration_mean"])


def _at(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def search_summary(log: DataFrame) -> DataFrame:
    """Mean and deviation per trial from the metric log."""
    wide = log.groupBy("trial", "fold").pivot("metric", ["val_auc", "val_pr_auc", "best_iteration"]).agg(F.first("value"))
    return metrics.fold_summary(wide, ["trial"], ["val_auc", "val_pr_auc"], "best_iteration")


def newest_run(log: DataFrame, name: str = "final_model") -> DataFrame:
    """The newest run of that name in the metric log: run_name, run_id, start_time."""
    return latest_run(log.where(F.col("run_name") == name).select("run_name", "run_id", "start_time"))


def load_newest(spark: SparkSession, log_path: str, models_path: str) -> TrainedModel:
    """The model of the newest final run: what every scoring job starts with."""
    run = newest_run(spark.read.parquet(log_path)).first()
    if run is None:
        raise LookupError(f"no final_model run in {log_path}")
    return load_model(spark, models_path, run["run_id"])


def train_final(
    df: DataFrame, spec: FeatureSpec, folds: list[tuple[str, str]], cutoff: str, config: dict, rounds: int, log_path: str, models_path: str | None = None
) -> tuple[TrainedModel, DataFrame]:
    """Refit on everything before the cutoff, threshold by best F1 on the
    newest fold, one evaluation on the held-out part. Returns the model and
    the scored test rows; metrics and settings go to the log, the model below
    `models_path` under the run's id."""
    train, test = metrics.temporal_split(df, spec.time, cutoff)
    booster = fit(train, spec, config, rounds)
    start, end = folds[-1]
    newest = metrics.temporal_split(metrics.temporal_split(df, spec.time, start)[1], spec.time, end)[0]
    best = metrics.best_f1(score(booster, newest, spec), "risk_score", spec.label).first()
    scored = score(booster, test, spec)
    ranking = metrics.ranking_metrics(scored, "risk_score", spec.label).first()
    counts = metrics.confusion_metrics(scored, "risk_score", spec.label, F.lit(best["threshold"])).first()
    values = {
        "decision_threshold": best["threshold"],
        "num_boost_round": float(rounds),
        "auc": ranking["auc"],
        "pr_auc": ranking["average_precision"],
        **{m: counts[m] for m in ("f1", "precision", "recall")},
    }
    # one row per airport
    rates = {r[0]: r["rate"] for r in train.groupBy("adep").agg(F.avg(F.col(spec.label).cast("double")).alias("rate")).collect() if r[0] is not None}
    model = TrainedModel(booster, spec, best["threshold"], config, rounds, rates)
    run = uuid.uuid4().hex[:12]
    log_metrics(df.sparkSession, log_path, run, [("final_model", -1, -1, m, v) for m, v in values.items()])
    where = save_model(model, models_path, run) if models_path else None
    settings = {**config, "cutoff": cutoff, "folds": folds, "features": spec.names, "model": where}
    log_params(df.sparkSession, log_path, run, "final_model", settings)
    return model, scored
