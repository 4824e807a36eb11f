"""Model queries over the feature table of the flights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from delaylens.constants import SEARCH_SPACE
from delaylens.functions.calendar import holiday_dim, years_of
from delaylens.operators import explain, metrics, model as ml
from delaylens.operators.history import latest_run
from delaylens.operators.joins import entity_context
from delaylens.operators.boosting import SCORE_CELLS
from delaylens.operators.model import FeatureSpec
from delaylens.operators.prefix import running_totals, value_cells
from delaylens.plans.catalog import query
from delaylens.plans.features import build_features
from delaylens.plans.queries_joins import _context, _with_context
from delaylens.plans.scoring import live_features, score_context
from delaylens.plans.testdata import SCOPE, SCOPE_SQL, flights, positions, registry_rows, reports, weather, with_cte
from delaylens.session import shared_dir, stage
from delaylens.sources.files import load_registry

# Folds of four days: the events span one month. All else of the search is the defaults.
FOLDS = [("2024-01-09", "2024-01-13"), ("2024-01-13", "2024-01-17"), ("2024-01-17", "2024-01-21"), ("2024-01-21", "2024-01-25")]
CUTOFF = "2024-01-25"
# of the single fit of early_stop, whose learning rate is six times the default
STOP_ROUNDS, STOP_PATIENCE = 20, 3

_TRAINED: dict[tuple[str, str], tuple[ml.TrainedModel, str, str]] = {}
_SEARCHED: dict[tuple[str, str], tuple[dict, int, str, str]] = {}


def training_rows(spark: SparkSession, sf_dir: str) -> str:
    """The feature table, written once so that every fit reads it."""
    path = shared_dir(spark, "features")
    build_features(flights(spark, sf_dir), weather(spark, sf_dir), reports(spark, sf_dir), SCOPE).write.parquet(path)
    return path


def models_of(log: str) -> str:
    return f"{log}.models"


_FEATURES: dict[tuple[str, str], str] = {}


def feature_rows(spark: SparkSession, sf_dir: str) -> str:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _FEATURES:
        _FEATURES[key] = training_rows(spark, sf_dir)
    return _FEATURES[key]


def searched(spark: SparkSession, sf_dir: str) -> tuple[dict, int, str, str]:
    """The chosen configuration and rounds, the metric log and the fold scores;
    once per application and data set."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SEARCHED:
        log, kept = shared_dir(spark, "search"), shared_dir(spark, "fold-scores")
        rows = spark.read.parquet(feature_rows(spark, sf_dir))
        _SEARCHED[key] = (*ml.search(rows, ml.FeatureSpec(), FOLDS, log, scores_path=kept), log, kept)
    return _SEARCHED[key]


def trained(spark: SparkSession, sf_dir: str) -> tuple[ml.TrainedModel, str, str]:
    """The final model with the searched configuration and rounds, its feature
    table and its metric log; fitted once per application and data set."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TRAINED:
        path, log = feature_rows(spark, sf_dir), shared_dir(spark, "metrics")
        config, rounds, _, _ = searched(spark, sf_dir)
        model, _ = ml.train_final(spark.read.parquet(path), ml.FeatureSpec(), FOLDS, CUTOFF, config, rounds, log, models_of(log))
        _TRAINED[key] = (model, path, log)
    return _TRAINED[key]


def _part_sql(condition: str, columns: str, group: str = "") -> str:
    return with_cte("flights", f"SELECT {columns} FROM flights WHERE adep IN ({SCOPE_SQL}) AND {condition} {group}")


_FOLD_SQL = " UNION ALL ".join(
    f"SELECT {i} AS fold, count(*) AS n FROM flights WHERE adep IN ({SCOPE_SQL}) AND first_seen >= TIMESTAMP '{a}' AND first_seen < TIMESTAMP '{b}'"
    for i, (a, b) in enumerate(FOLDS)
)


@query(
    "cv_metrics",
    with_cte("flights", f"SELECT trial, fold, n, n AS n_scored, TRUE AS auc_agrees, TRUE AS in_summary FROM ({_FOLD_SQL}) f, (VALUES (0), (1), (2), (3)) t(trial)"),
)
def cv_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Walk-forward search: per configuration and fold the scored rows, whether
    the logged AUC is that of pairs counted by rank over the same scores, and
    whether the summary holds the trial's mean."""
    _, _, log, kept = searched(spark, sf_dir)
    scores = spark.read.parquet(kept)
    logged = spark.read.parquet(log).where("metric = 'val_auc'").select("trial", "fold", F.col("value").alias("auc"))
    means = ml.search_summary(spark.read.parquet(log)).select("trial", "val_auc_mean")
    found = scores.groupBy("trial", "fold").agg(F.count("*").alias("n"), F.count_if(F.col("risk_score").between(0, 1)).alias("n_scored"))
    by_rank = rank_auc(scores, ["trial", "fold"], "risk_score", "label")
    joined = found.join(by_rank, ["trial", "fold"]).join(logged, ["trial", "fold"]).join(means, "trial")
    mean = F.avg("auc").over(Window.partitionBy("trial"))
    return joined.select(
        F.col("trial").cast("bigint").alias("trial"),
        F.col("fold").cast("bigint").alias("fold"),
        "n",
        "n_scored",
        (F.abs(F.col("auc") - F.col("rank_auc")) < 1e-9).alias("auc_agrees"),
        (F.abs(F.col("val_auc_mean") - mean) < 1e-9).alias("in_summary"),
    )


def rank_auc(scores: DataFrame, keys: list[str], score: str, label: str) -> DataFrame:
    """AUC from mean ranks (Mann-Whitney), written apart from operators.metrics:
    one row per distinct score, its rank from split running totals."""
    values = stage(scores.groupBy(*keys, score).agg(F.count("*").alias("n"), F.sum(F.col(label).cast("long")).alias("p")), "ranks")
    ranked = running_totals(values, keys, score, ["n"], value_cells(values, score))
    mid = F.col("n_before") + (F.col("n") + 1) / 2
    sums = ranked.groupBy(*keys).agg(F.sum(mid * F.col("p")).alias("r"), F.sum("p").alias("p"), F.sum("n").alias("n"))
    return sums.select(*keys, ((F.col("r") - F.col("p") * (F.col("p") + 1) / 2) / (F.col("p") * (F.col("n") - F.col("p")))).alias("rank_auc"))


@query(
    "train_model",
    "SELECT unnest(['auc', 'decision_threshold', 'f1', 'num_boost_round', 'pr_auc', 'precision', 'recall']) AS metric, TRUE AS agrees",
)
def train_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logged metrics of the final model, each against the same figure worked out
    anew from its scores of the held-out part."""
    model, path, log = trained(spark, sf_dir)
    test = metrics.temporal_split(spark.read.parquet(path), "first_seen", CUTOFF)[1]
    scored = ml.score(model.booster, test, model.spec).select("risk_score", F.col(model.spec.label).alias("label"))
    hit = F.col("risk_score") >= model.threshold
    tp, fp, fn = (F.sum(F.when(c, 1.0).otherwise(0.0)) for c in (hit & (F.col("label") == 1), hit & (F.col("label") == 0), ~hit & (F.col("label") == 1)))
    counts = scored.agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))
    # precision at each distinct score times the recall gained there
    values = stage(scored.groupBy("risk_score").agg(F.count("*").alias("n"), F.sum(F.col("label").cast("long")).alias("p")), "curve")
    down = running_totals(values, [], "risk_score", ["n", "p"], value_cells(values, "risk_score"), descending=True)
    curve = down.select("p", ((F.col("p_before") + F.col("p")) / (F.col("n_before") + F.col("n"))).alias("precision"))
    average = curve.agg((F.sum(F.col("precision") * F.col("p")) / F.sum("p")).alias("pr_auc"))
    area = rank_auc(scored, [], "risk_score", "label").select(F.col("rank_auc").alias("auc"))
    ratio = {
        "precision": F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")),
        "recall": F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")),
        "f1": F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")),
        "auc": F.col("auc"),
        "pr_auc": F.col("pr_auc"),
        "decision_threshold": F.lit(float(model.threshold)),
        "num_boost_round": F.lit(float(model.rounds)),
    }
    pairs = F.explode(F.create_map(*[x for k, v in ratio.items() for x in (F.lit(k), F.coalesce(v, F.lit(0.0)).cast("double"))]))
    anew = counts.crossJoin(average).crossJoin(area).select(pairs.alias("metric", "anew"))  # one row each
    return spark.read.parquet(log).join(anew, "metric", "left").select("metric", (F.abs(F.coalesce("value", F.lit(0.0)) - F.col("anew")) < 1e-9).alias("agrees"))


@query("final_run", "SELECT 'final_model' AS run_name, 7 AS n_metrics, TRUE AS newest")
def final_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest run called final_model in the metric log, and its metrics."""
    _, _, log = trained(spark, sf_dir)
    rows = spark.read.parquet(log)
    run = latest_run(rows.select("run_name", "run_id", "start_time")).where("run_name = 'final_model'")
    newest = F.max(F.col("start_time")).alias("last_start")
    own = rows.join(run.select("run_id", F.col("start_time").alias("found")), "run_id")
    last = rows.where("run_name = 'final_model'").agg(newest)
    counted = own.groupBy("run_name", "found").agg(F.count_distinct("metric").alias("n_metrics"))
    return counted.crossJoin(F.broadcast(last)).select("run_name", "n_metrics", (F.col("found") == F.col("last_start")).alias("newest"))  # one row


@query(
    "early_stop",
    _part_sql(
        f"first_seen >= TIMESTAMP '{FOLDS[0][0]}' AND first_seen < TIMESTAMP '{FOLDS[0][1]}'",
        "adep, count(*) AS n, count(*) AS n_scored, TRUE AS stopped",
        "GROUP BY adep",
    ),
)
def early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the first fold after a fit with early stopping, and whether the
    kept round is the first with the highest AUC: of every number of rounds the
    fold is scored anew, and patience must have run out just then."""
    train = spark.read.parquet(feature_rows(spark, sf_dir))
    start, end = (F.lit(d).cast("timestamp_ntz") for d in FOLDS[0])
    before = train.where(F.col("first_seen") < start)
    fold = train.where((F.col("first_seen") >= start) & (F.col("first_seen") < end))
    spec = ml.FeatureSpec()
    stopped, fit = ml.fit_early_stopping(before, fold, spec, {**SEARCH_SPACE[0], "learning_rate": 0.3}, STOP_ROUNDS, STOP_PATIENCE)
    whole = ml.Booster(stopped.bins, stopped.base, fit.trees)
    each = ml.staged_scores(whole, fold, spec)
    cell = F.least(F.floor(F.col("risk_score") * SCORE_CELLS), F.lit(SCORE_CELLS - 1)).alias("risk_score")
    areas = {r["round"]: r["rank_auc"] for r in rank_auc(each.select("round", cell, F.col(spec.label).alias("label")), ["round"], "risk_score", "label").collect()}
    best = min(areas, key=lambda r: (-round(areas[r], 12), r)) if areas else 0
    ended = len(fit.trees) in (best + STOP_PATIENCE, STOP_ROUNDS)
    kept = F.lit(len(stopped.trees) == best and ended)
    part = ml.score(stopped, fold, spec)
    return part.groupBy("adep").agg(F.count("*").alias("n"), F.count_if(F.col("risk_score").between(0, 1)).alias("n_scored"), F.first(kept).alias("stopped"))


@query(
    "importance",
    "SELECT unnest([" + ", ".join(f"'{n}'" for n in FeatureSpec().names) + "]) AS feature, TRUE AS in_range, TRUE AS adds_up",
)
def importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gain shares of every feature; they add up to one."""
    model, _, _ = trained(spark, sf_dir)
    shares = explain.importance(spark, model.booster, model.spec)
    total = F.sum("importance").over(Window.partitionBy(F.lit(1)))  # one row per feature
    return shares.select("feature", F.col("importance").between(0, 1).alias("in_range"), (F.abs(total - 1) < 2e-3).alias("adds_up"))


@query(
    "attribution_sums",
    with_cte(
        "flights",
        f"SELECT adep, count(*) AS n, count(*) AS n_exact FROM flights WHERE adep IN ({SCOPE_SQL}) GROUP BY adep",
    ),
)
def attribution_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contributions plus bias equal the log-odds of the score, on every row."""
    model, path, _ = trained(spark, sf_dir)
    scored = ml.score(model.booster, spark.read.parquet(path), model.spec)
    rows = explain.with_contributions(scored, model.booster, model.spec, name="again")
    log_odds = F.log(F.col("risk_score") / (1 - F.col("risk_score")))
    total = F.aggregate("contributions", F.col("bias"), lambda a, x: a + x)
    return rows.groupBy("adep").agg(
        F.count("*").alias("n"), F.count_if((F.abs(total - log_odds) < 1e-6) & (F.abs(F.col("again") - F.col("risk_score")) < 1e-12)).alias("n_exact")
    )


# what must hold of a scored row: the band is the score's, and drivers are
# ordered by effect and named for its sign
_BAND = (
    "CASE WHEN risk_score < 0.25 THEN 'low' WHEN risk_score < 0.40 THEN 'medium' ELSE 'high' END = risk_level "
    "or abs(risk_score - 0.25) <= 0.00005 or abs(risk_score - 0.40) <= 0.00005"
)
_ORDERED = (
    "forall(transform(sequence(1, greatest(size(top_factors), 1)), i -> i), "
    "i -> get(top_factors, i) is null or abs(get(top_factors, i - 1).contribution) >= abs(get(top_factors, i).contribution)) "
    "and forall(top_factors, f -> (f.direction = 'increases') = (f.contribution > 0) or f.contribution = 0)"
)
_CHECKS = [
    "coalesce(risk_score between 0 and 1, false) AS in_range",
    f"{_BAND} AS band_agrees",
    f"size(top_factors) <= 3 and {_ORDERED} AS drivers_agree",
]
_HOLD = "TRUE AS in_range, TRUE AS band_agrees, TRUE AS drivers_agree"


@query(
    "score_flights",
    with_cte("flights", f"SELECT adep, count(*) AS n, count(*) AS in_range, count(*) AS band_agrees, count(*) AS drivers_agree FROM flights WHERE adep IN ({SCOPE_SQL}) GROUP BY adep"),
)
def score_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every flight scored, per airport: rows, and those whose score, band and
    drivers fit together."""
    model, path, _ = trained(spark, sf_dir)
    checked = score_context(spark.read.parquet(path), model).selectExpr("adep", *_CHECKS)
    held = [F.count_if(c).alias(c) for c in ("in_range", "band_agrees", "drivers_agree")]
    return checked.groupBy("adep").agg(F.count("*").alias("n"), *held)


@query("stored_model", with_cte("flights", f"SELECT adep, count(*) AS n, count(*) AS n_same, TRUE AS settings_kept FROM flights WHERE adep IN ({SCOPE_SQL}) GROUP BY adep"))
def stored_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every flight scored by the newest stored model as by the one in memory."""
    model, path, log = trained(spark, sf_dir)
    loaded = ml.load_newest(spark, log, models_of(log))
    rows = spark.read.parquet(path)
    both = ml.score(loaded.booster, ml.score(model.booster, rows, model.spec), loaded.spec, "again")
    kept = (loaded.spec, loaded.threshold, loaded.config, loaded.rounds, loaded.rates) == (model.spec, model.threshold, model.config, model.rounds, model.rates)
    return both.groupBy("adep").agg(
        F.count("*").alias("n"), F.count_if(F.col("again") == F.col("risk_score")).alias("n_same"), F.first(F.lit(kept)).alias("settings_kept")
    )


def _live(spark: SparkSession, sf_dir: str, context: DataFrame, rates: dict[str, float]) -> DataFrame:
    rows = flights(spark, sf_dir)
    newest = rows.agg(F.max("first_seen")).scalar()
    return live_features(context.withColumn("at", newest), holiday_dim(years_of(rows, "first_seen")), rates)


@query("score_batch", _with_context(f"SELECT airport, live_traffic_count, {_HOLD} FROM context"))
def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airport-level risk from the merged live context, missing fields and all."""
    model, _, _ = trained(spark, sf_dir)
    scored = score_context(_live(spark, sf_dir, _context(spark, sf_dir), model.rates), model)
    return scored.selectExpr("airport", "live_traffic_count", *_CHECKS)


@query(
    "entity_risk",
    with_cte(
        "airports positions registry_rows registry",
        "SELECT event_id, icao24, CASE WHEN reason IS NULL THEN airport END AS airport, CASE WHEN reason IS NULL THEN typecode END AS typecode, reason, "
        "CASE WHEN reason IS NULL THEN TRUE END AS in_range, CASE WHEN reason IS NULL THEN TRUE END AS band_agrees, "
        "CASE WHEN reason IS NULL THEN TRUE END AS drivers_agree FROM (SELECT p.event_id, p.icao24, n.airport, r.typecode, "
        "CASE WHEN p.lat IS NULL THEN 'no position' WHEN r.icao24 IS NULL THEN 'not in registry' WHEN r.typecode IS NULL THEN 'no aircraft type' END AS reason "
        "FROM positions p LEFT JOIN registry r ON lower(p.icao24) = r.icao24 LEFT JOIN (SELECT event_id, airport, row_number() OVER "
        "(PARTITION BY event_id ORDER BY (lat - site_lat) * (lat - site_lat) + (lon - site_lon) * (lon - site_lon), ordinal) AS rn "
        "FROM positions, airports WHERE lat IS NOT NULL) n ON n.event_id = p.event_id AND n.rn = 1) z",
    ),
)
def entity_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Risk of every scorable aircraft position at its nearest airport, with the
    aircraft's own type; the others keep their reason."""
    model, _, _ = trained(spark, sf_dir)
    registry = load_registry(registry_rows(spark, sf_dir), "p_partkey")
    context = _context(spark, sf_dir)
    found = entity_context(positions(spark, sf_dir), registry, context)
    usable = found.where("reason is null").select("event_id", "icao24", F.col("registry.typecode").alias("typecode"), "context.*")
    scored = score_context(_live(spark, sf_dir, usable, model.rates), model)
    rejected = found.where("reason is not null").select("event_id", "icao24", "reason")
    return scored.selectExpr("event_id", "icao24", "airport", "typecode", *_CHECKS).unionByName(rejected, allowMissingColumns=True)
