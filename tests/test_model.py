"""Boosting against a plain version, attribution against brute force, and loads that can be repeated."""

import itertools
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from delaylens.operators import boosting, explain, model as ml
from delaylens.plans import queries_model
from delaylens.plans.warehouse_load import load_batch, run_batch
from delaylens.session import shared_dir

CONFIG = {"num_leaves": 7, "learning_rate": 0.3, "min_data_in_leaf": 5, "pos_weight_mult": 1.0}
SPEC = ml.FeatureSpec(numeric=["a", "b", "c"], categorical=["adep", "kind"], label="y")


@pytest.fixture(autouse=True, params=[boosting.HELD_CODES, 0], ids=["in_one_task", "by_passes"])
def most_held(request):
    """Each test twice: with a fit's rows in one task, and summed by passes."""
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(boosting, "HELD_CODES", request.param)
        yield request.param


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    n = 500
    values = zip(rng.integers(0, 6, n), rng.integers(0, 3, n), rng.random(n), rng.random(n), rng.integers(0, 4, n))
    made = [
        (i, f"k{k}" if k else None, f"t{t}", None if a < 0.15 else float(a), float(b), float(c), int(a + b + (k in (1, 4)) + 0.3 * rng.normal() > 1.4))
        for i, (k, t, a, b, c) in enumerate(values)
    ]
    return spark.createDataFrame(made, "i long, adep string, kind string, a double, b double, c double, y int").cache()


@pytest.fixture(scope="module")
def fitted(rows):
    return ml.fit(rows, SPEC, CONFIG, rounds=4)


def _halves(g, h, n, left, extra, config, total):
    gl, hl, nl = (x[left].sum() for x in (g, h, n))
    gr, hr, nr = total[0] - gl, total[1] - hl, total[2] - nl
    if min(nl, nr) < config["min_data_in_leaf"] or min(hl, hr) < 1e-3:
        return -math.inf
    return gl * gl / (hl + extra) + gr * gr / (hr + extra) - total[0] ** 2 / total[1]


def _plain_split(codes, g, h, features, config):
    """(gain, feature, set of codes that go left) by trying every split."""
    n, best = np.ones(len(g)), (1e-9, None, None)
    total = (g.sum(), h.sum(), len(g))
    for f in features:
        column, tried = codes[f], []
        seen = sorted(set(column) - {255})
        if f < 2:
            ratio = {c: g[column == c].sum() / (h[column == c].sum() + 10) for c in seen}
            order = sorted(seen, key=lambda c: (ratio[c], c))
            for way in (order, order[::-1]):
                tried += [(_halves(g, h, n, np.isin(column, way[: k + 1]), 10.0, config, total), set(way[: k + 1])) for k in range(min(len(way), 32))]
        else:
            for missing in ({}, {255}) if 255 in column else ({},):
                for cut in range(254):
                    left = {c for c in range(cut + 1)} | set(missing)
                    tried.append((_halves(g, h, n, np.isin(column, list(left)), 0.0, config, total), left))
        for gain, left in tried:
            if gain > best[0] + 1e-9:
                best = (gain, f, left)
    return best


def _plain_boost(codes, ids, label, config, rounds):
    fit = ml.as_fit(config, 0)
    weight = (label == 0).sum() / (label == 1).sum() * config["pos_weight_mult"]
    margin = np.full(len(label), math.log(weight * (label == 1).sum() / (label == 0).sum()))
    for r in range(rounds):
        fit.trees = [None] * r
        features = boosting.chosen_features(len(codes), fit)
        bag = boosting.mixed(ids, r) < 0.8
        g, h = (x / boosting.UNIT for x in boosting.gradients(label, margin, weight))
        leaves = [np.ones(len(label), bool)]
        best = [_plain_split(codes[:, bag], g[bag], h[bag], features, config)]
        while len(leaves) < config["num_leaves"] and max(b[0] for b in best) > 1e-9:
            i = max(range(len(best)), key=lambda j: best[j][0])
            _, f, left = best.pop(i)
            node = leaves.pop(i)
            goes = np.isin(codes[f], list(left))
            if f >= 2 and 255 not in codes[f][node & bag]:  # unseen: with the larger side
                known = codes[f][node & bag]
                goes = goes | ((codes[f] == 255) & (np.isin(known, list(left)).sum() * 2 >= len(known)))
            for side in (node & goes, node & ~goes):
                leaves.append(side)
                part = side & bag
                best.append(_plain_split(codes[:, part], g[part], h[part], features, config))
        for node in leaves:
            margin = margin + np.where(node, -config["learning_rate"] * g[node & bag].sum() / max(h[node & bag].sum(), 1e-3), 0.0)
    return margin


def test_trees_equal_a_plain_version(rows, fitted):
    columns = rows.select(*fitted.bins.columns(), F.xxhash64(*rows.columns), "y").toArrow().combine_chunks()
    *features, ids, label = (columns.column(i).combine_chunks() for i in range(columns.num_columns))
    codes = fitted.bins.codes(features)
    plain = _plain_boost(codes, ids.to_numpy(), label.to_numpy(), CONFIG, 4)
    assert fitted.margins(codes) == pytest.approx(plain, abs=1e-9)
    assert max((t.feature < 0).sum() for t in fitted.trees) == 7


def test_neither_tasks_nor_merging_change_a_tree(rows, fitted, monkeypatch):
    monkeypatch.setattr(boosting, "MERGE_HERE", 0)
    monkeypatch.setattr(boosting, "SNAPSHOT", 2)
    assert ml.fit(rows.repartition(5), SPEC, CONFIG, 4, fitted.bins).plain() == fitted.plain()


def test_fits_side_by_side_stop_at_their_best_round(rows):
    parts = [F.col("i") < 300, F.col("i") >= 300, F.col("i") < 400, F.col("i") >= 400]
    blocks = ml.binned(rows, SPEC, parts)
    other = {**CONFIG, "num_leaves": 3, "learning_rate": 0.9}
    fits = [ml.as_fit(c, t, v) for c in (CONFIG, other) for t, v in ((0, 1), (2, 3))]
    together = boosting.boost(blocks, fits, 12, 3)
    alone = ml.as_fit(other, 2, 3)
    assert boosting.boost(blocks, [alone], 12, 3)[0].plain() == together[3].plain()
    for f, b in zip(fits, together):
        whole = ml.Booster(b.bins, b.base, f.trees)
        valid = rows.where(parts[f.valid_bit])
        scores = ml.staged_scores(whole, valid, SPEC).toPandas()
        areas = []
        for _, part in scores.groupby("round"):
            cell = np.floor(part["risk_score"] * boosting.SCORE_CELLS)
            p, q = cell[part["y"] == 1].to_numpy(), cell[part["y"] == 0].to_numpy()
            areas.append(((p[:, None] > q).sum() + (p[:, None] == q).sum() / 2) / (len(p) * len(q)))
        assert f.aucs == pytest.approx(areas)
        assert len(b.trees) == f.best_round == int(np.argmax(np.round(areas, 12))) + 1
        assert len(f.trees) in (12, f.best_round + 3)


def test_a_task_grows_the_trees_of_the_passes(spark, rows, monkeypatch):
    parts = [F.col("i") < 300, F.col("i") >= 300, F.col("i") < 400, F.col("i") >= 400, F.col("i") < 0]
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 50)
    blocks = ml.binned(rows, SPEC, parts)
    others = [{**CONFIG, "num_leaves": n, "learning_rate": r, "pos_weight_mult": w} for n, r, w in ((3, 0.9, 1.0), (20, 0.1, 0.5))]
    names = [*boosting.READ_BLOCKS, *boosting.TASK_EACH]
    settings = {name: spark.conf.get(name) for name in names}

    def grown(most):
        monkeypatch.setattr(boosting, "HELD_CODES", most)
        fits = [ml.as_fit(c, t, v) for c in (CONFIG, *others) for t, v in ((0, 1), (2, 3), (2, None), (0, 4), (4, 0))]
        boosters = boosting.boost(blocks, fits, 12, 3)
        return [(b.plain(), [t.plain() for t in f.trees], f.aucs, f.stopped, f.done) for f, b in zip(fits, boosters)]

    assert grown(1 << 20) == grown(0)
    assert settings == {name: spark.conf.get(name) for name in names}
    with boosting.few_blocks(spark, boosting.TASK_EACH):
        assert boosting.task_each(blocks, [4, 0, 2]).rdd.getNumPartitions() == 3


def test_one_class_and_empty_tables(rows):
    assert ml.fit(rows.where("y = 1"), SPEC, CONFIG, 3).trees == []
    nothing = ml.fit(rows.limit(0), SPEC, CONFIG, 3)
    assert nothing.trees == [] and ml.score(nothing, rows, SPEC).where("risk_score = 0.5").count() == 500


def _expectation(tree, codes, known):
    """Path-dependent value of a tree when only `known` features are used."""

    def value(i):
        f = tree.feature[i]
        if f < 0:
            return tree.value[i]
        if f in known:
            return value(tree.left[i] if tree.goes_left[i, codes[f]] else tree.right[i])
        l, r = tree.rows[tree.left[i]], tree.rows[tree.right[i]]
        return (l * value(tree.left[i]) + r * value(tree.right[i])) / (l + r)

    return value(0)


def test_contributions_are_shapley_values(rows, fitted):
    some = ml.score(fitted, rows.limit(25), SPEC, "score")
    found = explain.with_contributions(some, fitted, SPEC).select("*", F.array(*fitted.bins.columns()[2:]).alias("n")).collect()
    width = len(SPEC.names)
    import pyarrow as pa

    for row in found:
        codes = fitted.bins.codes([pa.array([row[c]]) for c in SPEC.categorical] + [pa.array([row[c]], pa.float64()) for c in SPEC.numeric])[:, 0]
        expected = [0.0] * width
        for tree, i in itertools.product(fitted.trees, range(width)):
            others = [j for j in range(width) if j != i]
            for s in range(width):
                order = math.factorial(s) * math.factorial(width - s - 1) / math.factorial(width)
                for known in itertools.combinations(others, s):
                    expected[i] += order * (_expectation(tree, codes, {*known, i}) - _expectation(tree, codes, set(known)))
        assert row["contributions"] == pytest.approx(expected, abs=1e-9)
        assert row["risk_score"] == pytest.approx(row["score"], abs=1e-12)
        odds = math.log(row["score"] / (1 - row["score"]))
        assert sum(row["contributions"]) + row["bias"] == pytest.approx(odds, abs=1e-9)


def test_patterns_by_table_and_by_sort_agree(fitted, monkeypatch):
    codes = np.random.default_rng(1).integers(0, 256, (5, 3000)).astype(np.uint8)
    paths = [explain.paths_of(t) for t in fitted.trees]
    whole, margin = explain.contributions(paths, codes)
    monkeypatch.setattr(explain, "TABLE_DEPTH", 0)
    few = [explain.contributions(paths, codes[:, i : i + 1]) for i in range(40)]
    assert whole[:40] == pytest.approx(np.concatenate([c for c, _ in few]), abs=1e-12)
    assert margin == pytest.approx(fitted.margins(codes) - fitted.base, abs=1e-12)


def test_importance_shares_add_up(spark, fitted):
    shares = explain.importance(spark, fitted, SPEC).collect()
    assert {r["feature"] for r in shares} == set(SPEC.names)
    assert sum(r["importance"] for r in shares) == pytest.approx(1.0, abs=1e-3)


def test_unseen_and_missing_values_are_scored(spark, fitted):
    odd = spark.createDataFrame([("new", None, None, None, float("nan")), (None, "t1", 0.5, 0.5, 9e9)], "adep string, kind string, a double, b double, c double")
    assert ml.score(fitted, odd, SPEC).where("risk_score between 0 and 1").count() == 2


def test_a_stored_model_scores_the_same(spark, rows, fitted):
    folder = shared_dir(spark, "models")
    ml.save_model(ml.TrainedModel(fitted, SPEC, 0.5, CONFIG, 4, {"k1": 0.5}), folder, "run")
    loaded = ml.load_model(spark, folder, "run")
    assert loaded.booster.plain() == fitted.plain() and (loaded.spec, loaded.rates) == (SPEC, {"k1": 0.5})


def test_the_search_of_the_queries_is_the_whole_one(spark):
    """All configurations and folds, 500 rounds and a patience of 30: on the smallest
    tables three configurations have fits that are best after the twentieth round."""
    log = queries_model.searched(spark, "/root/testdata/sf0.001")[2]
    params = {r["key"]: json.loads(r["value"]) for r in spark.read.parquet(ml.params_path(log)).collect()}
    assert (params["rounds"], params["patience"]) == (500, 30)
    assert params["configs"] == ml.SEARCH_SPACE and len(params["folds"]) == 4
    best = spark.read.parquet(log).where("metric = 'best_iteration'").groupBy("trial").agg(F.max("value"), F.count("*")).collect()
    assert [r[2] for r in best] == [4] * 4 and sum(r[1] > 20 for r in best) == 3


def test_the_final_model_has_the_rounds_of_the_whole_search(spark):
    """As many trees as the chosen configuration's fits had at their best, on average:
    more than the 20 that a cut search could give."""
    sf_dir = "/root/testdata/sf0.001"
    model, _, log = queries_model.trained(spark, sf_dir)
    searched = spark.read.parquet(queries_model.searched(spark, sf_dir)[2])
    best = searched.where(f"metric = 'best_iteration' AND trial = {ml.SEARCH_SPACE.index(model.config)}").agg(F.avg("value")).first()[0]
    assert len(model.booster.trees) == model.rounds == round(best) > 20
    assert spark.read.parquet(log).where("metric = 'num_boost_round'").first()["value"] == model.rounds


def test_failed_batch_leaves_others_alone(spark):
    target = shared_dir(spark, "load")
    load_batch(spark.range(10), target, "a")
    broken = spark.range(5).select(F.raise_error(F.lit("made failure")).cast("bigint").alias("id"))
    with pytest.raises(Exception):
        run_batch(broken, target, "b")
    load_batch(spark.range(3), target, "a")
    assert spark.read.parquet(f"{target}/rows").count() == 3
    with pytest.raises(Exception):
        run_batch(broken, target, "a")
    assert spark.read.parquet(f"{target}/rows").count() == 3
    log = {(r["batch_id"], r["status"]) for r in spark.read.parquet(f"{target}/log").collect()}
    assert log == {("a", "loaded"), ("b", "failed"), ("a", "failed")}


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def _walked(tree, codes):
    out = []
    for column in codes.T:
        at = 0
        while tree.feature[at] >= 0:
            at = (tree.left if tree.goes_left[at, column[tree.feature[at]]] else tree.right)[at]
        out.append(at)
    return out


@pytest.mark.parametrize("n_leaves", [1, 5, 64, 150])
def test_leaves_by_tables_are_those_of_a_walk(n_leaves):
    rng = np.random.default_rng(n_leaves)
    n = 2 * n_leaves - 1
    tree = boosting.Tree(*(np.full(n, -1, np.int32) for _ in range(3)), rng.random((n, 256)) < 0.5, rng.random(n), np.ones(n), np.zeros(n))
    leaves, free = [0], 1
    while free < n:
        at = leaves.pop(int(rng.integers(len(leaves))))
        tree.feature[at], tree.left[at], tree.right[at] = rng.integers(0, 4), free, free + 1
        leaves += [free, free + 1]
        free += 2
    codes = rng.integers(0, 256, (4, 700)).astype(np.uint8)
    walked = np.array(_walked(tree, codes))
    assert tree.leaf_of(codes).tolist() == walked.tolist()
    asked = np.array(sorted(leaves))[::2]
    found = np.full(codes.shape[1], -1)
    for rows, leaf in boosting.Router(tree, asked).reached(codes):
        found[rows] = leaf
    assert found.tolist() == np.where(np.isin(walked, asked), walked, -1).tolist()


def test_blocks_are_dealt_over_the_cores(spark, monkeypatch):
    """Rows in one partition become work for all cores, and many files no more tasks than these."""
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 50)
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(cores * 400).coalesce(1).selectExpr("CAST(id AS STRING) AS adep", "'x' AS kind", "id / 7 AS a", "1D AS b", "2D AS c", "CAST(id % 2 AS INT) AS y")
    blocks = ml.binned(rows, SPEC, [F.lit(True)])
    held = [r[0] for r in blocks.df.groupBy(F.spark_partition_id()).agg(F.sum(F.length("label"))).collect()]
    assert len(held) == blocks.tasks == cores and max(held) <= 2 * cores * 400 / cores
    many = boosting.Blocks(blocks.df.repartition(cores * 3), blocks.path, blocks.bins)
    assert many.tasks == many.df.rdd.getNumPartitions() == cores


def test_a_pass_holds_few_blocks_and_no_margins_of_a_short_fit(spark, rows, monkeypatch):
    spread = spark.createDataFrame([(i, *row[1:]) for i, row in enumerate(rows.collect() * 3)], rows.schema).coalesce(1)
    settings = {name: spark.conf.get(name) for name in boosting.READ_BLOCKS}
    real = boosting._arrays

    def few(batch):
        assert batch.num_rows <= 2
        yield from real(batch)

    monkeypatch.setattr(boosting, "BLOCK_ROWS", 50)
    blocks = ml.binned(spread, SPEC, [F.lit(True)])
    assert blocks.df.count() > 8 * 2
    monkeypatch.setattr(boosting, "_arrays", few)
    monkeypatch.setattr(boosting, "write_margins", None)
    short = boosting.boost(blocks, [ml.as_fit(CONFIG, 0)], 12)[0]
    monkeypatch.undo()
    monkeypatch.setattr(boosting, "SNAPSHOT", 5)
    assert short.plain() == boosting.boost(blocks, [ml.as_fit(CONFIG, 0)], 12)[0].plain()
    assert settings == {name: spark.conf.get(name) for name in boosting.READ_BLOCKS}
