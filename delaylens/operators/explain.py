"""Why a score is what it is: gain importance and additive contributions.

Contributions are exact path-dependent Shapley values. A leaf's share of a
feature's value depends only on which of its path's features the row passes, and
with x as the chance that a feature is known it is an integral,

    value * (passed_i - cover_i) * int_0^1 prod_{j != i} ((1-x) cover_j + x passed_j) dx,

a polynomial in x that a few Gauss nodes integrate exactly. Rows are routed tree by
tree: a table per feature turns its code into the interval between the tree's
splits, the intervals into one number, and each distinct number of a batch is
worked out once for all leaves and handed to its rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from delaylens.operators.boosting import CODES, Booster, Tree
from delaylens.operators.model import FeatureSpec

#: Features of a path up to which a leaf's cases make a table.
TABLE_DEPTH = 10
#: Numbers worked out at once on longer paths: distinct patterns x leaves x places.
AT_ONCE = 1_000_000


def importance(spark: SparkSession, booster: Booster, spec: FeatureSpec) -> DataFrame:
    """Share of the total gain per feature, highest first; unused features
    have 0."""
    gains = np.zeros(len(spec.names))
    for tree in booster.trees:
        inner = tree.feature >= 0
        np.add.at(gains, tree.feature[inner], tree.gain[inner])
    shares = gains / gains.sum() if gains.sum() else gains
    rows = spark.createDataFrame(list(zip(spec.names, shares.tolist())), "feature string, share double")
    return rows.select("feature", F.round("share", 4).alias("importance")).orderBy(F.col("importance").desc(), "feature")


@dataclass
class Paths:
    """A tree by its leaves: value, and for each feature on a leaf's path (padded
    by ones that everything passes) its cover. For each feature of the tree: the
    interval of every code, and which path places pass in each interval."""

    value: np.ndarray
    cover: np.ndarray
    features: list[int]
    interval: list[np.ndarray]
    places: list[tuple[np.ndarray, np.ndarray]]
    passes: list[np.ndarray]

    @property
    def bias(self) -> float:
        return float((self.value * self.cover.prod(axis=1)).sum())


def paths_of(tree: Tree) -> Paths:
    leaves: list[tuple[float, dict[int, tuple[float, np.ndarray]]]] = []
    pending: list[tuple[int, dict[int, tuple[float, np.ndarray]]]] = [(0, {})]
    while pending:
        at, path = pending.pop()
        feature = int(tree.feature[at])
        if feature < 0:
            leaves.append((float(tree.value[at]), path))
            continue
        for child, passing in ((tree.left[at], tree.goes_left[at]), (tree.right[at], ~tree.goes_left[at])):
            cover, codes = path.get(feature, (1.0, np.ones(CODES, bool)))
            share = float(tree.rows[child] / tree.rows[at]) if tree.rows[at] else 0.0
            pending.append((int(child), {**path, feature: (cover * share, codes & passing)}))
    depth = max(len(path) for _, path in leaves)
    cover = np.ones((len(leaves), max(depth, 1)))
    used: dict[int, list[tuple[int, int, np.ndarray]]] = {}
    for i, (_, path) in enumerate(leaves):
        for j, (feature, (share, codes)) in enumerate(path.items()):
            cover[i, j] = share
            used.setdefault(feature, []).append((i, j, codes))
    out = Paths(np.array([v for v, _ in leaves]), cover, sorted(used), [], [], [])
    for feature in out.features:
        at_leaf, at_place, codes = zip(*used[feature])
        kinds, interval = np.unique(np.array(codes).T, axis=0, return_inverse=True)
        out.interval.append(interval.reshape(-1).astype(np.int64))
        out.places.append((np.array(at_leaf), np.array(at_place)))
        out.passes.append(kinds)
    return out


def shares(paths: Paths, passed: np.ndarray) -> np.ndarray:
    """Each path place's contribution, for `passed` (n, leaves or 1, places)."""
    leaves, depth = paths.cover.shape
    nodes, weights = np.polynomial.legendre.leggauss((depth + 1) // 2)
    out = np.zeros((len(passed), leaves, depth))
    for x, weight in zip((nodes + 1) / 2, weights / 2):
        factor = (1 - x) * paths.cover + x * passed
        out += weight * factor.prod(axis=2, keepdims=True) / factor
    return out * (passed - paths.cover) * paths.value[:, None]


def pattern_values(paths: Paths, intervals: list[np.ndarray]) -> np.ndarray:
    """(patterns, features of the tree, then the tree's value) for patterns given
    as intervals of each feature.

    What a leaf contributes depends on which of its path's places pass: on short
    paths it is looked up in a table of all these cases, worked out once."""
    leaves, depth = paths.cover.shape
    n = len(intervals[0]) if intervals else 1
    out = np.zeros((n, len(paths.features) + 1))
    if depth <= TABLE_DEPTH:
        cases = (np.arange(1 << depth)[:, None] >> np.arange(depth) & 1).astype(float)
        table = shares(paths, cases[:, None, :])  # cases x leaves x places
        case = np.full((leaves, n), (1 << depth) - 1, np.int32)
        for interval, (leaf, place), passes in zip(intervals, paths.places, paths.passes):
            case[leaf] -= (~passes.T).astype(np.int32)[:, interval] << place[:, None].astype(np.int32)
        flat = table.transpose(1, 2, 0).reshape(leaves * depth, -1)
        for f, (leaf, place) in enumerate(paths.places):
            out[:, f] = sum(flat[i * depth + j][case[i]] for i, j in zip(leaf, place))
        out[:, -1] = (case == (1 << depth) - 1).T @ paths.value
        return out
    step = max(1, AT_ONCE // (leaves * depth))
    for at in range(0, n, step):
        part = [i[at : at + step] for i in intervals]
        passed = np.ones((len(part[0]) if part else 1, leaves, depth))
        for interval, (leaf, place), passes in zip(part, paths.places, paths.passes):
            passed[:, leaf, place] = passes[interval]
        share = shares(paths, passed)
        for f, (leaf, place) in enumerate(paths.places):
            out[at : at + step, f] = share[:, leaf, place].sum(axis=1)
        out[at : at + step, -1] = passed.prod(axis=2) @ paths.value
    return out


def tree_values(paths: Paths, codes: np.ndarray) -> np.ndarray:
    """The rows' values, each distinct pattern of intervals worked out once."""
    number, size = np.zeros(codes.shape[1], np.int64), 1
    for feature, interval, passes in zip(paths.features, paths.interval, paths.passes):
        number = number * len(passes) + interval[codes[feature]]
        size *= len(passes)
    if size <= 4 * len(number) + 4096:
        present = np.zeros(size, bool)
        present[number] = True
        distinct = np.flatnonzero(present)
        place = np.cumsum(present) - 1
        which = place[number]
    else:
        distinct, which = np.unique(number, return_inverse=True)
    intervals: list[np.ndarray] = []
    for passes in reversed(paths.passes):
        distinct, interval = np.divmod(distinct, len(passes))
        intervals.append(interval)
    return pattern_values(paths, intervals[::-1])[which]


def contributions(trees: list[Paths], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows x features, margin without base) over all trees."""
    total, margin = np.zeros((codes.shape[0], codes.shape[1])), np.zeros(codes.shape[1])
    for paths in trees:
        values = tree_values(paths, codes)
        for f, feature in enumerate(paths.features):
            total[feature] += values[:, f]
        margin += values[:, -1]
    return total.T, margin


def with_contributions(df: DataFrame, booster: Booster, spec: FeatureSpec, trees: list[Paths] | None = None, name: str = "risk_score") -> DataFrame:
    """Adds the score, `contributions` (log-odds per feature, in the order of
    spec.names) and `bias`; together they add up to the log-odds of the score.

    Only feature columns cross to Python, in Arrow batches; no rows move between
    tasks. `trees` are the booster's paths, if they are at hand; their size is that
    of the trees, whatever the data."""
    trees = trees if trees is not None else [paths_of(t) for t in booster.trees]
    bias = booster.base + math.fsum(p.bias for p in trees)
    shared = df.sparkSession.sparkContext.broadcast((booster.bins, booster.base, trees))

    @F.arrow_udf("struct<score:double,contributions:array<double>>")
    def explain(*columns: pa.Array) -> pa.Array:
        bins, base, paths = shared.value
        each, margin = contributions(paths, bins.codes(list(columns)))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(each) + 1) * each.shape[1], pa.int32()), pa.array(each.ravel()))
        return pa.StructArray.from_arrays([pa.array(1 / (1 + np.exp(-base - margin))), lists], ["score", "contributions"])

    found = df.withColumn("__found", explain(*booster.bins.columns()))
    return found.withColumns({name: F.col("__found.score"), "contributions": F.col("__found.contributions"), "bias": F.lit(bias)}).drop("__found")
