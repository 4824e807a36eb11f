"""Gradient-boosted trees grown leaf by leaf over a binned column store.

Features become one byte each, once: numbers by quantile edges, categories by
their place in a list, 255 for missing or unseen. The rows are written as blocks,
one matrix of bytes a block, with their label, fold bits and margins. A pass over
the blocks sums gradients and hessians per leaf, feature and code in tasks; sums
of tasks are merged, and only merged histograms (leaves x features x 256, whatever
the data) reach the driver, which picks the splits.

A tree is the best-first tree of its leaf count. A pass expands every leaf that
could still be among the best, so a tree takes about as many passes as it is deep,
not as it has splits; the smaller child is summed, the other is the difference.
Gradients are rounded to a fixed fraction, hence sums, trees and scores depend
neither on the order of tasks nor on how rows are dealt.

Several fits (configurations x folds) share the blocks and every pass: fold
membership is a bit mask, and each fit is at its own place in its own tree. The
validation AUC of a finished tree comes from a score histogram in the pass that
starts the next one, so early stopping costs no pass and no second fit.

Where the rows of every fit have room in a task, there are no passes: a task reads
all blocks, keeps the rows of one fit and grows its trees from the same sums. The
trees are the same, bit by bit.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections import defaultdict
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from delaylens.session import discard, shared_dir

#: Codes of a feature; the last one is a missing or unseen value.
CODES, MISSING = 256, 255
MOST_EDGES = MOST_VALUES = 254
#: Rows of a block, and trees of a fit between two writings of the margins: to walk
#: some fifty trees costs a pass as much as to read all fits' margins.
BLOCK_ROWS, SNAPSHOT = 16_384, 24
#: Blocks that a reader holds at a time, and sends to Python at a time.
READ_BLOCKS = {"spark.sql.parquet.columnarReaderBatchSize": "2", "spark.sql.execution.arrow.maxRecordsPerBatch": "2"}
#: A union of parts of one task each has a task for each, not one for all.
TASK_EACH = {"spark.sql.unionOutputPartitioning": "false"}
#: Rows that are worth a task of their own while there are fewer tasks than cores.
TASK_ROWS = 4_000
#: Rows of a fit that a task gathers before it adds them to its histograms.
GATHERED = 65_536
#: Bytes of codes that a task may hold: 6.7 million rows of 20 features, and about three
#: times as much with their ids, margins and gradients.
HELD_CODES = 1 << 27
#: Rows that a task with all rows of a fit adds to a histogram at a time.
ADDED = 32_768
#: Tasks whose histograms the driver adds up itself; those of more are merged first.
MERGE_HERE = 32
#: Gradients count in units of 2^-20: sums of up to 2^28 rows a task stay exact.
UNIT = float(1 << 20)
#: Cells of predicted probability for the AUC during a fit.
SCORE_CELLS = 1 << 16
#: Categories are ordered by gradient over hessian, damped by SMOOTH, and a split
#: that sends a set of them left is regularised by it as well.
SMOOTH, MOST_IN_SET = 10.0, 32
LEAST_HESSIAN = 1e-3


@dataclass
class Bins:
    """How values become codes: `names` in order, categories first."""

    categorical: list[str]
    numeric: list[str]
    values: list[list[str]]
    edges: list[list[float]]

    @property
    def names(self) -> list[str]:
        return self.categorical + self.numeric

    def columns(self) -> list[Column]:
        return [F.col(c).cast("string") for c in self.categorical] + [F.col(c).cast("double") for c in self.numeric]

    def codes(self, columns: list[pa.Array]) -> np.ndarray:
        """One row of codes per feature."""
        out = np.full((len(self.names), len(columns[0]) if columns else 0), MISSING, np.uint8)
        for row, values, column in zip(out, self.values, columns):
            place = {v: i for i, v in enumerate(values)}
            coded = column.dictionary_encode()
            codes = np.array([place.get(v, MISSING) for v in coded.dictionary.to_pylist()] + [MISSING], np.uint8)
            row[:] = codes[coded.indices.fill_null(len(codes) - 1).to_numpy(zero_copy_only=False)]
        for row, edges, column in zip(out[len(self.values) :], self.edges, columns[len(self.values) :]):
            x = column.to_numpy(zero_copy_only=False).astype(float)
            row[:] = np.where(np.isnan(x), MISSING, np.searchsorted(np.array(edges), x, "left"))
        return out


def learn_bins(df: DataFrame, categorical: list[str], numeric: list[str]) -> Bins:
    """Edges at the quantiles of each number, and the most frequent values of each
    category, ties by name. A value not among them counts as unseen; both lists
    are bounded by the codes."""
    values = []
    for c in categorical:
        counts = df.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("v")).count()
        values.append(sorted(r["v"] for r in counts.orderBy(F.col("count").desc(), "v").limit(MOST_VALUES).collect()))
    at = F.array(*[F.lit(i / (MOST_EDGES - 1)) for i in range(MOST_EDGES)])
    cuts = [F.percentile_approx(F.nanvl(F.col(c).cast("double"), F.lit(None)), at, F.lit(10_000)).alias(f"c{i}") for i, c in enumerate(numeric)]
    found = df.agg(*cuts).first() if numeric else []
    return Bins(categorical, numeric, values, [sorted(set(f or []))[:-1] for f in found])


@dataclass
class Tree:
    """Flat nodes: feature (-1 in a leaf), children, the codes that go left, value,
    rows, and the gain of the split."""

    feature: np.ndarray
    left: np.ndarray
    right: np.ndarray
    goes_left: np.ndarray
    value: np.ndarray
    rows: np.ndarray
    gain: np.ndarray

    def leaf_of(self, codes: np.ndarray) -> np.ndarray:
        """The leaf that each column of codes reaches."""
        if "router" not in self.__dict__:
            self.__dict__["router"] = Router(self, np.flatnonzero(self.feature < 0))
        out = np.zeros(codes.shape[1], np.int32)
        for rows, leaf in self.__dict__["router"].reached(codes):
            out[rows] = leaf
        return out

    def __getstate__(self) -> dict:
        kept = {k: v for k, v in self.__dict__.items() if k != "router"}
        return {**kept, "goes_left": np.packbits(self.goes_left, axis=1)}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ = {**state, "goes_left": np.unpackbits(state["goes_left"], axis=1).astype(bool)}

    def plain(self) -> dict:
        sets = [np.packbits(row).tobytes().hex() for row in self.goes_left]
        return {"goes_left": sets} | {k: getattr(self, k).tolist() for k in ("feature", "left", "right", "value", "rows", "gain")}

    @classmethod
    def of(cls, d: dict) -> Tree:
        sets = np.array([np.unpackbits(np.frombuffer(bytes.fromhex(s), np.uint8)) for s in d["goes_left"]], bool)
        ints, floats = ("feature", "left", "right"), ("value", "rows", "gain")
        return cls(goes_left=sets, **{k: np.array(d[k], np.int32) for k in ints}, **{k: np.array(d[k], float) for k in floats})


class Router:
    """Finds the rows that reach some leaves of a tree without walking it. Leaves
    are bits of a word, up to 64 at a time: a feature's table says of each code
    which of them are still open, and the one bit that all features leave is the
    row's leaf. A row whose leaf is not asked for has no bit left."""

    def __init__(self, tree: Tree, leaves: np.ndarray):
        self.words: list[tuple[np.ndarray, dict[int, np.ndarray]]] = []
        inner, left, right = np.flatnonzero(tree.feature >= 0), tree.left.tolist(), tree.right.tolist()
        for start in range(0, len(leaves), 64):
            part = np.asarray(leaves[start : start + 64], np.int32)
            full = (1 << len(part)) - 1
            kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if full <= np.iinfo(k).max)
            below = [0] * len(tree.feature)
            for bit, leaf in enumerate(part.tolist()):
                below[leaf] = 1 << bit
            for i in inner[::-1].tolist():  # children have higher numbers
                below[i] = below[left[i]] | below[right[i]]
            open_at = np.array(below, kind)
            nodes = inner[open_at[inner] > 0]
            nodes = nodes[np.argsort(tree.feature[nodes], kind="stable")]
            features, first = np.unique(tree.feature[nodes], return_index=True)
            shut = np.array(full, kind) ^ open_at
            kept = np.where(tree.goes_left[nodes], shut[tree.right[nodes]][:, None], shut[tree.left[nodes]][:, None])
            tables = dict(zip(features.tolist(), np.bitwise_and.reduceat(kept, first, axis=0) if len(nodes) else (), strict=True))
            self.words.append((part, tables))
        self.whole = len(leaves) == len(tree.feature) - len(inner)

    def reached(self, codes: np.ndarray) -> Iterator[tuple[np.ndarray | slice, np.ndarray]]:
        """(rows, the leaf of each)."""
        n = codes.shape[1]
        for part, tables in self.words:
            if not tables:
                yield slice(None), np.full(n, part[0], np.int32)
                continue
            open_ = None
            for feature, table in tables.items():
                bits = table.take(codes[feature], mode="clip")
                open_ = bits if open_ is None else np.bitwise_and(open_, bits, out=open_)
            if self.whole and len(self.words) == 1:
                yield slice(None), part.take(np.bitwise_count(open_ - open_.dtype.type(1)), mode="clip")
            else:
                rows = np.flatnonzero(open_)
                bits = open_[rows]
                yield rows, part.take(np.bitwise_count(bits - bits.dtype.type(1)), mode="clip")


@dataclass
class Booster:
    bins: Bins
    base: float
    trees: list[Tree]

    def first(self, rounds: int) -> Booster:
        return Booster(self.bins, self.base, self.trees[:rounds])

    def margins(self, codes: np.ndarray) -> np.ndarray:
        out = np.full(codes.shape[1], self.base)
        for tree in self.trees:
            out += tree.value[tree.leaf_of(codes)]
        return out

    def plain(self) -> dict:
        return {"bins": vars(self.bins), "base": self.base, "trees": [t.plain() for t in self.trees]}

    @classmethod
    def of(cls, d: dict) -> Booster:
        return cls(Bins(**d["bins"]), d["base"], [Tree.of(t) for t in d["trees"]])


# Splits


@dataclass
class Rules:
    num_leaves: int
    learning_rate: float
    min_data_in_leaf: int


@dataclass
class Split:
    gain: float
    feature: int
    goes_left: np.ndarray


def best_split(hist: np.ndarray, features: list[int], n_categorical: int, rules: Rules) -> Split | None:
    """The split with the highest positive gain, ties to the first feature and
    the lowest code. hist: features x codes x (gradient, hessian, rows)."""
    total = hist[0].sum(axis=0)
    parent = float(total[0] ** 2 / max(total[1], 1e-12))
    least = max(rules.min_data_in_leaf, 1)
    if total[2] < 2 * least:
        return None

    def gains(left: np.ndarray, extra: float) -> np.ndarray:
        g, h, n = left[..., 0], left[..., 1], left[..., 2]
        other = total[1] - h
        allowed = (n >= least) & (total[2] - n >= least) & (h >= LEAST_HESSIAN) & (other >= LEAST_HESSIAN)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = g * g / (h + extra) + (total[0] - g) ** 2 / (other + extra) - parent
        return np.where(allowed, gain, -np.inf)

    found: list[tuple[float, int, np.ndarray]] = []
    n_sets = sum(f < n_categorical for f in features)
    for i, feature in enumerate(features[:n_sets]):
        seen = np.flatnonzero(hist[i, :MISSING, 2])
        if len(seen):
            order = seen[np.argsort(hist[i, seen, 0] / (hist[i, seen, 1] + SMOOTH), kind="stable")]
            for codes in (order, order[::-1]):
                gain = gains(np.cumsum(hist[i, codes[:MOST_IN_SET]], axis=0), SMOOTH)
                found.append((float(gain.max()), feature, codes[: int(gain.argmax()) + 1]))
    if n_sets < len(features):
        numbers = hist[n_sets:]
        missing = numbers[:, MISSING]
        upto = np.cumsum(numbers[:, : MISSING - 1], axis=1)
        apart = gains(upto, 0.0)
        joined = np.where(missing[:, 2:] > 0, gains(upto + missing[:, None], 0.0), -np.inf)
        rows, cuts = np.arange(len(numbers)), np.stack([apart.argmax(axis=1), joined.argmax(axis=1)])
        best = np.stack([apart[rows, cuts[0]], joined[rows, cuts[1]]])
        way = best.argmax(axis=0)
        i = int(best.max(axis=0).argmax())
        cut = int(cuts[way[i], i])
        left = np.arange(CODES) <= cut
        left[MISSING] = way[i] == 1 if missing[i, 2] else upto[i, cut, 2] * 2 >= total[2]
        found.append((float(best[way[i], i]), features[n_sets + i], left))
    gain, feature, left = max(found, key=lambda f: f[0], default=(0.0, -1, None))
    if gain <= 1e-9:
        return None
    if feature < n_categorical:
        left = np.isin(np.arange(CODES), left)
    return Split(gain, feature, left)


@dataclass
class Node:
    path: tuple[int, ...]
    hist: np.ndarray | None
    split: Split | None
    sums: np.ndarray
    children: tuple[int, int] | None = None


class Growth:
    """A tree while it grows: nodes that are known, and what is to be summed next."""

    def __init__(self, features: list[int], n_categorical: int, rules: Rules):
        self.features, self.n_categorical, self.rules = features, n_categorical, rules
        self.nodes: list[Node] = []
        #: nodes whose histogram the next pass sums, with (sibling, parent)
        self.wanted: dict[int, tuple[int, int] | None] = {0: None}

    def learn(self, node_path: tuple[int, ...], hist: np.ndarray) -> Node:
        return Node(node_path, hist, best_split(hist, self.features, self.n_categorical, self.rules), hist[0].sum(axis=0))

    def take(self, found: dict[int, np.ndarray]) -> bool:
        """Histograms of the wanted nodes; True when the tree is complete."""
        shape = (len(self.features), CODES, 3)
        for node, relation in self.wanted.items():
            hist = found.get(node)
            hist = np.zeros(shape) if hist is None else hist
            if relation is None:
                self.nodes.append(self.learn((), hist))
                continue
            sibling, parent = relation
            above = self.nodes[parent]
            for n, h in ((node, hist), (sibling, above.hist - hist)):
                self.nodes[n] = self.learn(self.nodes[n].path, h)
            above.hist = None
        self.wanted = {}
        for node in self.chosen()[1]:
            self.expand(node)
        return not self.wanted

    def chosen(self) -> tuple[list[int], list[int]]:
        """Best first: the expanded nodes that are split, and those to expand."""
        heap, split, ahead = [], [], []

        def push(i: int) -> None:
            if self.nodes[i].split is not None:
                heapq.heappush(heap, (-self.nodes[i].split.gain, self.nodes[i].path, i))

        push(0)
        while heap and len(split) + len(ahead) < self.rules.num_leaves - 1:
            i = heapq.heappop(heap)[2]
            if self.nodes[i].children is None:
                ahead.append(i)
            else:
                split.append(i)
                for child in self.nodes[i].children:
                    push(child)
        return split, ahead

    def expand(self, i: int) -> None:
        node = self.nodes[i]
        at = len(self.nodes)
        node.children = (at, at + 1)
        codes = node.hist[self.features.index(node.split.feature)]
        left_rows = codes[node.split.goes_left, 2].sum()
        for side in (0, 1):
            self.nodes.append(Node((*node.path, side), None, None, np.zeros(3)))
        small = 0 if left_rows * 2 <= node.sums[2] else 1
        self.wanted[at + small] = (at + 1 - small, i)

    def packed(self, split: list[int] | None = None) -> tuple[Tree, list[int]]:
        """A tree of the nodes that are split (all expanded ones by default), and
        each of its nodes' places here."""
        inner = {i for i, n in enumerate(self.nodes) if n.children} if split is None else set(split)
        order, place = [0], {0: 0}
        for i in order:
            if i in inner:
                for child in self.nodes[i].children:
                    place[child] = len(order)
                    order.append(child)
        n = len(order)
        tree = Tree(
            np.full(n, -1, np.int32), np.full(n, -1, np.int32), np.full(n, -1, np.int32), np.zeros((n, CODES), bool), np.zeros(n), np.zeros(n), np.zeros(n)
        )
        for at, i in enumerate(order):
            node = self.nodes[i] if self.nodes else Node((), None, None, np.zeros(3))
            g, h, tree.rows[at] = node.sums
            if i in inner:
                tree.feature[at], tree.goes_left[at], tree.gain[at] = node.split.feature, node.split.goes_left, node.split.gain
                tree.left[at], tree.right[at] = (place[c] for c in node.children)
            else:
                tree.value[at] = -self.rules.learning_rate * g / max(h, LEAST_HESSIAN)
        return tree, order

    def tree(self) -> Tree:
        return self.packed(self.chosen()[0])[0]


# Passes over the blocks


@dataclass
class Fit:
    """One configuration on one part of the rows. Bits: of training rows and, for
    early stopping, of validation rows in the blocks' member masks."""

    rules: Rules
    positive_weight_times: float = 1.0
    train_bit: int = 0
    valid_bit: int | None = None
    seed: int = 42
    row_fraction: float = 0.8
    feature_fraction: float = 0.8
    # state
    weight: float = 1.0
    base: float = 0.0
    n_rows: int = 0
    trees: list[Tree] = field(default_factory=list)
    aucs: list[float | None] = field(default_factory=list)
    growth: Growth | None = None
    done: bool = False
    stopped: bool = False

    @property
    def best_round(self) -> int:
        """The first round of the highest AUC, or the last round without any."""
        known = [(-a, i + 1) for i, a in enumerate(self.aucs) if a is not None]
        return min(known)[1] if known else len(self.trees)


@dataclass
class Work:
    """What a pass does for one fit."""

    fit: int
    train_bit: int
    valid_bit: int | None
    round: int
    weight: float
    row_fraction: float
    recent: list[Tree]
    partial: Tree | None
    slots: np.ndarray | None
    features: list[int]
    auc: bool


BLOCKS = "ids binary, label binary, member binary, codes binary, margins binary"


@dataclass
class Blocks:
    """The written column store, and how many trees of each fit its margins hold. It
    is read by one task a core: each more sends histograms of its own."""

    df: DataFrame
    path: str
    bins: Bins
    held: list[int] = field(default_factory=list)
    tasks: int = 0

    def __post_init__(self):
        cores, files = self.df.sparkSession.sparkContext.defaultParallelism, self.df.rdd.getNumPartitions()
        self.tasks = min(files, cores)
        if files > cores:
            self.df = self.df.coalesce(cores)


@contextmanager
def few_blocks(spark: SparkSession, more: dict[str, str] = {}) -> Iterator[None]:
    """For jobs over blocks. A row of theirs is megabytes long, so Spark's thousands
    of rows a batch would be a task's whole part, held several times over."""
    settings = READ_BLOCKS | more
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def write_blocks(df: DataFrame, bins: Bins, label: str, member: Column) -> Blocks:
    """Writes the rows with a label as blocks; `member` is a long of fold bits. A
    row is sampled by a hash of all its columns: equal rows go together."""
    features = [c.alias(f"f{i}") for i, c in enumerate(bins.columns())]
    rows = df.where(F.col(label).isNotNull()).select(*features, F.col(label).cast("byte").alias("y"), member.cast("long").alias("m"), F.xxhash64(*df.columns).alias("id"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []

        def block() -> pa.RecordBatch:
            codes, label, member, ids = (np.concatenate(p, axis=-1) for p in zip(*parts))
            return _block(ids, label, member, codes, np.zeros(0))

        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                *features, y, m, row = batch.slice(start, BLOCK_ROWS).columns
                whole = [c.to_numpy(zero_copy_only=False).astype(t) for c, t in ((y, np.int8), (m, np.int64), (row, np.int64))]
                parts.append((bins.codes(features), *whole))
                if sum(len(p[1]) for p in parts) >= BLOCK_ROWS:
                    yield block()
                    parts.clear()
        if parts:
            yield block()

    spark = df.sparkSession
    path = shared_dir(spark, "blocks")
    cores = spark.sparkContext.defaultParallelism
    if (count := rows.count()) < cores * BLOCK_ROWS:  # few rows lie in few files
        rows = rows.repartition(max(1, min(cores, count // TASK_ROWS)))
    made = rows.mapInArrow(work, BLOCKS)
    if count >= cores * BLOCK_ROWS:  # whole blocks move, one row each
        made = made.repartition(cores)
    made.write.parquet(path)
    return Blocks(spark.read.parquet(path), path, bins)


def _block(ids: np.ndarray, label: np.ndarray, member: np.ndarray, codes: np.ndarray, margins: np.ndarray) -> pa.RecordBatch:
    cells = [pa.array([np.ascontiguousarray(a).tobytes()], pa.binary()) for a in (ids, label, member, codes, margins)]
    return pa.RecordBatch.from_arrays(cells, ["ids", "label", "member", "codes", "margins"])


def _arrays(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    for cells in zip(*batch.select(["ids", "label", "member", "codes", "margins"]).columns, strict=True):
        kinds = (np.int64, np.int8, np.int64, np.uint8, float)
        ids, label, member, codes, margins = (np.frombuffer(cell.as_buffer(), kind) for cell, kind in zip(cells, kinds, strict=True))
        yield ids, label, member, codes.reshape(-1, len(ids)), margins.reshape(-1, len(ids))


def mixed(ids: np.ndarray, salt: int) -> np.ndarray:
    """A number in [0, 1) of each id, by salt."""
    with np.errstate(over="ignore"):
        x = ids.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) & (2**64 - 1))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(float) / float(1 << 53)


def gradients(label: np.ndarray, margin: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Of the log-loss, in whole units."""
    p = 1.0 / (1.0 + np.exp(-margin))
    w = np.where(label == 1, weight, 1.0)
    return np.rint(w * (p - label) * UNIT), np.rint(w * p * (1.0 - p) * UNIT)


def score_cells(label: np.ndarray, margin: np.ndarray) -> np.ndarray:
    """(negatives, positives) by score cell, one after the other."""
    cell = np.minimum((SCORE_CELLS / (1.0 + np.exp(-margin))).astype(np.int64), SCORE_CELLS - 1)
    return np.bincount(cell * 2 + (label == 1), minlength=2 * SCORE_CELLS)


class Sums:
    """A task's sums of all its blocks."""

    def __init__(self, works: list[Work], bases: list[float]):
        self.works, self.bases = works, bases
        self.hist: dict[tuple[int, int], np.ndarray] = {}
        self.cells: dict[int, np.ndarray] = {}
        #: the rows of each fit that are not in its histograms yet: slot, codes, gradient, hessian
        self.gathered: dict[int, list[tuple[np.ndarray, ...]]] = defaultdict(list)
        self.routers = [w.partial and Router(w.partial, np.flatnonzero(w.slots >= 0)) for w in works]

    def add(self, ids: np.ndarray, label: np.ndarray, member: np.ndarray, codes: np.ndarray, margins: np.ndarray) -> None:
        """A block's rows. Only those in a leaf that is summed are worked out any
        further; fits of one round on the same rows share what they sample."""
        sampled: dict[tuple[int, int, float], tuple[np.ndarray, np.ndarray]] = {}
        drawn: dict[int, np.ndarray] = {}
        for w, router in zip(self.works, self.routers):
            if w.auc:
                rows = np.flatnonzero(member >> w.valid_bit & 1)
                margin = self.margin(w, margins, rows, codes[:, rows])
                self.cells[w.fit] = self.cells.get(w.fit, 0) + score_cells(label[rows], margin)
            if router is None:
                continue
            key = (w.train_bit, w.round, w.row_fraction)
            if key not in sampled:
                if w.round not in drawn:
                    drawn[w.round] = mixed(ids, w.round)
                rows = np.flatnonzero((member >> w.train_bit & 1).astype(bool) & (drawn[w.round] < w.row_fraction))
                sampled[key] = rows, codes[:, rows]
            rows, part = sampled[key]
            for at, leaf in router.reached(part):
                own = part if isinstance(at, slice) else part[:, at]
                if own.shape[1]:
                    g, h = gradients(label[rows[at]], self.margin(w, margins, rows[at], own), w.weight)
                    self.gathered[w.fit].append((w.slots[leaf], own, g, h))
            if sum(len(p[0]) for p in self.gathered[w.fit]) >= GATHERED:
                self.flush(w)

    def margin(self, w: Work, margins: np.ndarray, rows: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Of the rows, whose codes are given: what the block holds and the trees since."""
        out = margins[w.fit, rows] if len(margins) else np.full(len(rows), self.bases[w.fit])
        for tree in w.recent:
            out += tree.value[tree.leaf_of(codes)]
        return out

    def flush(self, w: Work) -> None:
        if not (parts := self.gathered.pop(w.fit, None)):
            return
        slot, codes, g, h = (np.concatenate(p, axis=-1) for p in zip(*parts))
        first, n_slots = slot.astype(np.intp) * CODES, int(w.slots.max()) + 1
        for i, feature in enumerate(w.features):
            hist = self.hist.setdefault((w.fit, i), np.zeros((3, n_slots * CODES)))
            key = first + codes[feature]
            for sums, x in zip(hist, (g, h, None)):
                sums += np.bincount(key, weights=x, minlength=n_slots * CODES)

    def rows(self) -> Iterator[tuple[int, int, bytes, bytes]]:
        """Only cells that rows fell into: small leaves fill few."""
        for w in self.works:
            self.flush(w)
        for (fit, i), hist in self.hist.items():
            yield fit, i, *_filled(hist.T)
        for fit, cells in self.cells.items():
            yield fit, -1, *_filled(cells.reshape(-1, 1).astype(float))


def _filled(cells: np.ndarray) -> tuple[bytes, bytes]:
    at = np.flatnonzero(cells[:, -1])
    return at.astype(np.int32).tobytes(), cells[at].tobytes()


SUMS = "fit int, what int, at binary, data binary"


def _sums_batch(rows: list[tuple[int, int, bytes, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), (), ()]
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["fit", "what", "at", "data"])


def _summed(parts: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Filled cells and their sums. A part names each of its cells once, in order."""
    read = [(np.frombuffer(a, np.int32), d) for a, d in parts if a]
    if not read:
        return np.zeros(0, np.int32), np.zeros((0, 1))
    each = [(at, np.frombuffer(d).reshape(len(at), -1)) for at, d in read]
    sums = np.zeros((max(int(at[-1]) for at, _ in each) + 1, each[0][1].shape[1]))
    for at, data in each:
        sums[at] += data
    cells = np.flatnonzero(sums[:, -1])
    return cells.astype(np.int32), sums[cells]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up what has one key; keys are dealt to tasks."""
    parts: dict[tuple[int, int], list[tuple[bytes, bytes]]] = defaultdict(list)
    for batch in batches:
        for r in batch.to_pylist():
            key = (r["fit"], r["what"])
            parts[key].append((r["at"], r["data"]))
            if len(parts[key]) == MERGE_HERE:
                at, data = _summed(parts[key])
                parts[key] = [(at.tobytes(), data.tobytes())]
    rows = []
    for key, several in parts.items():
        at, data = _summed(several)
        rows.append((*key, at.tobytes(), data.tobytes()))
    yield _sums_batch(rows)


def sum_pass(blocks: Blocks, works: list[Work], bases: list[float]) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """The merged sums of one pass, filled cells only, by (fit, feature place or
    -1 for scores)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(works, bases)
        for batch in batches:
            for block in _arrays(batch):
                sums.add(*block)
        yield _sums_batch(list(sums.rows()))

    found = blocks.df.mapInArrow(work, SUMS)
    if blocks.tasks > MERGE_HERE:
        found = found.repartition(min(blocks.tasks, 200), "fit", "what").mapInArrow(_merge, SUMS)
    parts: dict[tuple[int, int], list[tuple[bytes, bytes]]] = defaultdict(list)
    with few_blocks(blocks.df.sparkSession):
        rows = found.collect()
    for r in rows:
        parts[r["fit"], r["what"]].append((bytes(r["at"]), bytes(r["data"])))
    return {key: _summed(several) for key, several in parts.items()}


def write_margins(blocks: Blocks, fits: list[Fit], first: Blocks) -> Blocks:
    """The blocks with the margins of all finished trees, of the rows that a fit
    learns from or is stopped by; the earlier writing goes, unless it is `first`."""
    held, bases = blocks.held or [0] * len(fits), [f.base for f in fits]
    recent = [(f.train_bit, f.valid_bit, f.trees[h:]) for f, h in zip(fits, held)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, label, member, codes, margins in _arrays(batch):
                now = margins.copy() if len(margins) else np.repeat(np.array(bases)[:, None], len(ids), axis=1)
                kept: dict[tuple[int, int | None], tuple[np.ndarray, np.ndarray]] = {}
                for i, (train, valid, trees) in enumerate(recent):
                    if (train, valid) not in kept:
                        rows = np.flatnonzero(member & (1 << train | (0 if valid is None else 1 << valid)))
                        kept[train, valid] = rows, codes[:, rows]
                    rows, part = kept[train, valid]
                    for tree in trees:
                        now[i, rows] += tree.value[tree.leaf_of(part)]
                yield _block(ids, label, member, codes, now)

    spark = blocks.df.sparkSession
    path = shared_dir(spark, "blocks")
    with few_blocks(spark):
        blocks.df.mapInArrow(work, BLOCKS).write.parquet(path)
    if blocks.path != first.path:
        discard(spark, blocks.path)
    return Blocks(spark.read.parquet(path), path, blocks.bins, [len(f.trees) for f in fits])


def class_counts(blocks: Blocks, bits: set[int]) -> dict[int, tuple[int, int]]:
    """(negatives, positives) of each bit's rows."""
    listed = sorted(bits)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(listed), 2))
        for batch in batches:
            for _, label, member, _, _ in _arrays(batch):
                for i, bit in enumerate(listed):
                    total[i] += np.bincount(label[(member >> bit & 1).astype(bool)] == 1, minlength=2)
        yield _sums_batch([(i, 0, *_filled(row.reshape(-1, 1))) for i, row in enumerate(total)])

    counts: dict[int, np.ndarray] = defaultdict(lambda: np.zeros(2))
    with few_blocks(blocks.df.sparkSession):
        rows = blocks.df.mapInArrow(work, SUMS).repartition(1).mapInArrow(_merge, SUMS).collect()
    for r in rows:
        counts[listed[r["fit"]]][np.frombuffer(r["at"], np.int32)] = np.frombuffer(r["data"])
    return {bit: (int(counts[bit][0]), int(counts[bit][1])) for bit in listed}


def area(cells: np.ndarray) -> float | None:
    """AUC of (negatives, positives) by score cell, ties count half."""
    q, p = cells.reshape(-1, 2).T
    if not p.sum() or not q.sum():
        return None
    below = np.cumsum(q) - q
    return float((p * (below + q / 2)).sum() / (p.sum() * q.sum()))


def chosen_features(n: int, fit: Fit) -> list[int]:
    """The features that the next tree may use."""
    order = np.argsort(mixed(np.arange(n), fit.seed * 1_000_003 + len(fit.trees)))
    return sorted(order[: max(1, math.ceil(n * fit.feature_fraction))].tolist())


class Held:
    """All rows that one fit learns from or is stopped by, in one task, with the
    margins of the trees so far."""

    def __init__(self, fit: Fit, n_categorical: int):
        self.fit, self.n_categorical = fit, n_categorical
        self.parts: list[tuple[np.ndarray, ...]] = []

    def add(self, ids: np.ndarray, label: np.ndarray, member: np.ndarray, codes: np.ndarray) -> None:
        train, valid = (np.zeros(len(ids), bool) if bit is None else (member >> bit & 1).astype(bool) for bit in (self.fit.train_bit, self.fit.valid_bit))
        rows = np.flatnonzero(train | valid)
        self.parts.append((ids[rows], label[rows], train[rows], valid[rows], codes[:, rows]))

    def grow(self, rounds: int, patience: int | None) -> None:
        """All trees of the fit, as the passes would."""
        f = self.fit
        ids, label, train, valid = (np.concatenate(p) for p in zip(*(part[:4] for part in self.parts)))
        codes = np.empty((len(self.parts[0][4]), len(ids)), np.uint8)
        at = 0
        for *_, part in self.parts:
            codes[:, at : at + part.shape[1]] = part
            at += part.shape[1]
        self.parts.clear()
        learnt, judged = np.flatnonzero(train), np.flatnonzero(valid)
        margin = np.full(len(ids), f.base)
        while not f.done:
            drawn = learnt[mixed(ids[learnt], len(f.trees)) < f.row_fraction].astype(np.int32)
            tree = self.tree(codes, drawn, label, margin)
            f.trees.append(tree)
            for start in range(0, len(ids), GATHERED):
                margin[start : start + GATHERED] += tree.value[tree.leaf_of(codes[:, start : start + GATHERED])]
            if f.valid_bit is not None:
                f.aucs.append(area(score_cells(label[judged], margin[judged])))
                f.stopped = patience is not None and len(f.aucs) - f.best_round >= patience
            f.done = f.stopped or len(f.trees) == rounds

    def tree(self, codes: np.ndarray, drawn: np.ndarray, label: np.ndarray, margin: np.ndarray) -> Tree:
        g, h = np.zeros(len(label)), np.zeros(len(label))
        for start in range(0, len(drawn), GATHERED):
            rows = drawn[start : start + GATHERED]
            g[rows], h[rows] = gradients(label[rows], margin[rows], self.fit.weight)
        growth = Growth(chosen_features(len(codes), self.fit), self.n_categorical, self.fit.rules)
        rows_of = {0: drawn}
        complete = False
        while not complete:
            found = {}
            for node, relation in growth.wanted.items():
                if relation is not None:
                    parent = relation[1]
                    rows, split = rows_of.pop(parent), growth.nodes[parent].split
                    goes = split.goes_left[codes[split.feature].take(rows)]
                    rows_of |= zip(growth.nodes[parent].children, (rows[goes], rows[~goes]))
                found[node] = node_sums(codes, growth.features, rows_of[node], g, h)
            complete = growth.take(found)
        return growth.tree()


def node_sums(codes: np.ndarray, features: list[int], rows: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Features x codes x (gradient, hessian, rows) of some rows."""
    sums = np.zeros((len(features), 3, CODES))
    for start in range(0, len(rows), ADDED):
        some = rows[start : start + ADDED]
        weights = g.take(some), h.take(some), None
        for hist, feature in zip(sums, features):
            key = codes[feature].take(some).astype(np.intp)
            for cells, x in zip(hist, weights):
                cells += np.bincount(key, weights=x, minlength=CODES)
    return sums.transpose(0, 2, 1) / np.array([UNIT, UNIT, 1.0])


def task_each(blocks: Blocks, fits: list[int]) -> DataFrame:
    """All blocks for each of the fits, read by one task each under TASK_EACH."""
    return reduce(DataFrame.union, [blocks.df.coalesce(1).withColumn("fit", F.lit(i)) for i in fits])


def boost_held(blocks: Blocks, fits: list[Fit], rounds: int, patience: int | None) -> None:
    """Grows each fit in a task of its own, which reads all blocks; those with the most
    rows and leaves first."""
    n_categorical, states = len(blocks.bins.categorical), dict(enumerate(fits))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks_of = ((i, block) for batch in batches for i, block in zip(batch.column("fit").to_pylist(), _arrays(batch), strict=True))
        for i, own in groupby(blocks_of, key=lambda b: b[0]):
            held = Held(states[i], n_categorical)
            for _, (ids, label, member, codes, _) in own:
                held.add(ids, label, member, codes)
            held.grow(rounds, patience)
            grown = pickle.dumps((held.fit.trees, held.fit.aucs, held.fit.stopped))
            del held
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([grown], pa.binary())], ["fit", "grown"])

    order = sorted((i for i, f in states.items() if not f.done), key=lambda i: (-fits[i].n_rows, -fits[i].rules.num_leaves, i))
    with few_blocks(blocks.df.sparkSession, TASK_EACH):
        found = task_each(blocks, order).mapInArrow(work, "fit int, grown binary").collect()
    for r in found:
        f = fits[r["fit"]]
        f.trees, f.aucs, f.stopped = pickle.loads(r["grown"])
        f.done = True


def boost(blocks: Blocks, fits: list[Fit], rounds: int, patience: int | None = None, progress: Callable[[list[Fit]], None] | None = None) -> list[Booster]:
    """Grows all fits side by side, up to `rounds` trees each. A fit with
    validation rows stops when its AUC has not risen for `patience` rounds and
    keeps the trees up to its best round; a fit without a row of either class has
    no trees. The blocks given stay; margins are written and cleared beside them."""
    counts = class_counts(blocks, {bit for f in fits for bit in (f.train_bit, f.valid_bit) if bit is not None})
    for f in fits:
        negatives, positives = counts[f.train_bit]
        f.n_rows = negatives + positives + (0 if f.valid_bit is None else sum(counts[f.valid_bit]))
        f.done = not (negatives and positives) or rounds < 1
        if negatives and positives:
            f.weight = negatives / positives * f.positive_weight_times
            f.base = math.log(f.weight * positives / negatives)
    names, n_categorical = blocks.bins.names, len(blocks.bins.categorical)
    if not all(f.done for f in fits) and max(f.n_rows for f in fits) * len(names) <= HELD_CODES:
        boost_held(blocks, fits, rounds, patience)
    # a block without margins stands for those before the first tree
    work_blocks, bases = Blocks(blocks.df, blocks.path, blocks.bins, [0] * len(fits)), [f.base for f in fits]
    while not all(f.done for f in fits):
        if max(len(f.trees) - h for f, h in zip(fits, work_blocks.held) if not f.done) >= SNAPSHOT:
            work_blocks = write_margins(work_blocks, fits, blocks)
        works = []
        for i, f in enumerate(fits):
            if f.done:
                continue
            ended = len(f.trees) == rounds
            if f.growth is None and not ended:
                f.growth = Growth(chosen_features(len(names), f), n_categorical, f.rules)
            starts = ended or not f.growth.nodes
            auc = f.valid_bit is not None and starts and len(f.trees) > len(f.aucs)
            partial, slots = None, None
            if not ended:
                partial, order = f.growth.packed()
                slots = np.full(len(order), -1, np.int64)
                for s, node in enumerate(f.growth.wanted):
                    slots[order.index(node)] = s
            features = f.growth.features if f.growth else []
            recent = f.trees[work_blocks.held[i] :]
            works.append(Work(i, f.train_bit, f.valid_bit, len(f.trees), f.weight, f.row_fraction, recent, partial, slots, features, auc))
        found = sum_pass(work_blocks, works, bases)
        for w in works:
            f = fits[w.fit]
            if w.auc:
                f.aucs.append(area(_cells(found.get((w.fit, -1)), 2 * SCORE_CELLS, 1)))
                f.stopped = patience is not None and len(f.aucs) - f.best_round >= patience
            if w.partial is None or f.stopped:
                f.done = True
                continue
            n = len(f.growth.wanted)
            each = [_cells(found.get((w.fit, j)), n * CODES, 3).reshape(n, CODES, 3) for j in range(len(w.features))]
            hists = dict(zip(f.growth.wanted, np.stack(each, axis=1) / np.array([UNIT, UNIT, 1.0])))
            if f.growth.take(hists):
                f.trees.append(f.growth.tree())
                f.growth = None
                f.done = len(f.trees) == rounds and f.valid_bit is None
        if progress:
            progress(fits)
    if work_blocks.path != blocks.path:
        discard(blocks.df.sparkSession, work_blocks.path)
    return [Booster(blocks.bins, f.base, f.trees[: f.best_round] if f.valid_bit is not None else f.trees) for f in fits]


def _cells(found: tuple[np.ndarray, np.ndarray] | None, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, width))
    if found is not None:
        out[found[0]] = found[1]
    return out
