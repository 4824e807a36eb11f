"""Scoring texts with a log-bilinear language model.

Words have places: each frequent word its own, rarer ones share slots by a hash of
the word, more of them as the vocabulary grows. Places belong to classes: half the
classes are single words, the others hold places of equal shares of the tokens, and
there are about as many classes as the square root of the distinct words. A word's
probability is that of its class after the two classes before it, times that of its
place within the class in the same context, times a rare word's smoothed share of
its slot.

Both models are log-bilinear and learn by noise-contrastive estimation from every
training text. The classes' vectors, each through its own matrix, give a vector
whose products with the classes' vectors are the scores: in each epoch tasks take
the steps over their own texts in numpy, and their parameters are averaged by their
tokens for the next one. Then tokens are shuffled by class, and a task learns its
classes' places one class after another, from the vectors that the first model gives
the contexts. As contexts are pairs of classes, the normalisers of all contexts are
computed once, by matrix products in tasks, and a token's log-probability is a few
products less its contexts' normalisers.

Counts are taken over all training texts. The most frequent words' counts and
vectors go to every task (bounded); the other words' counts are joined by word, and
their sums by row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from math import isqrt
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylens.llm.common import lean, most_frequent, schema_with, text_batches
from delaylens.session import stage

#: Classes, at least and at most (grown_classes); the vectors' length.
CLASSES, MOST_CLASSES = 1000, 2000
DIMENSIONS = 16
EPOCHS = 3
#: Slots of rare words, at most, and rare words that make one more.
SLOTS, SLOT_WORDS = 16_384, 8
#: Tokens that make a task of their own in training, and that it takes at once.
TASK_TOKENS = 1_000_000
CHUNK_TOKENS = 500_000
#: Tokens of a step: a share of all, within these.
STEP_SHARE, STEP_TOKENS = 4000, (512, 2048)
NOISE = 32
#: Within classes: passes over a chunk, tokens of a step, noise places, step size.
INSIDE_EPOCHS, INSIDE_STEP, INSIDE_NOISE, INSIDE_RATE = 2, 1024, 64, 0.05
#: The longest step of a place: a rare one that is drawn as noise is hit by a
#: whole step's tokens at once.
INSIDE_REACH = 0.5
#: Products (near class, far class, class) of a task that computes normalisers.
TASK_PRODUCTS = 1_000_000_000
#: Words whose counts every task gets.
SHARED_WORDS = 200_000
#: Tokens that a task sums up before it passes their counts on.
COUNTED_TOKENS = 2_000_000
END = b""


def tokens(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, then the end."""
    return [*(text or "").encode("utf-8", "surrogatepass").lower().split(), END]


def token_arrays(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """tokens() of many texts one after another, and how many each has."""
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    # what is split off behind a last space is the end, as is an empty text
    closed = pc.if_else(pc.equal(pc.binary_length(trimmed), 0), trimmed, pc.binary_join_element_wise(trimmed, "", " "))
    split = pc.ascii_split_whitespace(closed)
    return split.flatten().cast(pa.binary()), np.diff(split.offsets.to_numpy())


def token_counts(df: DataFrame, text: str) -> DataFrame:
    """(word, n) over all rows."""

    def sums(found: list[pa.Array]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(pc.value_counts(pa.chunked_array(found, pa.binary())).flatten(), ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[pa.Array] = []
        for batch in batches:
            found.append(token_arrays(batch.column(0))[0])
            if sum(map(len, found)) >= COUNTED_TOKENS:
                yield sums(found)
                found = []
        yield sums(found)

    return text_batches(df).select(F.col(text).alias("text")).mapInArrow(lean(count), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class LogBilinear:
    """Classes 0 .. n - 1 are words, n all other words, n + 1 the start (only
    as context). near and far: the class vectors through the two matrices."""

    near: np.ndarray
    far: np.ndarray
    vectors: np.ndarray
    bias: np.ndarray
    normaliser: np.ndarray

    def log_probability(self, far: np.ndarray, near: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Natural log of P(word | far, near), elementwise."""
        context = self.near.take(near, axis=0)
        context += self.far.take(far, axis=0)
        score = np.einsum("ij,ij->i", context, self.vectors.take(word, axis=0)) + self.bias.take(word)
        return score - self.normaliser.take(near.astype(np.int64) * len(self.near) + far)


def contexts(classes: np.ndarray, starts: np.ndarray, start_class: int) -> tuple[np.ndarray, np.ndarray]:
    """The classes two and one before each token; the start before a text's first."""
    near = np.concatenate([[start_class], classes[:-1]]) if len(classes) else classes
    near[starts] = start_class
    far = np.concatenate([[start_class], near[:-1]]) if len(classes) else classes
    far[starts] = start_class
    return far, near


class Learner:
    """Parameters (class vectors, the last one the start's; the two matrices;
    biases) that learn by noise-contrastive estimation: tell each token from
    NOISE draws of the unigram distribution (shared by a step), by Adam.
    `unigram`: the smoothed probability of each class over all training texts."""

    def __init__(self, parameters: list[np.ndarray], unigram: np.ndarray, rate: float, seed: int | list[int]):
        self.parameters = [p.astype(np.float32) for p in parameters]
        self.mean, self.square, self.work = ([np.zeros_like(p) for p in self.parameters] for _ in range(3))
        self.rate, self.t, self.rng = rate, 0, np.random.default_rng(seed)
        self.up_to = np.cumsum(unigram) / np.sum(unigram)
        self.log_noise = np.log(NOISE * unigram).astype(np.float32)
        self.cells = cells_of(np.arange(3 * (len(unigram) + 1)), DIMENSIONS // 2)
        self.rows = np.empty((0, DIMENSIONS), np.float32)

    def learn(self, classes: np.ndarray, starts: np.ndarray, batch: int) -> None:
        """Every token once, in random order, `batch` in a step."""
        ids = [x.astype(id_type(len(self.log_noise))) for x in (*contexts(classes, starts, len(self.log_noise)), classes)]
        order = self.rng.permutation(len(classes))
        for at in range(0, len(order), batch):
            part = order[at : at + batch]
            self.step(*(x.take(part).astype(np.int64) for x in ids))

    def step(self, f: np.ndarray, c: np.ndarray, w: np.ndarray) -> None:
        noise = np.searchsorted(self.up_to, self.rng.random(NOISE), side="right").clip(max=len(self.up_to) - 1)
        vectors, m_near, m_far, bias = self.parameters
        n, of_word, of_noise = len(vectors), vectors.take(w, axis=0), vectors.take(noise, axis=0)
        context = (vectors @ m_near).take(c, axis=0)
        context += (vectors @ m_far).take(f, axis=0)
        # slope of the loss: sigmoid - 1 for the token, sigmoid for each noise word
        offset = self.log_noise - bias
        own = sigmoid_of_minus(offset.take(w) - np.einsum("ij,ij->i", context, of_word))
        other = context @ -of_noise.T
        other += offset.take(noise)
        other = sigmoid_of_minus(other)
        own -= 1
        own /= len(w)
        other /= len(w)
        # by word, then by near and by far context
        size, count = len(w), 3 * len(w) + NOISE
        if len(self.rows) < count:
            self.rows = np.empty((count, DIMENSIONS), np.float32)
        rows = self.rows[:count]
        of_words, of_noises, of_nears, of_fars = rows[:size], rows[size : size + NOISE], rows[size + NOISE : count - size], rows[count - size :]
        np.matmul(other, of_noise, out=of_nears)
        of_word *= own[:, None]
        of_nears += of_word
        of_fars[:] = of_nears
        np.matmul(other.T, context, out=of_noises)
        np.multiply(context, own[:, None], out=of_words)
        at = np.concatenate([w, noise, c + n, f + 2 * n])
        by_word, by_near, by_far = sums_in_pairs(self.cells.take(at, axis=0), rows, 3 * n).reshape(3, n, -1)
        g_vectors = by_near @ m_near.T
        g_vectors += by_far @ m_far.T
        g_vectors += by_word
        g_bias = (np.bincount(w, own, n - 1) + np.bincount(noise, np.ones(size, np.float32) @ other, n - 1)).astype(np.float32)
        self.t += 1
        shrink, spread = self.rate / (1 - 0.9**self.t), 1 / (1 - 0.999**self.t)
        for p, g, m, v, x in zip(self.parameters, [g_vectors, vectors.T @ by_near, vectors.T @ by_far, g_bias], self.mean, self.square, self.work, strict=True):
            m *= 0.9
            m += np.multiply(g, 0.1, out=x)
            v *= 0.999
            np.multiply(g, g, out=x)
            x *= 0.001
            v += x
            np.multiply(v, spread, out=x)
            np.sqrt(x, out=x)
            x += 1e-8
            np.divide(m, x, out=x)
            x *= shrink
            p -= x


def sigmoid_of_minus(x: np.ndarray) -> np.ndarray:
    """1 / (1 + e^x), in place."""
    with np.errstate(over="ignore"):  # then it is 0
        np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def sums_at(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Row i: the sum of the values at i, added up as doubles."""
    width = values.shape[1]
    return np.bincount(cells_of(at, width).ravel(), values.ravel(), n * width).reshape(n, width).astype(values.dtype)


def cells_of(at: np.ndarray, width: int) -> np.ndarray:
    """Where the numbers of rows `at` stand in a table of `width` columns."""
    return (at.astype(np.intp) * width)[:, None] + np.arange(width)


def sums_in_pairs(cells: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """sums_at() where cells_of() half the width are known: two doubles are added
    at once, as a complex number."""
    sums = np.zeros(n * cells.shape[1], np.complex128)
    np.add.at(sums, cells.ravel(), values.astype(np.float64).view(np.complex128).ravel())
    return sums.view(np.float64).reshape(n, -1).astype(values.dtype)


def beginning(unigram: np.ndarray, seed: int = 11) -> list[np.ndarray]:
    """The parameters before any step."""
    vectors = np.random.default_rng(seed).normal(0, 0.1, (len(unigram) + 1, DIMENSIONS))  # the last: start, as context only
    return [vectors, np.eye(DIMENSIONS), np.eye(DIMENSIONS) * 0.5, np.log(unigram)]


def train(classes: np.ndarray, starts: np.ndarray, unigram: np.ndarray, epochs: int = EPOCHS, batch: int = STEP_TOKENS[0], rate: float = 0.01, seed: int = 11) -> LogBilinear:
    """The model of tokens at hand, in one process."""
    learner = Learner(beginning(unigram, seed), unigram, rate, seed)
    for _ in range(epochs):
        learner.learn(classes, starts, batch)
    near, far, vectors, bias = products(learner.parameters)
    return LogBilinear(near, far, vectors, bias, normalisers(near, far, vectors, bias).ravel())


def products(parameters: list[np.ndarray]) -> list[np.ndarray]:
    """near, far, vectors and bias of a LogBilinear."""
    vectors, m_near, m_far, bias = (p.astype(np.float32) for p in parameters)
    return [vectors @ m_near, vectors @ m_far, vectors[:-1], bias]


def normalisers(near: np.ndarray, far: np.ndarray, vectors: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """The log-normaliser of each near context with each far one. A sum over the
    classes of e to near and far scores is a product of two matrices."""

    def powers(score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        top = score.max(axis=1, keepdims=True)
        return np.exp(score - top), top[:, 0]

    of_near, top_near = powers(near.astype(np.float64) @ vectors.T + bias)
    table = np.empty((len(near), len(far)))
    for at in range(0, len(far), 512):
        of_far, top_far = powers(far[at : at + 512].astype(np.float64) @ vectors.T)
        table[:, at : at + 512] = np.log(of_near @ of_far.T) + top_near[:, None] + top_far
    return table


@dataclass
class Words:
    """The shared words' places and counts (the last place is the end's where the
    training texts lack it); the slots of all others, which follow; each place's
    class and its number within; and the totals. `mass`: a place's count, smoothed
    as if each word of it, and in a slot the words not seen, occurred once more."""

    place: dict[bytes, int]
    counts: np.ndarray
    slots: int
    mass: np.ndarray
    classes: np.ndarray
    inside: np.ndarray
    n: int
    distinct: int

    def of(self, word: bytes) -> int:
        found = self.place.get(word)
        return found if found is not None else len(self.counts) + crc32(word) % self.slots

    def shared(self) -> pa.Array:
        """The shared words by place."""
        return pa.array(sorted(self.place, key=self.place.__getitem__), pa.binary())

    def unigram(self) -> np.ndarray:
        """Of the classes."""
        sums = np.bincount(self.classes, self.mass)
        return sums / sums.sum()

    def several(self) -> np.ndarray:
        """Whether a class holds more than one place."""
        return np.bincount(self.classes) > 1


def grown_classes(distinct: int) -> int:
    """The square root of the distinct words, within CLASSES and MOST_CLASSES: the
    normalisers of all pairs are bounded, and beyond the bound classes only hold
    more places."""
    return min(MOST_CLASSES, max(CLASSES, isqrt(distinct)))


def dealt(mass: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """The class of each place and its number within: the heaviest half of the
    classes are one place each, the others equal shares of what is left."""
    order = np.argsort(-mass, kind="stable")
    single = min(len(mass), max(1, classes // 2))
    rest = mass[order[single:]].astype(np.float64)
    before = np.cumsum(rest) - rest
    share = np.floor(before * (max(1, classes - single) / max(1.0, rest.sum())))
    ranked = np.concatenate([np.arange(single), single + np.unique(share, return_inverse=True)[1]])
    first = np.searchsorted(ranked, ranked)  # ranked is sorted
    of_class, inside = np.empty(len(mass), np.int64), np.empty(len(mass), np.int64)
    of_class[order], inside[order] = ranked, np.arange(len(mass)) - first
    return of_class, inside


def known_words(counts: DataFrame, shared_words: int, classes: int | None) -> tuple[Words, DataFrame]:
    """The words every task gets, and the table of the others; without `classes`
    their number follows the distinct words."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    frequent = most_frequent(counts, shared_words)
    rows = sorted(((r.n, bytes(r.word)) for r in frequent.collect()), key=lambda r: (-r[0], r[1]))
    least = min((c for c, _ in rows), default=None)
    rare = counts if least is None else counts.where(F.col("n") < least)
    if not any(w == END for _, w in rows):  # rare itself, or no training text at all
        rows.append((sum(r.n for r in counts.where(F.col("word") == F.lit(END)).collect()), END))
    rare = rare.where(F.col("word") != F.lit(END))
    slots = min(SLOTS, 1 + max(0, total[1] - len(rows)) // SLOT_WORDS)
    slot = (F.crc32("word") % slots).cast("int").alias("slot")
    extra = np.ones(slots, np.int64)
    for r in rare.groupBy(slot).agg((F.sum("n") + F.count("*")).alias("mass")).collect():  # at most SLOTS
        extra[r.slot] += r.mass
    n = np.array([c for c, _ in rows], np.int64)
    mass = np.concatenate([n + 1, extra])
    names = {w: i for i, (_, w) in enumerate(rows)}
    return Words(names, n, slots, mass, *dealt(mass, classes or grown_classes(total[1])), total[0], total[1]), rare


def score(df: DataFrame, text: str, key: str, flag: str, training: DataFrame, shared_words: int = SHARED_WORDS, classes: int | None = None) -> DataFrame:
    """Per row: key, flag, n_tokens, n_known, train_tokens, base_score, score.

    Null and empty texts are their end alone; repeated rows and keys stay, each
    scored on its own. Without any training text every word is unseen: base
    score 0, and the model spreads over the end and the others. Other columns are
    not read."""
    counts = stage(token_counts(training, text), "counts")
    words, rare = known_words(counts, shared_words, classes)
    return scored(df, text, key, flag, words, rare, fit(training, text, words))


def scored(df: DataFrame, text: str, key: str, flag: str, words: Words, rare: DataFrame, model: Model) -> DataFrame:
    """The columns of `score`, from what known_words() and fit() gave."""
    rows = stage(apply(df, text, [key, flag], words, model).withColumn("row", F.monotonically_increasing_id()), "scored")
    tail = rows.select("row", F.explode("tail").alias("tail")).select("row", "tail.word", "tail.times")
    sums = tail.join(rare, "word").groupBy("row").agg(F.sum("times").alias("known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("logs"))
    known, logs = F.coalesce("known", F.lit(0)), F.coalesce("logs", F.lit(0.0))
    all_mass = float(np.log10(words.n + words.distinct + 1))
    return rows.join(sums, "row", "left").select(
        key,
        flag,
        "n_tokens",
        (F.col("n_known") + known).alias("n_known"),
        F.lit(words.n).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * all_mass).alias("base_score"),
        (F.col("model") + logs).alias("score"),
    )


@dataclass
class Model:
    """The classes' model; and within classes a place's vector and bias by place
    (zero in classes of one), with the normaliser of each class and context. The
    context there is the nearer of the two classes before that is a single word,
    else the one before; `features` are the contexts' vectors."""

    outer: LogBilinear
    classes: np.ndarray
    several: np.ndarray
    features: np.ndarray
    vectors: np.ndarray
    bias: np.ndarray
    normaliser: np.ndarray

    def log_probability(self, far: np.ndarray, near: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Natural log of P(place | far, near), elementwise."""
        of = self.classes.take(place)
        value = self.outer.log_probability(far, near, of)
        part = np.flatnonzero(self.several.take(of))
        place, of, context = place[part], of[part], clearer(far[part], near[part], self.several)
        within = np.einsum("ij,ij->i", self.features.take(context, axis=0), self.vectors.take(place, axis=0))
        value[part] += within + self.bias.take(place) - self.normaliser.ravel().take(of * self.normaliser.shape[1] + context)
        return value


def clearer(far: np.ndarray, near: np.ndarray, several: np.ndarray) -> np.ndarray:
    """Of the two classes before a token the nearer single word, else the nearer.
    The start, behind the last class, is one word."""
    vague = np.append(several, False)
    return np.where(vague.take(near) & ~vague.take(far), far, near)


def fit(training: DataFrame, text: str, words: Words, epochs: int = EPOCHS, rate: float = 0.01, seed: int = 11) -> Model:
    """Learns from every token of every training text. The texts' places are
    written once, in files of about TASK_TOKENS, and a task gets one or more."""
    tasks = max(1, words.n // TASK_TOKENS)
    coded = stage(encoded(training, text, words).repartition(tasks), "places").coalesce(tasks)
    unigram = words.unigram()
    parameters = beginning(unigram, seed)
    batch = int(np.clip(words.n // STEP_SHARE, *STEP_TOKENS))
    for epoch in range(epochs):
        parameters = averaged(coded, parameters, unigram, batch, rate / (1 + epoch), [seed, epoch], words.classes)
    near, far, vectors, bias = products(parameters)
    outer = LogBilinear(near, far, vectors, bias, normaliser_table(training.sparkSession, near, far, vectors, bias).ravel())
    return within_classes(coded, words, outer, features(near, unigram), tasks, seed)


def features(near: np.ndarray, unigram: np.ndarray) -> np.ndarray:
    """The contexts' vectors, centred and scaled to a mean square length of half
    their dimensions."""
    weight = np.append(unigram, unigram.min())
    centred = near - np.average(near, axis=0, weights=weight)
    spread = np.sqrt(np.average(centred**2, axis=0, weights=weight))
    return (centred / np.maximum(spread, 1e-6) * np.sqrt(0.5)).clip(-4, 4).astype(np.float32)


class Inside:
    """One class's places, learning by noise-contrastive estimation: a place's
    vector and bias against the contexts' fixed vectors. The steps are plain
    gradients, shortened by how often a step meets a place, so a rare place
    moves by its few tokens only. A row of `table` is a place's vector, then its
    bias, whose context is one."""

    def __init__(self, mass: np.ndarray, contexts: np.ndarray, seed: list[int]):
        p = mass / mass.sum()
        self.features, self.rng = contexts, np.random.default_rng(seed)
        self.table = np.zeros((len(p), contexts.shape[1] + 1), np.float32)
        self.vectors, self.bias = self.table[:, :-1], self.table[:, -1]
        self.bias[:] = np.log(p)
        self.up_to, self.log_noise = np.cumsum(p), np.log(INSIDE_NOISE * p).astype(np.float32)
        self.pace = (1 / (1 + INSIDE_STEP * p)).astype(np.float32)

    def learn(self, context: np.ndarray, place: np.ndarray) -> None:
        closed = np.column_stack([self.features, np.ones(len(self.features), np.float32)])
        for epoch in range(INSIDE_EPOCHS):
            order = self.rng.permutation(len(place))
            for at in range(0, len(order), INSIDE_STEP):
                part = order[at : at + INSIDE_STEP]
                self.step(closed.take(context[part], axis=0), place[part], INSIDE_RATE / (1 + epoch))

    def step(self, x: np.ndarray, w: np.ndarray, rate: float) -> None:
        noise = np.searchsorted(self.up_to, self.rng.random(INSIDE_NOISE), side="right").clip(max=len(self.bias) - 1)
        against = -self.table
        against[:, -1] += self.log_noise
        own = sigmoid_of_minus(np.einsum("ij,ij->i", x, against.take(w, axis=0))) - 1
        other = sigmoid_of_minus(x @ against.take(noise, axis=0).T)
        rows = np.concatenate([own[:, None] * x, other.T @ x])
        slope = sums_at(np.concatenate([w, noise]), rows, len(self.bias)) * (rate * self.pace)[:, None]
        slope *= np.minimum(1, INSIDE_REACH / np.maximum(np.sqrt(np.einsum("ij,ij->i", slope, slope)), 1e-9))[:, None]
        self.table -= slope

    def normalisers(self) -> np.ndarray:
        """Of each context."""
        total = np.full(len(self.features), -np.inf)
        for at in range(0, len(self.bias), 1024):
            score = self.features @ self.vectors[at : at + 1024].T + self.bias[at : at + 1024]
            top = score.max(axis=1)
            total = np.logaddexp(total, top + np.log(np.exp(score - top[:, None]).sum(axis=1)))
        return total.astype(np.float32)


def by_class(coded: DataFrame, words: Words) -> DataFrame:
    """(class, contexts, places): the tokens of classes of several places, some at
    a time; a place by its number within the class."""
    kind, classes, inside, several = id_type(len(words.unigram())), words.classes, words.inside, words.several()

    def rows_of(texts: list[np.ndarray]) -> pa.RecordBatch:
        places = np.concatenate(texts)
        of = classes[places]
        far, near = contexts(of, np.cumsum([0, *map(len, texts)])[:-1], len(several))
        kept = np.flatnonzero(several[of])
        kept = kept[np.argsort(of[kept].astype(kind), kind="stable")]
        sorted_of, context, number = of[kept], clearer(far[kept], near[kept], several).astype(kind), inside[places[kept]].astype(np.uint32)
        at = np.flatnonzero(np.diff(sorted_of, prepend=-1))
        ends = [*at[1:], len(kept)] if len(at) else []
        pieces = [[x[a:b].tobytes() for a, b in zip(at, ends, strict=True)] for x in (context, number)]
        return pa.RecordBatch.from_arrays([pa.array(sorted_of[at], pa.int32()), *(pa.array(x, pa.binary()) for x in pieces)], ["class", "contexts", "places"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[np.ndarray] = []
        for batch in batches:
            for value in batch.column(0):
                texts.append(np.frombuffer(value.as_buffer(), np.uint32))
            if sum(map(len, texts)) >= CHUNK_TOKENS:
                yield rows_of(texts)
                texts = []
        if texts:
            yield rows_of(texts)

    return coded.mapInArrow(lean(run), "class int, contexts binary, places binary")


def within_classes(coded: DataFrame, words: Words, outer: LogBilinear, contexts_of: np.ndarray, tasks: int, seed: int) -> Model:
    """Learns the places of each class. Classes of several places hold about equal
    shares of the tokens; a task takes them one after another, and of a class
    CHUNK_TOKENS at a time. To the driver come the places' vectors (bounded by
    the shared words and slots) and a normaliser for each class and context."""
    several = words.several()
    kind, n = id_type(len(several)), len(several)
    order = np.argsort(words.classes, kind="stable")
    ends = np.cumsum(np.bincount(words.classes))
    mass = np.split(words.mass[order], ends[:-1])

    def learnt(of: int, parts: Iterator[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        inside = Inside(mass[of], contexts_of, [seed, of])
        for context, place in parts:
            inside.learn(context, place)
        found = [inside.vectors, inside.bias, inside.normalisers()]
        return pa.RecordBatch.from_arrays([pa.array([of], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in found)], ["class", "vectors", "bias", "logs"])

    def chunks(rows: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for _, context, place in rows:
            held.append((context, place))
            if sum(len(p) for _, p in held) >= CHUNK_TOKENS:
                yield tuple(map(np.concatenate, zip(*held, strict=True)))
                held = []
        if held:
            yield tuple(map(np.concatenate, zip(*held, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            (of, np.frombuffer(context.as_buffer(), kind), np.frombuffer(place.as_buffer(), np.uint32).astype(np.int64))
            for batch in batches
            for of, context, place in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True)
        )
        for of, group in groupby(rows, key=lambda r: r[0]):
            yield learnt(of, chunks(group))

    shuffled = by_class(coded, words).repartition(max(1, min(tasks, int(several.sum()))), "class").sortWithinPartitions("class")
    model = Model(outer, words.classes, several, contexts_of, np.zeros((len(order), contexts_of.shape[1]), np.float32), np.zeros(len(order), np.float32), np.zeros((n, n + 1), np.float32))
    for r in shuffled.mapInArrow(lean(run), "class int, vectors binary, bias binary, logs binary").collect():  # bounded
        at = order[ends[r["class"]] - len(mass[r["class"]]) : ends[r["class"]]]
        model.vectors[at] = np.frombuffer(r.vectors, np.float32).reshape(len(at), -1)
        model.bias[at] = np.frombuffer(r.bias, np.float32)
        model.normaliser[r["class"]] = np.frombuffer(r.logs, np.float32)
    untouched = np.setdiff1d(np.flatnonzero(several), np.flatnonzero(model.normaliser.any(axis=1)))
    for of in untouched:  # no training token: the smoothed shares
        at = order[ends[of] - len(mass[of]) : ends[of]]
        model.bias[at] = np.log(words.mass[at] / words.mass[at].sum())
    return model


def id_type(n: int) -> type:
    """The shortest type that numbers n classes and the start."""
    return np.uint16 if n < 1 << 16 else np.uint32


def encoded(df: DataFrame, text: str, words: Words) -> DataFrame:
    """Each text's places, as bytes of uint32."""
    shared, slots = words.shared(), words.slots

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, length = token_arrays(batch.column(0))
            ids = placed(found, shared, slots)[0].astype(np.uint32)
            ends = (4 * np.concatenate([[0], np.cumsum(length)])).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.BinaryArray.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(ends), pa.py_buffer(ids)])], ["places"])

    return text_batches(df).select(F.col(text).alias("text")).mapInArrow(lean(run), "places binary")


def placed(found: pa.Array, shared: pa.Array, slots: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words.of() of many words; which of them are in slots, and these words."""
    at = pc.index_in(found, value_set=shared)
    others = np.flatnonzero(at.is_null().to_numpy(zero_copy_only=False))
    rare = found.take(pa.array(others))
    ids = at.fill_null(0).to_numpy().astype(np.int64)
    ids[others] = [len(shared) + crc32(w) % slots for w in rare.to_numpy(zero_copy_only=False)]
    return ids, others, rare


def times_in(row: np.ndarray, found: pa.Array, rows: int) -> pa.Array:
    """For each of `rows` the words found in it, with how often; `row` grows."""
    coded = found.dictionary_encode()
    one, times = np.unique(row * len(coded.dictionary) + coded.indices.to_numpy(), return_counts=True)
    row, code = np.divmod(one, max(1, len(coded.dictionary)))
    pairs = pa.StructArray.from_arrays([coded.dictionary.take(pa.array(code)), pa.array(times, pa.int64())], fields=list(schema_type().value_type))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(rows + 1)), pa.int32()), pairs, schema_type())


def averaged(coded: DataFrame, parameters: list[np.ndarray], unigram: np.ndarray, batch: int, rate: float, seed: list[int], classes: np.ndarray | None = None) -> list[np.ndarray]:
    """One epoch over rows of classes, or of places with their `classes`: every task learns from its own texts, from the same parameters
    on; the mean of what they come to, by their tokens. Summed by row of the
    parameters, so the driver gets one set of them, however many tasks there are."""
    n, kind = len(unigram), id_type(len(unigram)) if classes is None else np.uint32
    names = [f"p{i}" for i in range(DIMENSIONS + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        learner, total, texts, held = Learner(parameters, unigram, rate, [*seed, task.partitionId() if task else 0]), 0, [], 0

        def learn() -> None:
            starts = np.cumsum([0, *map(len, texts)])[:-1].astype(np.int64)
            learner.learn(np.concatenate(texts), starts, batch)

        for rows in batches:
            for value in rows.column(0):
                ids = np.frombuffer(value.as_buffer(), kind)
                texts.append(ids.astype(np.int64) if classes is None else classes.take(ids))
                held += len(texts[-1])
                if held >= CHUNK_TOKENS:
                    learn()
                    total, texts, held = total + held, [], 0
        if texts:
            learn()
        total += held
        if total:
            rows = packed(learner.parameters) * total
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(rows))), pa.array(np.full(len(rows), float(total))), *map(pa.array, rows.T.copy())], ["place", "weight", *names])

    summed = coded.mapInArrow(lean(run), ", ".join(["place long", "weight double", *(f"{x} double" for x in names)])).groupBy("place").agg(*[F.sum(x).alias(x) for x in ("weight", *names)])
    rows = sorted(summed.collect())
    return unpacked(np.array([[x / r.weight for x in r[2:]] for r in rows]), n) if rows else parameters


def packed(parameters: list[np.ndarray]) -> np.ndarray:
    """All parameters in rows of DIMENSIONS + 1: the vectors with their biases,
    then the two matrices."""
    vectors, m_near, m_far, bias = parameters
    rows = np.zeros((len(vectors) + 2 * DIMENSIONS, DIMENSIONS + 1))
    rows[:, :-1] = np.concatenate([vectors, m_near, m_far])
    rows[: len(bias), -1] = bias
    return rows


def unpacked(rows: np.ndarray, n: int) -> list[np.ndarray]:
    vectors, m_near, m_far = np.split(rows[:, :-1], [n + 1, n + 1 + DIMENSIONS])
    return [vectors, m_near, m_far, rows[:n, -1]]


def normaliser_table(spark: SparkSession, near: np.ndarray, far: np.ndarray, vectors: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """normalisers() of all pairs, in tasks by the near class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.column(0).to_numpy()
            logs = normalisers(near[part], far, vectors, bias).astype(np.float32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in logs], pa.binary())], ["id", "logs"])

    tasks = min(len(near), 1 + len(near) ** 3 // TASK_PRODUCTS)
    table = np.empty((len(near), len(far)), np.float32)
    for r in text_batches(spark.range(0, len(near), 1, tasks)).mapInArrow(lean(run), "id long, logs binary").toLocalIterator():
        table[r.id] = np.frombuffer(r.logs, np.float32)
    return table


def apply(df: DataFrame, text: str, keep: list[str], words: Words, model: Model) -> DataFrame:
    """What the shared words and slots say of each row, and the row's other words."""
    schema = schema_with(df, keep, "n_tokens long, n_known long, base double, model double, tail array<struct<word: binary, times: long>>")
    names, slots, shared, start = words.shared(), words.slots, len(words.counts), len(model.several)
    logs = np.concatenate([np.log10(words.counts + 1), np.zeros(words.slots)])
    known = np.concatenate([words.counts > 0, np.zeros(words.slots, bool)])
    # a word in a slot is its count's share of it
    of_slot = np.concatenate([np.zeros(shared), np.log10(words.mass[shared:])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            every, lengths = token_arrays(whole.column(len(keep)))
            ids, others, rare = placed(every, names, slots)
            ends = np.cumsum(lengths, dtype=np.int64)
            tails = times_in(np.searchsorted(ends, others, side="right"), rare, len(ends))
            for at in range(0, whole.num_rows, 500):
                batch, length = whole.slice(at, 500), lengths[at : at + 500].astype(np.int64)
                starts = np.cumsum(length) - length
                found = ids[ends[at] - length[0] :][: length.sum()]
                far, near = contexts(model.classes.take(found), starts, start)
                value = np.empty(len(found))
                for i in range(0, len(found), 8192):
                    part = slice(i, i + 8192)
                    value[part] = model.log_probability(far[part], near[part], found[part])
                by_row = lambda x: np.add.reduceat(x, starts) if len(starts) else np.zeros(0, x.dtype)
                out = [
                    pa.array(length),
                    pa.array(by_row(known.take(found).astype(np.int64))),
                    pa.array(by_row(logs.take(found))),
                    pa.array(by_row(value / np.log(10) - of_slot.take(found))),
                    tails.slice(at, 500),
                ]
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *out], names=[f.name for f in schema])

    return text_batches(df).select(*keep, F.col(text).alias("__text")).mapInArrow(lean(run), schema)


def schema_type() -> pa.DataType:
    return pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int64())]))
