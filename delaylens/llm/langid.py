"""Language identification with a byte convolutional network.

A text's lower-cased UTF-8 bytes are cut into windows of fixed length. For each
width, filters slide over a window; the largest response of each filter in the
window feeds a softmax over the languages. A text's probabilities are the mean
over all its windows, weighted by their bytes. The network is trained in numpy
on the driver from a bounded sample of labelled windows; applying it is one
narrow pass over the texts, in batches, without any shuffle.

A filter of width w over one-hot bytes is w tables of 256 entries, so the
convolution is w look-ups and additions per position, and the gradient of the
max pooling reaches only the bytes under each filter's best position.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.llm.common import class_sample, free_name, lean, schema_with, text_batches

#: Bytes in a window; the last one of a text is padded with zeros.
WINDOW = 96
WIDTHS = (2, 3, 4)
FILTERS = 16
#: Bounds of the training sample: texts of each language, windows of each text.
TEXTS_PER_LANGUAGE = 400
WINDOWS_PER_TEXT = 12
UNDETERMINED = "und"


@dataclass
class ByteConvNet:
    """Filter tables by width (w, 256, filters), their biases, and the softmax layer."""

    labels: list[str]
    tables: list[np.ndarray]
    biases: list[np.ndarray]
    weights: np.ndarray
    offset: np.ndarray

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Each window's largest responses (n, filters of all widths) and where they are."""
        x = windows.astype(np.intp)
        best, where = [], []
        for table, bias in zip(self.tables, self.biases, strict=True):
            width = len(table)
            last = x.shape[1] - width + 1
            response = table[0].take(x[:, :last], axis=0)
            for k in range(1, width):
                response += table[k].take(x[:, k : k + last], axis=0)
            at = response.argmax(axis=1) if self.training else None
            best.append(response.max(axis=1) + bias)
            where.append(at)
        return np.maximum(np.concatenate(best, axis=1), 0), where

    training = False

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        pooled, _ = self.pooled(windows)
        return softmax(pooled @ self.weights + self.offset)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows over the whole of each text data[start:end]: the windows, the row
    each belongs to, and the bytes each holds. A text without bytes has none."""
    length = ends - starts
    count = -(-length // WINDOW)
    row = np.repeat(np.arange(len(starts)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    first = starts[row] + nth * WINDOW
    size = np.minimum(ends[row] - first, WINDOW)
    at = first[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < size[:, None]
    return np.where(inside, data[np.minimum(at, max(len(data) - 1, 0))], 0).astype(np.uint8) if len(row) else np.zeros((0, WINDOW), np.uint8), row, size


def text_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased texts' bytes, and where each starts and ends."""
    lowered = pc.utf8_lower(pc.fill_null(text.cast(pa.large_string()), ""))
    offsets = np.frombuffer(lowered.buffers()[1], np.int64)[lowered.offset : lowered.offset + len(lowered) + 1]
    data = lowered.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets[:-1], offsets[1:]


def train(texts: list[str], labels: list[str], epochs: int = 4, batch: int = 128, rate: float = 0.004, seed: int = 7) -> ByteConvNet:
    """Fits the network by Adam on cross-entropy over evenly spaced windows of
    each text; each language weighs the same."""
    names = sorted(set(labels))
    rng = np.random.default_rng(seed)
    data, starts, ends = text_bytes(pa.array(texts, pa.string()))
    windows, row, _ = cut(data, starts, ends)
    count = np.bincount(row, minlength=len(texts))
    nth = np.arange(len(row)) - (np.cumsum(count) - count)[row]
    step = np.maximum(1, -(-count // WINDOWS_PER_TEXT))
    chosen = nth % step[row] == 0
    x, y = windows[chosen], np.searchsorted(names, labels)[row[chosen]]
    net = ByteConvNet(
        names,
        [rng.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        rng.normal(0, 0.2, (FILTERS * len(WIDTHS), len(names))).astype(np.float32),
        np.zeros(len(names), np.float32),
    )
    net.training = True
    parameters = [*net.tables, *net.biases, net.weights, net.offset]
    mean, square, t = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters], 0
    weight = (len(y) / (len(names) * np.maximum(np.bincount(y, minlength=len(names)), 1)))[y].astype(np.float32)
    epochs = max(epochs, -(-300 * batch // max(len(y), 1)))  # at least 300 steps
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            part = order[at : at + batch]
            pooled, where = net.pooled(x[part])
            slope = softmax(pooled @ net.weights + net.offset)
            slope[np.arange(len(part)), y[part]] -= 1
            slope *= weight[part, None] / len(part)
            back = (slope @ net.weights.T) * (pooled > 0)
            grads = []
            for i, (w, at_best) in enumerate(zip(WIDTHS, where, strict=True)):
                g = back[:, i * FILTERS : (i + 1) * FILTERS]
                grad = np.zeros((w, 256, FILTERS), np.float32)
                for k in range(w):
                    seen = np.take_along_axis(x[part], at_best + k, axis=1)
                    np.add.at(grad[k], (seen, np.arange(FILTERS)[None, :]), g)
                grads.append(grad)
            grads += [back[:, i * FILTERS : (i + 1) * FILTERS].sum(axis=0) for i in range(len(WIDTHS))]
            grads += [pooled.T @ slope, slope.sum(axis=0)]
            t += 1
            for p, g, m, v in zip(parameters, grads, mean, square, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    net.training = False
    return net


def classify(net: ByteConvNet, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Each text's language (place in labels) and its mean probability."""
    data, starts, ends = text_bytes(text)
    windows, row, size = cut(data, starts, ends)
    total = np.zeros((len(text), len(net.labels)))
    for at in range(0, len(row), 256):
        part = slice(at, at + 256)
        np.add.at(total, row[part], net.probabilities(windows[part]) * size[part, None])
    share = total / np.maximum(total.sum(axis=1, keepdims=True), 1e-12)
    return share.argmax(axis=1), share.max(axis=1)


def fit(rows: DataFrame, text: str, label: str, key: str, per_language: int = TEXTS_PER_LANGUAGE) -> ByteConvNet | None:
    """Learns from at most 2 * per_language texts per language of `rows`; rows
    without text, letters or label teach nothing. None if none is left."""
    usable = rows.where(F.col(text).rlike(r"\p{L}") & F.col(label).isNotNull())
    sample = class_sample(usable.select(text, label, key), label, key, per_language).collect()
    return train([r[text] for r in sample], [r[label] for r in sample]) if sample else None


def identify(df: DataFrame, text: str, keep: list[str], net: ByteConvNet | None) -> DataFrame:
    """The columns `keep`, lang_pred and score (mean probability of that language
    over the whole text). Null texts, texts without a letter, and every text if
    there is no model: `und` with score 0. Ties go to the first label."""
    schema = schema_with(df, keep, "lang_pred string, score double")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, names, score in judged(batches, len(keep), net):
            out = [pa.array(names, pa.string()), pa.array(np.clip(score, 0, 1))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *out], names=[f.name for f in schema])

    return with_letters(df, text, keep).mapInArrow(lean(apply), schema)


def with_letters(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    has_letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    return text_batches(df).select(*keep, F.col(text).alias(free_name(df, "__text")), has_letter.alias(free_name(df, "__has_letter")))


def judged(batches: Iterator[pa.RecordBatch], n_keep: int, net: ByteConvNet | None) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Small batches with each row's language and score; text and letter flag
    follow the kept columns."""
    for whole in batches:
        for at in range(0, whole.num_rows, 500):
            batch = whole.slice(at, 500)
            has_letter = batch.column(n_keep + 1).to_numpy(zero_copy_only=False).astype(bool) & (net is not None)
            names, score = np.full(batch.num_rows, UNDETERMINED, object), np.zeros(batch.num_rows)
            if has_letter.any():
                best, share = classify(net, batch.column(n_keep).filter(pa.array(has_letter)))
                names[has_letter], score[has_letter] = np.array(net.labels, object)[best], share
            yield batch, names, score


def determined(df: DataFrame, text: str, net: ByteConvNet | None) -> DataFrame:
    """The rows of `df`, all columns, whose language is found; the others go."""

    columns = df.columns

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, names, _ in judged(batches, len(columns), net):
            kept = pa.RecordBatch.from_arrays(batch.columns[:-2], names=columns)
            yield kept.filter(pa.array(names != UNDETERMINED, pa.bool_()))

    return with_letters(df, text, df.columns).mapInArrow(lean(apply), df.schema)
