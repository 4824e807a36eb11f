"""A quality classifier by compression.

Two Zstandard dictionaries hold text labelled good and text labelled bad. Each
text is compressed with both, piece by piece so that a long text doesn't become
its own dictionary; the difference of the two sizes, divided by the text's
bytes, is turned into a probability by a logistic curve fitted on labelled
texts that are in neither dictionary. The curve also takes the compressed share
of the text's bytes, which tells a text too short to show a difference from one
that repeats itself so much that none is left. Dictionaries and curve are fitted on the
driver from a bounded sample; scoring is one narrow pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylens.llm.common import class_sample, free_name, lean, schema_with, text_batches, unit_hash

#: Bytes compressed at a time, and of each dictionary.
PIECE = 1024
DICTIONARY = 64 * 1024
#: Bound of the sample: labelled texts of each class (half of them make the
#: dictionary, half the curve), and of each the pieces of SAMPLE characters that
#: are learned from, evenly spaced over the whole text (all, if no more).
TEXTS_PER_CLASS = 1000
PIECES_PER_TEXT = 16
SAMPLE = 512
LEVEL = 3
GOOD_FROM = 0.7


@dataclass
class CompressionModel:
    good: bytes
    bad: bytes
    slope: np.ndarray
    offset: float

    def scorer(self) -> "Scorer":
        return Scorer(self)

    def probability(self, measures: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(measures @ self.slope + self.offset, -30, 30)))


class Scorer:
    """The compressors of one task."""

    def __init__(self, model: CompressionModel):
        self.model = model
        self.good, self.bad = (compressor(d) for d in (model.good, model.bad))

    def measure(self, text: str | None) -> tuple[float, float]:
        """(size with the bad dictionary - size with the good) / bytes, and the
        smaller size / bytes; (0, 1) if empty."""
        raw = (text or "").encode()
        good = bad = 0
        for at in range(0, len(raw), PIECE):
            piece = raw[at : at + PIECE]
            good += len(self.good.compress(piece))
            bad += len(self.bad.compress(piece))
        return ((bad - good) / len(raw), min(1.0, min(good, bad) / len(raw))) if raw else (0.0, 1.0)

    def measures(self, texts: list[str | None]) -> np.ndarray:
        return np.array([self.measure(t) for t in texts], float).reshape(len(texts), 2)

    def score(self, texts: list[str | None]) -> np.ndarray:
        return self.model.probability(self.measures(texts))


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary or b"\x00" * 8)  # trained, or raw content where too little was given
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False)


def dictionary(texts: list[str]) -> bytes:
    """Trained on samples of the texts; of too few to train on (under 200), a raw
    content dictionary of their own bytes."""
    raw = [t.encode() for t in texts]
    samples = [b[at : at + SAMPLE] for b in raw for at in range(0, len(b), SAMPLE)]
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes() if len(samples) >= 200 else b"".join(raw)[-DICTIONARY:]
    except zstandard.ZstdError:
        return b"".join(raw)[-DICTIONARY:]


def logistic(x: np.ndarray, y: np.ndarray, odds: float, rounds: int = 100) -> tuple[np.ndarray, float]:
    """Slopes and offset by Newton's method with a weak penalty; soft targets
    (Platt) keep a separable sample finite. `odds` of class 1 among all labels
    corrects for the sample's balance."""
    n1, n0 = y.sum(), (1 - y).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale = np.maximum(np.abs(x).max(axis=0), 1e-9)
    a = np.column_stack([x / scale, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (p - target) + 1e-3 * w
        step = np.linalg.solve((a * (p * (1 - p) + 1e-9)[:, None]).T @ a + 1e-3 * np.eye(len(w)), gradient)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return w[:-1] / scale, float(w[-1] + np.log(odds) - np.log(n1 / n0))


def train(texts: list[str], labels: list[int], in_dictionary: list[bool], odds: float | None = None) -> CompressionModel:
    """With a class missing on either side all texts serve both steps; with one
    class altogether the score is that class's smoothed share."""
    y = np.array(labels)
    made = np.array(in_dictionary, bool)
    if any(not ((y == c) & s).any() for c in (0, 1) for s in (made, ~made)):
        made = np.ones(len(y), bool)
        fitted = made
    else:
        fitted = ~made
    good = dictionary([t for t, c, m in zip(texts, y, made, strict=True) if c == 1 and m])
    bad = dictionary([t for t, c, m in zip(texts, y, made, strict=True) if c == 0 and m])
    odds = odds or float((y.sum() + 1) / (len(y) - y.sum() + 1))
    model = CompressionModel(good, bad, np.zeros(2), float(np.log(odds)))
    if 0 < y.sum() < len(y):
        scorer = model.scorer()
        x = scorer.measures([t for t, f in zip(texts, fitted, strict=True) if f])
        model.slope, model.offset = logistic(x, y[fitted].astype(float), odds)
    return model


def agreed_labels(labels: DataFrame, key: str, label: str) -> DataFrame:
    """(key, label) of the ids labelled 0 or 1, and not both."""
    return (
        labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(label).alias("label"), F.max(label).alias("other"))
        .where("label = other")
        .select(F.col(key).alias("key"), "label")
    )


def spaced(text: Column, pieces: int = PIECES_PER_TEXT, size: int = SAMPLE) -> Column:
    """A text of at most pieces * size characters whole; of a longer one `pieces`
    pieces at equal distances, the first at its start and the last at its end."""
    gap = (F.length(text) - size) / (pieces - 1)
    cut = F.transform(F.sequence(F.lit(0), F.lit(pieces - 1)), lambda i: F.substring(text, F.floor(i * gap).cast("int") + 1, F.lit(size)))
    return F.when(F.length(text) <= pieces * size, text).otherwise(F.array_join(cut, ""))


def labelled(documents: DataFrame, agreed: DataFrame, text: str, key: str, per_class: int) -> DataFrame:
    """(text, label, in_dictionary) of a bounded sample of labelled texts, each
    `spaced`. The sample is drawn from the ids, so only its own texts are fetched,
    and of a long one only the pieces leave its task."""
    # bounded: at most 4 * per_class ids
    chosen = F.broadcast(class_sample(agreed, "label", "key", per_class))
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.length("text") > 0)
    return (
        rows.join(chosen, "key")
        .select(spaced(F.col("text")).alias("text"), "label", (unit_hash(F.col("key"), F.lit("dictionary")) < 0.5).alias("in_dictionary"), "key")
        .orderBy("key", "text")
        .limit(4 * per_class)
    )


def fit(documents: DataFrame, labels: DataFrame, text: str, key: str, label: str, per_class: int = TEXTS_PER_CLASS) -> CompressionModel:
    """Learns from at most 4 * per_class labelled texts of `documents`."""
    agreed = agreed_labels(labels, key, label)
    rows = labelled(documents, agreed, text, key, per_class).collect()
    n = {r["label"]: r["count"] for r in agreed.groupBy("label").count().collect()}
    odds = (n.get(1, 0) + 1) / (n.get(0, 0) + 1)
    return train([r.text for r in rows], [r.label for r in rows], [r.in_dictionary for r in rows], odds)


def score(df: DataFrame, text: str, keep: list[str], model: CompressionModel) -> DataFrame:
    """The columns `keep`, score (0 to 1, higher: better) and predicted (1 from
    GOOD_FROM on). Null and empty texts score as no difference and no compression."""
    schema = schema_with(df, keep, "score double, predicted int")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            got = scorer.score(batch.column(len(keep)).to_pylist())
            out = [pa.array(got), pa.array((got >= GOOD_FROM).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *out], names=[f.name for f in schema])

    return text_batches(df).select(*keep, F.col(text).alias(free_name(df, "__text"))).mapInArrow(lean(apply), schema)


def good(df: DataFrame, text: str, model: CompressionModel) -> DataFrame:
    """The rows of `df`, all columns, that are predicted good; the others go."""

    columns = df.columns

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            good_enough = scorer.score(batch.column(len(columns)).to_pylist()) >= GOOD_FROM
            yield pa.RecordBatch.from_arrays(batch.columns[:-1], names=columns).filter(pa.array(good_enough, pa.bool_()))

    return text_batches(df).select("*", F.col(text).alias(free_name(df, "__text"))).mapInArrow(lean(apply), df.schema)
