"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Each text is encoded by a byte-level BPE and by a sentence-piece model. Both give
tokens whose bytes join to the same text, so every token has a byte range. Per
batch, an as-of merge keyed by document finds for each token start the other
side's token that covers it; the union of both directions is every overlap, and
overlaps with equal ends close the groups, within which all tokens are linked.

A first pass writes each document's alignment with its distinct id pairs. Pairs
are then counted over all documents and joined back, by a broadcast while their
number is known to be small.

Long texts are worked through in pieces. Texts are cut before a space between two
ASCII letters, where both tokenizers start anew, so the tokens stay the same.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaylens.llm.bpe import WORDS, id_pieces
from delaylens.llm.common import free_name, lean, schema_with, single_threaded, text_batches
from delaylens.session import stage

#: Characters of one piece of a text, and of the pieces that are aligned at once.
PIECE_CHARS = 100_000
SLICE_CHARS = 400_000
#: Id pairs in one written row; a document with more has several rows.
ROW_PAIRS = 65_536
#: A group with more links than this is counted by its distinct ids.
LARGE_GROUP = 1_000_000
#: Counted id pairs sent to every task, some 30 bytes each; more are joined by a shuffle.
BROADCAST_PAIRS = 1_000_000
#: Bits of an id within a pair.
ID_BITS = 20

CUT = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
#: The sentence-piece mark of a space, and the names of its bytes.
MARK, BYTE_NAME = "▁", re.compile(r"<0x([0-9A-F]{2})>")


def public_model(name: str = "piece_bpe_32k.model") -> bytes:
    """A public sentence-piece model, read once on the driver."""
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_bytes()


class Side:
    """One tokenizer: encodes texts with a space before each; bytes by id."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], pieces: list[bytes]):
        self.encode, self.pieces = encode, pieces
        self.length = np.fromiter(map(len, pieces), np.int64, len(pieces))

    def tokens(self, texts: list[str]) -> tuple[list[list[int]], list[bool]]:
        """Ids of each text, and whether their bytes are the text's."""
        ids = self.encode(texts)
        return ids, [b"".join(map(self.pieces.__getitem__, i)) == f" {t}".encode() for i, t in zip(ids, texts)]


@lru_cache(maxsize=2)
def byte_side(tokenizer_json: str) -> Side:
    """The byte-level tokenizer over its own vocabulary, special tokens as plain
    text. Where ids follow the order of merges, as in the public vocabularies, an
    id is its merge's rank, and the faster library that works on ranks gives the
    same ids."""
    single_threaded()
    definition, pieces = json.loads(tokenizer_json), id_pieces(tokenizer_json)
    vocabulary = definition["model"]["vocab"]
    merges = [m if isinstance(m, list) else m.split(" ") for m in definition["model"]["merges"]]
    merged = [vocabulary[a + b] for a, b in merges]
    if merged == sorted(merged):
        import tiktoken

        ranks = {pieces[i]: i for i in vocabulary.values() if i not in special_ids(definition)}
        ranked = tiktoken.Encoding("ranks", pat_str=WORDS.removeprefix("(?U)"), mergeable_ranks=ranks, special_tokens={})
        return Side(lambda texts: [ranked.encode_ordinary(f" {t}") for t in texts], pieces)

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_json)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.encode_special_tokens = True
    return Side(lambda texts: [e.ids for e in tokenizer.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)], pieces)


def special_ids(definition: dict) -> set[int]:
    return {t["id"] for t in definition.get("added_tokens") or []}


def piece_bytes(piece: str) -> bytes:
    if named := BYTE_NAME.fullmatch(piece):
        return bytes([int(named[1], 16)])
    return piece.replace(MARK, " ").encode()


@lru_cache(maxsize=2)
def piece_side(model: bytes) -> Side:
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces = [processor.id_to_piece(i) for i in range(processor.get_piece_size())]
    return Side(lambda texts: processor.encode(texts, num_threads=1), [piece_bytes(p) for p in pieces])


def in_pieces(text: str, most: int = PIECE_CHARS) -> Iterator[str]:
    """The text without the single spaces at which it is cut."""
    at = 0
    while len(text) - at > most:
        cut = CUT.search(text, at + most)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.end()
    yield text[at:]


def covering(starts: np.ndarray, owner: np.ndarray, others: np.ndarray, other_owner: np.ndarray) -> np.ndarray:
    """For each token start, the other side's token of its document that covers
    it; both in order of their places."""
    here = pd.DataFrame({"at": starts, "doc": owner})
    there = pd.DataFrame({"at": others, "doc": other_owner, "token": np.arange(len(others))})
    return pd.merge_asof(here, there, on="at", by="doc")["token"].to_numpy(np.int64)


class Aligned:
    """Tokens of several texts, one after the other, aligned at once. a, b: ids;
    a_doc, b_doc: each token's text, in order."""

    def __init__(self, a: np.ndarray, b: np.ndarray, a_doc: np.ndarray, b_doc: np.ndarray, a_length: np.ndarray, b_length: np.ndarray):
        self.a, self.b, self.a_doc, self.b_doc = a, b, a_doc, b_doc
        self.a_end, self.b_end = np.cumsum(a_length[a]), np.cumsum(b_length[b])
        self.a_start, self.b_start = self.a_end - a_length[a], self.b_end - b_length[b]
        # a pair of places as one number, in order of a's and then of b's place
        from_a = np.arange(len(a)) * len(b) + covering(self.a_start, a_doc, self.b_start, b_doc)
        from_b = covering(self.b_start, b_doc, self.a_start, a_doc) * len(b) + np.arange(len(b))
        both = np.sort(np.concatenate([from_a, from_b]), kind="stable")  # two runs in order
        x, y = np.divmod(both[np.append(True, both[1:] != both[:-1])] if len(both) else both, max(len(b), 1))
        self.overlaps = np.stack([x, y])
        closed = self.a_end[x[self.a_end[x] == self.b_end[y]]]
        self.a_group, self.b_group = np.searchsorted(closed, self.a_end), np.searchsorted(closed, self.b_end)
        self.n_groups = len(closed)
        self.a_size = np.bincount(self.a_group, minlength=self.n_groups)
        self.b_size = np.bincount(self.b_group, minlength=self.n_groups)
        self.a_first, self.b_first = np.cumsum(self.a_size) - self.a_size, np.cumsum(self.b_size) - self.b_size
        self.links = self.a_size * self.b_size
        self.doc = a_doc[self.a_first] if self.n_groups else np.zeros(0, np.int64)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair of ids, times linked), by text and pair, each once."""
        large = self.links > LARGE_GROUP
        partner = np.where(large[self.a_group], 0, self.b_size[self.a_group])
        ends = np.cumsum(partner)
        of = np.repeat(np.arange(len(self.a)), partner)
        with_b = self.b_first[self.a_group[of]] + np.arange(len(of)) - (ends - partner)[of]
        docs, codes, times = [self.a_doc[of]], [(self.a[of] << ID_BITS) | self.b[with_b]], [np.ones(len(of), np.int64)]
        for g in np.flatnonzero(large):
            a, na = np.unique(self.a[self.a_first[g] :][: self.a_size[g]], return_counts=True)
            b, nb = np.unique(self.b[self.b_first[g] :][: self.b_size[g]], return_counts=True)
            docs.append(np.full(len(a) * len(b), self.doc[g]))
            codes.append(((a << ID_BITS)[:, None] | b).ravel())
            times.append(np.outer(na, nb).ravel())
        return summed(*map(np.concatenate, (docs, codes, times)))

    def shown(self, a_text: np.ndarray, b_text: np.ndarray) -> np.ndarray:
        """Decimal ids with what follows them, in order of groups: the two texts
        of an id (within a group, at its side's end) stand one after the other."""
        out = np.empty(len(self.a) + len(self.b), object)
        last_a = np.append(self.a_group[1:] != self.a_group[:-1], True)
        last_b = np.append(self.b_group[1:] != self.b_group[:-1], True)
        out[np.arange(len(self.a)) + self.b_first[self.a_group]] = a_text[self.a * 2 + last_a]
        out[np.arange(len(self.b)) + (self.a_first + self.a_size)[self.b_group]] = b_text[self.b * 2 + last_b]
        return out


def summed(docs: np.ndarray, codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each (text, pair) once, in order, with its times added up."""
    if not len(docs):
        return docs, codes, times
    both = (docs << 2 * ID_BITS) | codes  # texts of a slice are far fewer than 2^23
    if (times == 1).all():
        both = np.sort(both)
        new = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
        times = np.diff(np.append(new, len(both)))
    else:
        order = np.argsort(both, kind="stable")
        both = both[order]
        new = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
        times = np.add.reduceat(times[order], new)
    both = both[new]
    return both >> 2 * ID_BITS, both & ((1 << 2 * ID_BITS) - 1), times


def id_texts(n: int, inner: str, last: str) -> np.ndarray:
    out = np.empty(2 * n, object)
    out[0::2] = [f"{i}{inner}" for i in range(n)]
    out[1::2] = [f"{i}{last}" for i in range(n)]
    return out


class Document:
    """What is known of a document whose pieces come one after the other."""

    def __init__(self):
        self.n_a = self.n_b = self.n_groups = self.n_links = 0
        self.digest = hashlib.sha256()
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []
        self.equal = True

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.equal or not self.pairs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        codes, times = map(np.concatenate, zip(*self.pairs))
        return summed(np.zeros(len(codes), np.int64), codes, times)[1:] if len(self.pairs) > 1 else (codes, times)


class Aligner:
    def __init__(self, tokenizer_json: str, model: bytes):
        self.a, self.b = byte_side(tokenizer_json), piece_side(model)

    def encoded(self, texts: list[str]) -> tuple[Aligned, list[bool]]:
        """Texts aligned at once, and whether both sides give their bytes; others
        have no tokens."""
        (a, a_equal), (b, b_equal) = self.a.tokens(texts), self.b.tokens(texts)
        equal = [x and y for x, y in zip(a_equal, b_equal)]
        a, b = ([i if ok else [] for i, ok in zip(side, equal)] for side in (a, b))

        def flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            return np.fromiter(chain.from_iterable(ids), np.int64, int(sizes.sum())), np.repeat(np.arange(len(ids)), sizes)

        (a, a_doc), (b, b_doc) = flat(a), flat(b)
        return Aligned(a, b, a_doc, b_doc, self.a.length, self.b.length), equal


def slices(texts: list[str | None], slice_chars: int, piece_chars: int) -> Iterator[tuple[list[int], list[str]]]:
    """(rows, pieces) to be aligned at once; null and empty texts have none."""
    rows, parts, chars = [], [], 0
    for row, text in enumerate(texts):
        for part in in_pieces(text, piece_chars) if text else ():
            rows.append(row)
            parts.append(part)
            chars += len(part)
            if chars >= slice_chars:
                yield rows, parts
                rows, parts, chars = [], [], 0
    if rows:
        yield rows, parts


ALIGNED = "row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"


def aligned(df: DataFrame, text: str, keep: list[str], tokenizer_json: str, model: bytes, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """Each document's alignment, one row or, with many distinct pairs, several:
    the counts and the columns `keep` stand in the first, null in the others."""
    schema = T.StructType(T.StructType.fromDDL("first boolean").fields + schema_with(df, keep, ALIGNED).fields)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        both = Aligner(tokenizer_json, model)
        a_text, b_text = id_texts(len(both.a.pieces), ",", "|"), id_texts(len(both.b.pieces), ",", ";")
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            documents = [Document() for _ in range(batch.num_rows)]
            for rows, parts in slices(batch.column(batch.num_columns - 1).to_pylist(), SLICE_CHARS, piece_chars):
                add_slice(documents, rows, *both.encoded(parts), a_text, b_text)
            for at in range(0, batch.num_rows, 200):
                yield written(batch.slice(at, 200), documents[at : at + 200], row + at, schema)
            row += batch.num_rows

    return text_batches(df).select(*keep, F.col(text).alias(free_name(df, "__text"))).mapInArrow(lean(work), schema)


def add_slice(documents: list[Document], rows: list[int], got: Aligned, equal: list[bool], a_text: np.ndarray, b_text: np.ndarray) -> None:
    n = len(rows)
    n_a, n_b = np.bincount(got.a_doc, minlength=n), np.bincount(got.b_doc, minlength=n)
    n_groups = np.bincount(got.doc, minlength=n)
    link_ends = np.append(0, np.cumsum(got.links))
    group_ends = np.append(0, np.cumsum(n_groups))
    shown, shown_ends = got.shown(a_text, b_text), np.append(0, np.cumsum(n_a + n_b))
    docs, codes, times = got.pairs()
    pair_ends = np.searchsorted(docs, np.arange(n + 1))
    for i, row in enumerate(rows):
        d = documents[row]
        d.equal &= equal[i]
        if not d.equal:
            continue
        d.digest.update(((";" if d.n_groups else "") + "".join(shown[shown_ends[i] : shown_ends[i + 1]].tolist())[:-1]).encode())
        d.n_a += int(n_a[i])
        d.n_b += int(n_b[i])
        d.n_groups += int(n_groups[i])
        d.n_links += int(link_ends[group_ends[i + 1]] - link_ends[group_ends[i]])
        d.pairs.append((codes[pair_ends[i] : pair_ends[i + 1]], times[pair_ends[i] : pair_ends[i + 1]]))


def written(batch: pa.RecordBatch, documents: list[Document], row: int, schema: T.StructType) -> pa.RecordBatch:
    take, values = [], {n: [] for n in ("first", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times")}
    for i, d in enumerate(documents):
        codes, times = d.distinct()
        some = d.equal and d.n_groups
        counts = (d.n_a, d.n_b, d.n_groups, d.n_links) if some else (0, 0, 0, 0)
        for at in range(0, max(len(codes), 1), ROW_PAIRS):
            first = at == 0
            take.append(i)
            whole = (first, row + i, *counts, d.digest.hexdigest() if some else "") if first else (first, row + i, *[None] * 5)
            for name, value in zip(values, (*whole, codes[at : at + ROW_PAIRS], times[at : at + ROW_PAIRS])):
                values[name].append(value)
    kept = [c.take(pa.array(take, pa.int64())) for c in batch.columns[:-1]]
    types = [pa.bool_(), *[pa.int64()] * 5, pa.string(), *[pa.list_(pa.int64())] * 2]
    columns = [pa.array(v, t) for v, t in zip(values.values(), types)]
    return pa.RecordBatch.from_arrays([columns[0], *kept, *columns[1:]], names=schema.names)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, count, best): in how many documents each id pair is linked, and
    whether no pair of its first id has more. A document has each pair once."""
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("count"))
    counts = stage(counts, "pair-counts")
    first = F.shiftright("pair", ID_BITS)
    top = counts.groupBy(first.alias("id")).agg(F.max("count").alias("top"))
    return counts.join(top, first == F.col("id")).select("pair", "count", (F.col("count") == F.col("top")).alias("best"))


def report(
    df: DataFrame, text: str, keep: list[str], tokenizer_json: str, model: bytes, piece_chars: int = PIECE_CHARS, broadcast_pairs: int = BROADCAST_PAIRS
) -> DataFrame:
    """The columns `keep`, n_a, n_b, n_groups, n_links, n_best, count_sum and
    groups_sha256, one row per row of `df`.

    Special tokens' strings are plain text. Null and empty texts, and those whose
    bytes one side doesn't give back, have zeros and an empty digest; such a text
    links nothing. Repeated rows and ids are documents of their own and count each.
    Pairs tied for an id's highest count are all best. Other columns aren't read;
    kept ones named like a result are refused.
    """
    schema_with(df, keep, "n_best long, count_sum long, first boolean")
    rows = stage(aligned(df, text, keep, tokenizer_json, model, piece_chars), "aligned")
    counts = stage(pair_counts(rows), "pairs")
    if counts.count() <= broadcast_pairs:
        counts = F.broadcast(counts)
    linked = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    linked = linked.select("row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times")).join(counts, "pair")
    sums = linked.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("count") * F.col("times")).alias("count_sum")
    )
    whole = rows.where("first").drop("first", "pairs", "times").join(sums, "row", "left")
    zero = F.lit(0).cast("long")
    results = [F.coalesce(c, zero).alias(c) for c in ("n_best", "count_sum")]
    return whole.select(*keep, "n_a", "n_b", "n_groups", "n_links", *results, "groups_sha256")


def groups(df: DataFrame, text: str, keep: list[str], tokenizer_json: str, model: bytes) -> DataFrame:
    """The columns `keep` and `groups`, an array of (start, end, a, b): byte range
    in the text with a space before it, and both sides' ids. Texts without tokens
    (see `report`) have an empty array. A document's groups make one row."""
    schema = schema_with(df, keep, "groups array<struct<start:long,end:long,a:array<int>,b:array<int>>>")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = Aligner(tokenizer_json, model)
        for batch in batches:
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            done, equal_yet = [0] * batch.num_rows, [True] * batch.num_rows
            for rows, parts in slices(batch.column(batch.num_columns - 1).to_pylist(), SLICE_CHARS, PIECE_CHARS):
                got, equal = both.encoded(parts)
                of = np.searchsorted(got.doc, np.arange(len(rows) + 1))
                for i, row in enumerate(rows):
                    equal_yet[row] &= equal[i]
                    base = done[row] - (int(got.a_start[got.a_first[of[i]]]) if of[i] < of[i + 1] else 0)
                    done[row] += len(parts[i].encode()) + 1
                    for g in range(of[i], of[i + 1]):
                        a0, b0, na, nb = got.a_first[g], got.b_first[g], got.a_size[g], got.b_size[g]
                        span = int(got.a_start[a0]) + base, int(got.a_end[a0 + na - 1]) + base
                        ids = got.a[a0 : a0 + na].tolist(), got.b[b0 : b0 + nb].tolist()
                        found[row].append(dict(zip(("start", "end", "a", "b"), (*span, *ids))))
            lists = [f if ok else [] for f, ok in zip(found, equal_yet)]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(lists, kind)], names=schema.names)

    return text_batches(df).select(*keep, F.col(text).alias(free_name(df, "__text"))).mapInArrow(lean(work), schema)
