"""BPE encoding and decoding through tables of distinct words.

Spark's regular expressions cut each text into the tokenizer's words. A first
pass counts the words of all texts; the most frequent ones are encoded once for
the whole job and form a table of bounded size that every task gets. A second
pass joins the ids back: within an Arrow batch the words are dictionary-encoded,
so each distinct word is looked up (or, if it is not in the shared table,
encoded once by the task) and ids return to their positions by a gather. Nothing
but the word counts is shuffled. Decoding joins ids to pieces by position in the
vocabulary table, from the ids alone.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylens.llm.common import lean, most_frequent, schema_with, single_threaded, text_batches
from delaylens.session import stage

# Fixed value: the word pattern of byte-level BPE.
WORDS = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words in the table that every task gets; about 10 MB.
SHARED_WORDS = 200_000
#: Words that a task holds beside the shared ones before it starts anew.
TASK_WORDS = 200_000
#: Words encoded in one call of the tokenizer.
ENCODE_AT_ONCE = 4096


def public_tokenizer(name: str = "byte_bpe_50k.json") -> str:
    """A public tokenizer's definition, read once on the driver."""
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_text(encoding="utf-8")


@lru_cache(maxsize=4)
def load(tokenizer_json: str):
    """The tokenizer without truncation and padding."""
    single_threaded()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_json)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def special_tokens(tokenizer_json: str) -> list[str]:
    return [t["content"] for t in json.loads(tokenizer_json).get("added_tokens") or []]


def byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others for the characters from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def id_pieces(tokenizer_json: str) -> list[bytes]:
    """The id-to-piece table: the bytes of each id, at its position."""
    alphabet = byte_of_char()
    vocabulary = load(tokenizer_json).get_vocab(with_added_tokens=True)
    pieces = [b""] * (max(vocabulary.values(), default=-1) + 1)
    for piece, i in vocabulary.items():
        # as the byte-level decoder: a piece with a foreign character is its own text
        known = all(c in alphabet for c in piece)
        pieces[i] = bytes(alphabet[c] for c in piece) if known else piece.encode()
    return pieces


def words_of(text: Column, specials: list[str]) -> Column:
    """The text's words in order; special tokens stand alone. Null: none."""

    def cut(part: Column) -> Column:
        return F.regexp_extract_all(part, F.lit(WORDS), F.lit(0))

    text = F.coalesce(text, F.lit(""))
    if not specials:
        return cut(text)
    either = "|".join(re.escape(s) for s in sorted(specials, key=len, reverse=True))
    parts = F.split(text, f"(?={either})|(?<={either})")
    apart = F.transform(parts, lambda p: F.when(p.isin(specials), F.array(p)).otherwise(cut(p)))
    has_special = F.lit(False)
    for s in specials:
        has_special = has_special | F.contains(text, F.lit(s))
    return F.when(has_special, F.flatten(apart)).otherwise(cut(text))


def word_counts(words: DataFrame) -> DataFrame:
    """(word, n) over all rows of a column `words`; a task sums its batches up
    first, as long as they are few words."""

    def sums(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(parts).group_by("word").aggregate([("n", "sum")])
        return pa.RecordBatch.from_arrays([whole.column(c).combine_chunks() for c in ("word", "n_sum")], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.RecordBatch] = []
        for batch in batches:
            found = pc.value_counts(batch.column(0).flatten())
            parts.append(pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["word", "n"]))
            if sum(p.num_rows for p in parts) > TASK_WORDS:
                parts = [sums(parts)]
                if parts[0].num_rows > TASK_WORDS // 2:
                    yield parts.pop()
        if parts:
            yield sums(parts)

    return words.select("words").mapInArrow(lean(count), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def encode_each(tokenizer, words: list[str]) -> list[list[int]]:
    parts = (words[at : at + ENCODE_AT_ONCE] for at in range(0, len(words), ENCODE_AT_ONCE))
    return [e.ids for part in parts for e in tokenizer.encode_batch(part, add_special_tokens=False)]


def encode_words(words: DataFrame, tokenizer_json: str) -> DataFrame:
    """(word, ids): each row's word encoded on its own."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(tokenizer_json)
        for batch in batches:
            text = batch.column(0).to_pylist()
            lists = pa.array(encode_each(tokenizer, text), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["word", "ids"])

    return words.select("word").mapInArrow(lean(encode), "word string, ids array<int>")


def shared_table(words: DataFrame, tokenizer_json: str, shared_words: int) -> tuple[pa.Array, pa.Array]:
    """The most frequent words of all rows and their ids; `shared_words` bounds
    what the driver gets and every task is sent."""
    frequent = most_frequent(stage(word_counts(words), "words"), shared_words)
    got = encode_words(frequent, tokenizer_json).toArrow().combine_chunks()
    if not got.num_rows:
        return pa.array([], pa.string()), pa.array([], pa.list_(pa.int32()))
    return got.column("word").chunk(0), got.column("ids").chunk(0)


class WordTable:
    """Distinct words with their ids: flat ids, and each word's start and length."""

    def __init__(self, tokenizer_json: str, words: pa.Array, ids: pa.Array):
        self.tokenizer = load(tokenizer_json)
        self.shared = words, ids
        self.restart()

    def restart(self) -> None:
        words, ids = self.shared
        self.slot = dict(zip(words.to_pylist(), range(len(words))))
        self.flat = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
        self.length = pc.list_value_length(ids).to_numpy(zero_copy_only=False).astype(np.int64)
        self.start = np.cumsum(self.length) - self.length

    def slots(self, words: list[str]) -> np.ndarray:
        """Places of distinct words; unknown ones are encoded and added."""
        if len(self.slot) > len(self.shared[0]) + TASK_WORDS:
            self.restart()
        new = [w for w in words if w not in self.slot]
        if new:
            ids = encode_each(self.tokenizer, new)
            length = np.fromiter(map(len, ids), np.int64, len(ids))
            first = len(self.flat)
            self.slot.update(zip(new, range(len(self.length), len(self.length) + len(new))))
            self.flat = np.concatenate([self.flat, np.fromiter((i for x in ids for i in x), np.int32, int(length.sum()))])
            self.start = np.concatenate([self.start, first + np.cumsum(length) - length])
            self.length = np.concatenate([self.length, length])
        return np.fromiter(map(self.slot.__getitem__, words), np.int64, len(words))


def ids_by_position(words: pa.Array, table: WordTable) -> tuple[np.ndarray, np.ndarray]:
    """All rows' ids, flat, and each row's end: a gather from the word table."""
    flat = words.flatten()
    if len(flat):
        coded = pc.dictionary_encode(flat)
        slot = table.slots(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)]
    else:
        slot = np.zeros(0, np.int64)
    length = table.length[slot]
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    ids = table.flat[np.repeat(table.start[slot] - (ends - length), length) + np.arange(total)]
    word_ends = np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False))
    return ids, np.concatenate([[0], ends])[word_ends]


class SharedWords:
    """A frame's texts cut into words, and the table of its frequent words."""

    def __init__(self, df: DataFrame, text: str, keep: list[str], tokenizer_json: str, shared_words: int):
        self.split = text_batches(df).select(*keep, words_of(F.col(text), special_tokens(tokenizer_json)).alias("__words"))
        self.words, self.ids = shared_table(self.split.select(F.col("__words").alias("words")), tokenizer_json, shared_words)
        self.tokenizer_json = tokenizer_json

    def joined(self, schema, values) -> DataFrame:
        """The kept columns and the arrays that `values` makes of each batch's
        flat ids and row ends."""
        words, ids, definition = self.words, self.ids, self.tokenizer_json

        def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = WordTable(definition, words, ids)
            for whole in batches:
                for at in range(0, whole.num_rows, 500):
                    batch = whole.slice(at, 500)
                    flat, ends = ids_by_position(batch.column(batch.num_columns - 1), table)
                    yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *values(flat, ends)], names=[f.name for f in schema])

        return self.split.mapInArrow(lean(join), schema)


def encode(df: DataFrame, text: str, keep: list[str], tokenizer_json: str, shared_words: int = SHARED_WORDS) -> DataFrame:
    """The columns `keep` and `ids` array<int>: each text's token ids.

    Null and empty texts have no ids; repeated rows stay; other columns are
    not read."""

    def lists(flat: np.ndarray, ends: np.ndarray) -> list[pa.Array]:
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))]

    schema = schema_with(df, keep, "ids array<int>")
    return SharedWords(df, text, keep, tokenizer_json, shared_words).joined(schema, lists)


def decode_bytes(ids: list[int], pieces: list[bytes]) -> bytes:
    """The UTF-8 bytes of the decoded text; broken sequences are replaced."""
    raw = b"".join(map(pieces.__getitem__, ids))
    return raw.decode("utf-8", "replace").encode()


def decode(df: DataFrame, ids: str, keep: list[str], tokenizer_json: str) -> DataFrame:
    """The columns `keep` and `decoded` string. Null ids give an empty text."""
    schema = schema_with(df, keep, "decoded string")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = id_pieces(tokenizer_json)
        for batch in batches:
            text = [decode_bytes(x or [], pieces).decode() for x in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(text, pa.string())], names=[*keep, "decoded"])

    return df.select(*keep, F.col(ids).alias("__ids")).mapInArrow(lean(join), schema)


def encode_digests(df: DataFrame, text: str, keep: list[str], tokenizer_json: str, shared_words: int = SHARED_WORDS) -> DataFrame:
    """The columns `keep`, n_tokens, ids_sha256 (decimal ids joined by commas)
    and decoded_sha256 (the text decoded from those ids, in UTF-8): encode and
    decode in one pass, for checking round trips without moving the ids."""
    pieces = id_pieces(tokenizer_json)
    decimal = [str(i) for i in range(len(pieces))]

    def digest(flat: np.ndarray, ends: np.ndarray) -> list[pa.Array]:
        rows = [x.tolist() for x in np.split(flat, ends[:-1])] if len(ends) else []
        return [
            pa.array([len(x) for x in rows], pa.int64()),
            pa.array([hashlib.sha256(",".join(map(decimal.__getitem__, x)).encode()).hexdigest() for x in rows], pa.string()),
            pa.array([hashlib.sha256(decode_bytes(x, pieces)).hexdigest() for x in rows], pa.string()),
        ]

    schema = schema_with(df, keep, "n_tokens long, ids_sha256 string, decoded_sha256 string")
    return SharedWords(df, text, keep, tokenizer_json, shared_words).joined(schema, digest)
