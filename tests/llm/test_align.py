"""Token alignment against a plain walk over bytes; odd rows."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from delaylens.llm import align, bpe, queries

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def files():
    return bpe.public_tokenizer(), align.public_model()


def plain_groups(text, files):
    """[(a ids, b ids)] by walking both token lists to common ends."""
    import sentencepiece
    from tokenizers import Tokenizer

    if not text:
        return []
    tokenizer = Tokenizer.from_str(files[0])
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_proto=files[1])
    alphabet = bpe.byte_of_char()
    encoded = tokenizer.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(alphabet[c] for c in p)) for i, p in zip(encoded.ids, encoded.tokens)]
    b = [(i, align.piece_bytes(model.id_to_piece(i))) for i in model.encode(text)]
    whole = (" " + text).encode()
    if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return []
    out, place = [], [0, 0]
    lists = [a[::-1], b[::-1]]
    while lists[0]:
        group = ([], [])
        while not group[0] or not group[1] or place[0] != place[1]:
            side = 0 if place[0] <= place[1] else 1
            i, piece = lists[side].pop()
            group[side].append(i)
            place[side] += len(piece)
        out.append(group)
    return out


def plain_report(texts, files):
    grouped = [plain_groups(t, files) for t in texts]
    links = [Counter((a, b) for g in groups for a in g[0] for b in g[1]) for groups in grouped]
    counts = Counter(p for found in links for p in found)
    top = {}
    for (a, _), n in counts.items():
        top[a] = max(top.get(a, 0), n)
    for groups, found in zip(grouped, links):
        shown = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        yield (
            sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), sum(found.values()),
            sum(n for p, n in found.items() if counts[p] == top[p[0]]), sum(n * counts[p] for p, n in found.items()),
            hashlib.sha256(shown.encode()).hexdigest() if groups else "",
        )


ODD = [
    None, "", " ", "a", "the cat", "the cat", "  two  spaces\n\nand\tlines ", "<|endoftext|> <s> </s> <unk>", "▁mark", "été 𝔘𝔫𝔦 日本語 🙂🙂",
    "x" * 3000, "1234567890 " * 40, "don't we'll \x00 nul", "naïve café", "words and words and more " * 2000,
]


def test_query(spark, files):
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in queries.QUERIES["op13_tokenizer_alignment"](spark, SF_DIR).collect()}
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    assert len(got) == len(documents)
    for r, want in zip(documents, plain_report([r.text for r in documents], files)):
        assert got[r.doc_id] == want


@pytest.mark.parametrize("options", [{}, {"piece_chars": 40, "broadcast_pairs": 0}])
def test_odd_rows(spark, files, options):
    rows = [(i if i != 5 else 4, t, 1, 2, "s") for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "id long, text string, pair long, row long, first string").repartition(3)
    out = align.report(df, "text", ["id"], *files, **options)
    got = sorted(tuple(r) for r in out.collect())
    assert got == sorted((r[0], *want) for r, want in zip(rows, plain_report(ODD, files)))
    assert align.report(df.limit(0), "text", ["id"], *files).count() == 0
    assert align.report(df, "text", ["id", "pair"], *files).columns == ["id", "pair", *COLUMNS]
    with pytest.raises(ValueError):
        align.report(df, "text", ["id", "row"], *files)


def test_groups_are_byte_ranges(spark, files, monkeypatch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "id long, text string")
    for r in align.groups(df, "text", ["id"], *files).collect():
        want = plain_groups(ODD[r.id], files)
        assert [(g.a, g.b) for g in r.groups] == want
        at = 0
        for g in r.groups:
            assert g.start == at and g.end > at
            at = g.end
        assert not want or at == len((" " + ODD[r.id]).encode())


def test_large_groups_and_rows(monkeypatch):
    rng = np.random.default_rng(3)
    length = np.array([1, 2, 3])
    tokens = [rng.integers(0, 3, 400) for _ in range(2)]
    tokens = [np.append(t, np.zeros(max(0, length[tokens[1 - i]].sum() - length[t].sum()), np.int64)) for i, t in enumerate(tokens)]
    zero = [np.zeros(len(t), np.int64) for t in tokens]
    small = align.Aligned(*tokens, *zero, length, length)
    found = [x.tolist() for x in small.pairs()]
    monkeypatch.setattr(align, "LARGE_GROUP", 2)
    assert [x.tolist() for x in small.pairs()] == found
    ends = [np.cumsum(length[t]) for t in tokens]
    starts = [e - length[t] for e, t in zip(ends, tokens)]
    overlap = [(i, j) for i in range(len(tokens[0])) for j in range(len(tokens[1])) if starts[0][i] < ends[1][j] and starts[1][j] < ends[0][i]]
    assert list(zip(*small.overlaps.tolist())) == overlap
