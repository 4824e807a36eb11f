"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from delaylens.llm import bpe, decontaminate, hnsw, jaccard, langid, lm, preference, quality, queries, urlfilter, warc

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, score double, words string, row_key string, id long"
LONG = "une phrase assez longue de mots divers " * 3000


def documents(spark, rows):
    """Rows of (doc_id, text, lang), with columns whose names clash."""
    full = [(i, t, lang, "s", len(t or ""), 0.5, "w", "k", 7) for i, t, lang in rows]
    return spark.createDataFrame(full, DOCUMENTS)


ODD = [
    (1, "the cat sat on the mat and the dog sat on the rug today", "en"),
    (1, "the cat sat on the mat and the dog sat on the rug today", "en"),
    (None, "the cat sat on the mat and the dog sat on the rug today", "en"),
    (2, None, "en"),
    (3, "", None),
    (4, "12345 !!!", "en"),
    (5, LONG, "fr"),
    (6, "Été à la plage et <|endoftext|> voilà 𝔘𝔫𝔦 <|endoftext|><|endoftext|>", "fr"),
    (-7, " \n\t ", None),
    (8, "a", "en"),
    (8, "b", "en"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return documents(spark, ODD)


@pytest.fixture(scope="module")
def none(spark):
    return documents(spark, [])


def test_language_of_odd_rows(odd, none):
    net = langid.fit(odd, "text", "lang", "doc_id")
    rows = langid.identify(odd, "text", ["doc_id", "words", "row_key"], net).toPandas()
    assert len(rows) == len(ODD)
    undetermined = {2, 3, 4, -7}
    out = langid.identify(odd, "text", ["doc_id"], net).collect()
    assert all((r.lang_pred == "und") == (r.doc_id in undetermined) for r in out)
    assert all(0 <= r.score <= 1 for r in out)
    assert langid.fit(none, "text", "lang", "doc_id") is None
    assert {r.lang_pred for r in langid.identify(odd, "text", ["doc_id"], None).collect()} == {"und"}
    assert langid.identify(none, "text", ["doc_id"], net).count() == 0
    with pytest.raises(ValueError):
        langid.identify(odd, "text", ["doc_id", "score"], net)
    assert langid.determined(odd, "text", net).schema == odd.schema


def test_quality_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (4, 1, 0), (5, 0, 0), (None, 1, 0), (6, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(odd, labels, "text", "doc_id", "quality")
    out = quality.score(odd, "text", ["doc_id"], model).collect()
    assert len(out) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    for rows, marks in ((none, labels), (odd, labels.limit(0)), (odd, labels.where("quality = 1"))):
        untrained = quality.fit(rows, marks, "text", "doc_id", "quality")
        assert len({r.score for r in quality.score(odd, "text", ["doc_id"], untrained).collect()}) == 1
    assert quality.good(none, "text", model).count() == 0


def test_tokens_of_odd_rows(odd, none):
    from tokenizers import Tokenizer

    definition = bpe.public_tokenizer()
    plain = Tokenizer.from_str(definition)
    for shared in (0, 5, 1000):
        got = bpe.encode_digests(odd, "text", ["doc_id", "words"], definition, shared).collect()
        expected = []
        for i, text, _ in ODD:
            ids = plain.encode(text or "", add_special_tokens=False).ids
            decoded = plain.decode(ids, skip_special_tokens=False)
            expected.append((str(i), len(ids), sha(",".join(map(str, ids))), sha(decoded)))
        assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(expected)
    encoded = bpe.encode(odd, "text", ["doc_id", "text"], definition)
    assert bpe.decode(encoded, "ids", ["text"], definition).where("decoded <> coalesce(text, '')").count() == 0
    assert bpe.encode_digests(none, "text", ["doc_id"], definition).count() == 0


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_archives_of_odd_pages(spark, tmp_path):
    rows = [(5, "http://a/", "same"), (3, None, "same"), (9, "http://b/\r\nX: y", None), (8, "u", ""), (None, "n", "same"), (4, "z", "ü" * 60000), (3, "twice", "same")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, first_page string")
    out = warc.round_trip(pages, "page_id", "url", "html").collect()
    got = sorted((str(r.page_id), r.payload_bytes, r.record_type, str(r.refers_to)) for r in out)
    assert got == sorted([
        ("5", 4, "revisit", "3"), ("3", 4, "response", "None"), ("3", 4, "response", "None"), ("None", 4, "revisit", "3"),
        ("9", 0, "revisit", "8"), ("8", 0, "response", "None"), ("4", 120000, "response", "None"),
    ])
    assert all(r.payload_digest == warc.digest({4: b"same", 0: b"", 120000: ("ü" * 60000).encode()}[r.payload_bytes]) for r in out)
    apart = warc.round_trip(pages, "page_id", "url", "html", least=5)
    assert apart.where("record_type = 'revisit'").count() == 0
    assert warc.round_trip(pages.limit(0), "page_id", "url", "html").count() == 0


def test_archive_starts_with_its_dictionary(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"<html><body><p>page number {i} of the test, with some words {i * i}</p></body></html>" * 3) for i in range(600)]
    folder = f"file://{tmp_path}/warc"
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    written = warc.write(pages, "page_id", "url", "html", folder)
    assert written.agg(F.sum("records")).first()[0] == 600
    archive = next((tmp_path / "warc").glob("*.warc.zst")).read_bytes()
    assert archive[:4] == bytes.fromhex("5d2a4d18")
    for headers, block in warc.read_records(archive):
        page = warc.page_of(headers["warc-record-id"])
        assert block.endswith(rows[page][2].encode())
    assert warc.read(spark, folder).count() == 600


def test_scores_of_odd_rows(odd, none):
    rows = odd.withColumn("held_out", F.coalesce(F.col("doc_id") == 6, F.lit(False)))
    got = lm.score(rows, "text", "doc_id", "held_out", rows.where("not held_out"), shared_words=4, classes=3).collect()
    check_base(got, [(i, t, i == 6) for i, t, _ in ODD])
    assert all(r.score < 0 for r in got)
    unseen = lm.score(rows, "text", "doc_id", "held_out", rows.limit(0)).collect()
    assert len(unseen) == len(ODD) and all(r.base_score == 0 and r.n_known == 0 for r in unseen)
    assert lm.score(rows.limit(0), "text", "doc_id", "held_out", rows).count() == 0


def test_model_learns_from_every_text(spark):
    """What follows x in the fifth of the texts that a sample of 800 would take
    differs from what follows it in the others."""
    from delaylens.llm.common import unit_hash

    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit(False).alias("held_out"))
    training = rows.withColumn("text", F.when(unit_hash(F.col("doc_id")) < 0.22, F.repeat(F.lit("x z "), 12)).otherwise(F.repeat(F.lit("x y "), 12)))
    asked = spark.createDataFrame([(0, "x y x y", True), (1, "x z x z", True)], "doc_id long, text string, held_out boolean")
    got = {r.doc_id: r.score for r in lm.score(asked, "text", "doc_id", "held_out", training).collect()}
    assert got[0] > got[1]


def test_epoch_averages_all_tasks(spark):
    """Against learners that see one task's tokens each, weighed by their tokens."""
    rng = np.random.default_rng(3)
    parts = [[rng.integers(0, 6, n).astype(np.uint16) for n in sizes] for sizes in ((700, 1, 40), (300,))]
    unigram = np.full(6, 1 / 6)
    coded = spark.createDataFrame(spark.sparkContext.parallelize([(t.tobytes(),) for p in parts for t in p], 4).coalesce(1), "classes binary")
    first = lm.beginning(unigram)

    def learned(texts, seed):
        learner = lm.Learner(first, unigram, 0.01, seed)
        learner.learn(np.concatenate(texts).astype(np.int64), np.cumsum([0, *map(len, texts)])[:-1], 64)
        return lm.packed(learner.parameters)

    whole = lm.averaged(coded, first, unigram, 64, 0.01, [1, 0])
    assert lm.packed(whole) == pytest.approx(learned([t for p in parts for t in p], [1, 0, 0]), abs=1e-6)
    two = spark.createDataFrame(spark.sparkContext.parallelize(parts, 2).flatMap(lambda p: [(t.tobytes(),) for t in p]), "classes binary")
    expected = (741 * learned(parts[0], [1, 0, 0]) + 300 * learned(parts[1], [1, 0, 1])) / 1041
    assert lm.packed(lm.averaged(two, first, unigram, 64, 0.01, [1, 0])) == pytest.approx(expected, abs=1e-6)


def test_tokens_of_many_texts_at_once():
    """Arrow's tokens, places and tails against the plain ones, text by text."""
    from collections import Counter

    texts = ["", None, " ", "a", " A  b ", "x\x1cY\x85\u3000\xc9 z\x0b\x0cq\r\n\t", "".join(map(chr, range(128))) * 2, "rare b rare \xc9 Rare", "\u0130 \u03a3"]
    plain = [lm.tokens(t) for t in texts]
    found, length = lm.token_arrays(pa.array(["skipped", *texts])[1:])
    assert length.tolist() == [len(ws) for ws in plain] and found.to_pylist() == [w for ws in plain for w in ws]
    words = lm.Words({b"b": 1, b"a": 0, lm.END: 2}, np.ones(3), 5, np.ones(8), np.arange(8), np.zeros(8), 3, 3)
    ids, others, rare = lm.placed(found, words.shared(), words.slots)
    assert ids.tolist() == [words.of(w) for ws in plain for w in ws]
    tails = lm.times_in(np.searchsorted(np.cumsum(length), others, side="right"), rare, len(texts))
    assert [{r["word"]: r["times"] for r in tail} for tail in tails.to_pylist()] == [Counter(w for w in ws if words.of(w) >= 3) for ws in plain]
    none = lm.token_arrays(pa.array([], pa.string()))
    assert len(none[0]) == len(none[1]) == 0 and len(lm.placed(none[0], words.shared(), 5)[0]) == 0


def test_pairs_add_up_as_single_sums():
    rng = np.random.default_rng(4)
    at, values = rng.integers(0, 40, 3000), rng.normal(size=(3000, 16)).astype(np.float32)
    assert np.array_equal(lm.sums_in_pairs(lm.cells_of(at, 8), values, 50), lm.sums_at(at, values, 50))


def test_words_and_windows_of_odd_texts(spark):
    """Against a plain regular expression; a window's hash is the benchmark's, and
    no regular expression is tried word by word."""
    import re

    texts = ["", None, " ", "a", " A  b ", "-\xc9-\xe9,\xdf\u0663x--", "".join(map(chr, range(128))) * 2, "\U0001d518\U0001d52b ok\u3000x I\u0130", "\x7f\x00"]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    plain = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(lower)) for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = df.select("id", decontaminate.words(F.col("text")).alias("words"), F.size(decontaminate.cut(F.col("text"))).alias("n"))
    assert [(r.words, r.n) for r in got.orderBy("id").collect()] == [(ws, len(ws)) for ws in plain]
    assert "regexp_extract_all" not in got._jdf.queryExecution().optimizedPlan().toString()
    worded = got.select("id", decontaminate.word_hashes(F.col("words")).alias("hashes"))
    for length in (1, 2, 10):
        expected = {(r.item, r.phrase): r.hash for r in decontaminate.benchmark_windows(df, "id", "text", length).where(F.col("length") == length).collect()}
        found = {(r.id, " ".join(plain[r.id][r.start : r.start + length])): r.hash for r in decontaminate.window_hashes(worded, "id", length).collect()}
        assert found == expected


def test_classes_grow_with_the_words(spark):
    counts = spark.range(1_300_000).select(F.col("id").cast("string").cast("binary").alias("word"), (F.lit(1) + (F.col("id") < 1000).cast("long")).alias("n"))
    words, rare = lm.known_words(counts, 2000, None)
    assert lm.grown_classes(1_300_000) == 1140 and lm.grown_classes(10**9) == lm.MOST_CLASSES
    assert 1100 <= len(words.unigram()) <= 1140
    assert words.slots == lm.SLOTS and rare.count() == 1_299_000
    assert words.mass.sum() == 1_301_000 + 1_300_000 + 1 + words.slots  # every token, every word and the end once more, and one for the unseen of each slot
    rng = np.random.default_rng(2)
    near, far, vectors, bias = (rng.normal(0, 1, s).astype(np.float32) for s in ((8, 4), (8, 4), (7, 4), 7))
    table = lm.normaliser_table(spark, near, far, vectors, bias)
    assert table == pytest.approx(np.log(np.exp((near[:, None] + far[None]) @ vectors.T + bias).sum(axis=2)), abs=1e-4)


def check_base(got, rows):
    from collections import Counter
    from math import log10

    counts = Counter(w for _, t, out in rows if not out for w in lm.tokens(t))
    n, v = sum(counts.values()), len(counts)
    expected = [(str(i), len(ws := lm.tokens(t)), sum(counts[w] > 0 for w in ws), n, round(sum(log10((counts[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, t, _ in rows]
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == sorted(expected)


def test_links_of_odd_rows(odd, none):
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard.join(odd, "text", "doc_id", 4, 85).collect())
    n = len(jaccard.shingles(LONG, 4, {}))
    assert got == sorted([
        ("1", 11, "1"), ("1", 11, "1"), ("None", 11, "1"), ("2", 0, "2"), ("3", 0, "3"), ("4", 1, "4"), ("5", n, "5"),
        ("6", len(jaccard.shingles(ODD[7][1], 4, {})), "6"), ("-7", 0, "-7"), ("8", 1, "8"), ("8", 1, "8"),
    ])
    assert jaccard.join(none, "text", "doc_id").count() == 0
    kept = jaccard.one_of_each(odd, "text", "doc_id")
    assert kept.schema == odd.schema and kept.where("text like 'the cat%'").count() == 1 and kept.count() == len(ODD) - 2
    assert jaccard.one_of_each(none, "text", "doc_id").count() == 0


def test_hits_of_odd_rows(spark, odd, none):
    items = [(1, "Dog sat, on the RUG", "x"), (2, "on the rug today and more words here for a full window", "x"), (None, "cat sat on", "x"), (4, None, "x"), (5, "", "x"), (6, "b", "x")]
    benchmark = spark.createDataFrame(items, "item_id long, text string, hash string")
    got = {(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in decontaminate.report(odd, benchmark, "doc_id", "text", "item_id", "text").collect()}
    cat = sha("1")
    for i in (1, None):
        assert (i, 14, 8, 1, cat) in got
    assert (2, 0, 0, 0, sha("")) in got and (8, 1, 1, 1, sha("6")) in got and (8, 1, 0, 0, sha("")) in got
    cleaned = decontaminate.remove(odd, benchmark, "doc_id", "text", "item_id", "text", length="n_chars")
    assert cleaned.schema == odd.schema and cleaned.count() == len(ODD) - 1  # "b" is nothing but an item
    assert {r.text for r in cleaned.where("doc_id = 1").collect()} == {"the the mat and the today"}
    assert decontaminate.report(odd, benchmark.limit(0), "doc_id", "text", "item_id", "text").where("contaminated").count() == 0
    assert decontaminate.report(none, benchmark, "doc_id", "text", "item_id", "text").count() == 0


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 7), 1.0, 0.5]) for i in range(60)]
    rows += [(100, None), (101, [0.0, 0.0, 0.0]), (102, [nan, 1.0, 1.0]), (103, [inf, 1.0, 1.0]), (104, [None, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (20, [9.0, 9.0, 9.0]), (105, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int")
    got = hnsw.search(df, "vec_id", "embedding", F.col("id") % 20 == 0, 5).collect()
    vectors = {i: v for i, v in rows[:60]}
    vectors[20] = min(vectors[20], [9.0, 9.0, 9.0])
    for q in (0, 20, 40):
        near = sorted((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q)[:5]
        assert [(r.rank, r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == [(k + 1, i, -s) for k, (s, i) in enumerate(near)]
    assert hnsw.search(df.limit(0), "vec_id", "embedding", F.col("id") % 20 == 0, 5).count() == 0
    few = hnsw.search(df.where("vec_id < 3"), "vec_id", "embedding", F.col("id") % 20 == 0, 5)
    assert [r.vec_id for r in few.orderBy("rank").collect()] == [1, 2]


def test_verdicts_and_links(spark):
    pages = spark.createDataFrame(
        [
            (1, "http://A.linker.org/q?x", "<a href='http://bad.net/'>x</a>", "r"),
            (2, "https://bad.net/es/x?y", None, "r"),
            (3, None, "<a href=//bad.net/>", "r"),
            (4, "no scheme", "x", "r"),
            (5, "http://www.example.com", "", "r"),
            (6, "http://www.example.com/en/1#f", "", "r"),
            (7, "http://b.example.com/en/1", "", "r"),
            (8, "http://xcom/", "", "r"),
            (2, "https://bad.net/es/x?y", None, "r"),
        ],
        "page_id long, url string, html string, rule string",
    )
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(pages, queries.RULES, "page_id", "url", "html").collect()}
    assert got == {
        (1, "a.linker.org", "/q", None, "block"),  # all its links go to a blocked host
        (2, "bad.net", "/es/x", "net/es/", "block"),
        (3, "", "", None, "allow"),
        (4, "", "", None, "allow"),
        (5, "www.example.com", "", None, "allow"),
        (6, "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        (7, "b.example.com", "/en/1", "example.com/en/", "block"),
        (8, "xcom", "/", None, "allow"),
    }
    assert urlfilter.judge(pages.limit(0), queries.RULES, "page_id", "url", "html").count() == 0


def test_linkers_of_one_blocked_host(spark):
    """All that link only to it are blocked, however many and however large they
    are; one with few of its links there is not."""
    bad = "<a href='http://bad.net/'>x</a>"
    links = [(f"small{i}.org", bad) for i in range(40)] + [("large.org", bad)] * 300
    links += [("some.org", bad)] + [("some.org", f"<a href='http://fine{i}.org/'>x</a>") for i in range(4)]
    links += [("next.org", "<a href='//small7.org/'>x</a>"), ("none.org", None)]
    rows = [(0, "https://bad.net/es/x", None), *((i, f"http://{h}/{i}", html) for i, (h, html) in enumerate(links, 1))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.host: r.verdict for r in urlfilter.judge(pages, queries.RULES, "page_id", "url", "html").collect()}
    assert {h for h, v in got.items() if v == "allow"} == {"some.org", "none.org"}
    assert got["large.org"] == got["next.org"] == "block" and len(got) == 45


def test_propagation_by_hand(spark):
    """Two rounds on three hosts against the sums worked out plainly."""
    seeds = spark.createDataFrame([("a", 1.0, 0.0), ("c", 0.0, 1.0)], "host string, trust double, distrust double")
    edges = spark.createDataFrame([("a", "b", 3.0), ("a", "c", 1.0), ("b", "c", 1.0)], "source string, target string, weight double")
    got = {r.host: (r.trust, r.distrust) for r in urlfilter.propagate(seeds, edges, rounds=2, damping=0.5).collect()}
    trust = {"a": 0.5, "b": 0.5 * 0.75 * 0.5, "c": 0.5 * (0.25 * 0.5 + 0.5 * 0.75 * 0.5)}
    distrust = {"c": 0.5, "a": 0.5 * (0.5 * 0.5 + 0.5 * 0.5 * 0.5), "b": 0.5 * 0.5 * 0.5}
    for h in "abc":
        assert got[h] == pytest.approx((trust[h], distrust[h]))


def test_pairs_of_odd_turns(spark):
    turn = "array<struct<turn:bigint,role:string,text:string>>"
    pairs = spark.createDataFrame(
        [
            (1, [(0, "user", "hi"), (1, "assistant", "yes"), (2, "user", "ok")], [(0, "user", "hi"), (1, "assistant", "no")]),
            (2, [(0, "user", "x")], [(0, "user", "x")]),
            (3, None, [(0, "assistant", "")]),
            (4, [(0, "user", "q"), (1, "assistant", "a")], [(0, "user", "q"), (1, "assistant", "a"), (2, "assistant", "b")]),
        ],
        f"conv_id long, chosen {turn}, rejected {turn}",
    )
    got = {r.conv_id: r for r in preference.format_pairs(pairs, "conv_id").collect()}
    assert (got[1].n_prompt_turns, got[1].prompt) == (1, "<|im_start|>user\nhi<|im_end|>\n")
    assert got[1].chosen == "<|im_start|>assistant\nyes<|im_end|>\n<|im_start|>user\nok<|im_end|>\n"
    assert [got[1].chosen[a:b] for a, b in got[1].chosen_spans] == ["yes<|im_end|>"]
    assert [got[1].rejected[a:b] for a, b in got[1].rejected_spans] == ["no<|im_end|>"]
    assert (got[2].n_prompt_turns, got[2].chosen, got[2].rejected) == (1, "", "")
    assert (got[3].n_prompt_turns, got[3].chosen) == (0, "") and got[3].rejected_spans == [(22, 32)]
    assert (got[4].n_prompt_turns, got[4].chosen) == (2, "")
    rows = [(1, 0, "user", None), (1, 1, "assistant", "b"), (1, 1, "assistant", "b"), (None, 0, "assistant", "c"), (2, 0, None, "z"), (3, 0, "assistant", "s")]
    made = preference.swapped_replies(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), "conv_id", "turn", "role", "text")
    assert {(r.conv_id, r.chosen[-1].text, r.rejected[-1].text) for r in made.collect()} == {(1, "b", ""), (3, "s", "")}


def test_near_copies_go_by_the_key_as_its_type_orders_it(spark):
    said = "one two three four five six seven eight nine ten eleven twelve"
    long_ids = [("a" * 20 + "1", ""), ("a" * 20 + "2", ""), ("b", said), (None, said), ("null", said)]
    df = spark.createDataFrame([(i, t, "mine", "yours") for i, t in long_ids], "id string, text string, __tag string, tag string")
    kept = jaccard.one_of_each(df, "text", "id")
    assert kept.schema == df.schema
    assert sorted(r.id for r in kept.collect()) == ["a" * 20 + "1", "a" * 20 + "2", "b"]
    assert {r["__tag"] for r in kept.collect()} == {"mine"}
    numbers = spark.createDataFrame([(2, said), (-5, said), (-3, said), (10, said), (None, said)], "id long, text string")
    assert [r.id for r in jaccard.one_of_each(numbers, "text", "id").collect()] == [-5]


def test_spans_go_whatever_the_columns_are_called(spark):
    df = spark.createDataFrame([(1, "x dog sat on the rug y", 7, "k"), (2, "clean", 8, "l")], "id long, text string, __hit long, __key string")
    benchmark = spark.createDataFrame([(1, "dog sat on the rug")], "item_id long, text string")
    out = {r.id: r for r in decontaminate.remove(df, benchmark, "id", "text", "item_id", "text").collect()}
    assert out[1].text == "x y" and (out[1]["__hit"], out[1]["__key"], out[2]["__hit"]) == (7, "k", 8)


def test_pipeline_of_odd_rows(spark, odd, tmp_path):
    spark.createDataFrame([(1, 1, 0), (5, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "dog sat on the rug")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clashing = {"__tag": F.lit(1), "__hit": F.lit(2), "__key": F.lit("k"), "__text": F.lit("t"), "tag": F.lit("u"), "row_key": F.lit("v")}
    plain = odd.select("doc_id", "text", "lang", "source", "n_chars").withColumns(clashing)
    for rows in (plain, plain.limit(0)):
        docs = rows
        for _, step in corpus_pipeline.STAGES[:-1]:
            docs = step(spark, docs, str(tmp_path))
            assert docs.schema == plain.schema
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()


