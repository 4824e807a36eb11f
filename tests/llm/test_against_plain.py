"""The registered queries against plain versions over the smallest tables."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from delaylens.llm import bpe, jaccard, lm, queries, urlfilter

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    return {t: spark.read.parquet(f"{SF_DIR}/{t}.parquet").collect() for t in ("documents", "labels", "pages", "embeddings", "benchmark")}


def fold(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus == 2


def test_languages_held_out(spark, rows):
    got = {r.doc_id: r for r in queries.QUERIES["op1_language_id"](spark, SF_DIR).collect()}
    out = [r for r in rows["documents"] if fold(r.doc_id, 4)]
    assert len(got) == len(rows["documents"]) and all(got[r.doc_id].held_out == fold(r.doc_id, 4) for r in rows["documents"])
    assert sum(got[r.doc_id].lang_pred == r.lang for r in out) >= 0.95 * len(out)


def test_quality_held_out(spark):
    """Over the next larger tables, for a class has few labels here."""
    larger = SF_DIR.replace("0.001", "0.01")
    scored = queries.QUERIES["op2_quality_compression"](spark, larger).where("held_out")
    labels = spark.read.parquet(f"{larger}/labels.parquet")
    out = scored.join(labels, "doc_id").collect()
    assert sum(r.predicted == r.quality for r in out) >= 0.93 * len(out)


def test_tokens(spark, rows):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_str(bpe.public_tokenizer())
    got = {r.doc_id: r for r in queries.QUERIES["op4_bpe_word_table"](spark, SF_DIR).collect()}
    for r in rows["documents"]:
        ids = plain.encode(r.text or "", add_special_tokens=False).ids
        text = plain.decode(ids, skip_special_tokens=False)
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_archives(spark, rows):
    got = {r.page_id: r for r in queries.QUERIES["op5_warc_dictionary"](spark, SF_DIR).collect()}
    first = {}
    for r in sorted(rows["pages"], key=lambda r: r.page_id):
        first.setdefault(r.html, r.page_id)
    for r in rows["pages"]:
        raw = (r.html or "").encode()
        revisit = first[r.html] != r.page_id
        assert tuple(got[r.page_id])[1:] == (
            len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", first[r.html] if revisit else None,
        )


def test_neighbours(spark, rows):
    got = queries.QUERIES["op6_hnsw_search"](spark, SF_DIR).toPandas()
    ids = np.array([r.vec_id for r in rows["embeddings"]])
    x = np.array([r.embedding for r in rows["embeddings"]], float)
    assert recall(got, ids, x) == 1.0


def recall(got, ids, x):
    found = total = 0
    for q in np.nonzero(ids % 20 == 0)[0]:
        score = x @ x[q]
        score[q] = -np.inf
        best = ids[np.lexsort((ids, -score))[:20]]
        mine = got[got.query_id == ids[q]].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 21)) and (np.diff(mine.score) <= 0).all()
        found += len(set(best) & set(mine.vec_id))
        total += 20
    return found / total


def test_graph_recall():
    """A graph that isn't scanned: clusters, a run of near-equal vectors, unequal lengths."""
    from delaylens.llm import hnsw

    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(0, 1, (3000, 24)) + rng.normal(0, 2, (30, 24)).repeat(100, axis=0), rng.normal(0, 1e-3, (800, 24)) + 1])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[:3000] *= rng.uniform(0.8, 1.2, (3000, 1))
    x = x.astype(np.float32)
    graph, order = hnsw.build(x)
    queries_at = rng.choice(len(x), 200, replace=False)
    found = graph.search(np.column_stack([x[queries_at], np.zeros(200)]).astype(np.float32), hnsw.SEARCH_BEAM)
    hits = 0
    for q, ids in zip(queries_at, found, strict=True):
        hits += len(set(np.argsort(-(x @ x[q]))[:20]) & set(order[ids[:20]]))
    assert hits >= 0.9 * 200 * 20


def test_scores(spark, rows):
    got = {r.doc_id: r for r in queries.QUERIES["op7_lm_scoring"](spark, SF_DIR).collect()}
    counts = Counter(w for r in rows["documents"] if not fold(r.doc_id, 7) for w in lm.tokens(r.text))
    n, v = sum(counts.values()), len(counts)
    for r in rows["documents"]:
        words = lm.tokens(r.text)
        mine = got[r.doc_id]
        assert (mine.held_out, mine.n_tokens, mine.n_known, mine.train_tokens) == (fold(r.doc_id, 7), len(words), sum(counts[w] > 0 for w in words), n)
        assert mine.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words))
    out = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_scores_follow_the_parameters(spark):
    """Token by token: softmax over all classes, softmax over the class's places,
    and a rare word's share of its slot, worked out from the fitted parameters."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"{'ab'[i % 2]}{min(int(x), 90)}" for x in rng.zipf(1.3, 60)) for i in range(120)]
    rows = spark.createDataFrame([(i, t, i % 5 == 0) for i, t in enumerate(texts)], "doc_id long, text string, held_out boolean")
    training = rows.where("not held_out")
    counts = lm.token_counts(training, "text").cache()
    words, rare = lm.known_words(counts, 40, 12)
    model = lm.fit(training, "text", words)
    got = {r.doc_id: r.score for r in lm.scored(rows, "text", "doc_id", "held_out", words, rare, model).collect()}
    n = {bytes(r.word): r.n for r in counts.collect()}
    several = [int((words.classes == c).sum()) > 1 for c in range(len(words.unigram()))]
    start, shared = len(several), len(words.counts)
    assert sum(several) > 1 and words.slots > 1 and not model.vectors[[i for i, c in enumerate(words.classes) if not several[c]]].any()

    def softmax(x):
        e = np.exp(x - x.max())
        return e / e.sum()

    def chance(far, near, place):
        of = words.classes[place]
        p = softmax(model.outer.vectors.astype(float) @ (model.outer.near[near] + model.outer.far[far]) + model.outer.bias)[of]
        if several[of]:
            clear = far if near < start and several[near] and not (far < start and several[far]) else near
            members = np.flatnonzero(words.classes == of)
            p *= softmax(model.vectors[members].astype(float) @ model.features[clear] + model.bias[members])[list(members).index(place)]
        return p

    for i, t in enumerate(texts):
        total, far, near = 0.0, start, start
        for w in lm.tokens(t):
            place = words.of(w)
            total += math.log10(chance(far, near, place))
            if place >= shared:
                total += math.log10((n.get(w, 0) + 1) / words.mass[place])
            far, near = near, words.classes[place]
        assert got[i] == pytest.approx(total, abs=1e-3)
    every = np.arange(len(words.mass))
    for far, near in ((start, start), (start, 0), (3, 7), (7, 11)):
        p = np.exp(model.log_probability(np.full(len(every), far), np.full(len(every), near), every))
        assert p.sum() == pytest.approx(1, abs=1e-4)


def test_places_learn_their_contexts():
    """Two places of one class that follow one context each."""
    x = np.array([[2.0, 0], [0, 2.0]], np.float32)
    inside = lm.Inside(np.array([50.0, 50.0]), x, [1, 0])
    context = np.random.default_rng(1).integers(0, 2, 20_000)
    inside.learn(context, context)
    logs = inside.vectors @ x.T + inside.bias[:, None] - inside.normalisers()
    assert np.exp(logs).sum(axis=0) == pytest.approx(1, abs=1e-5)
    assert np.exp(logs[0, 0]) > 0.7 and np.exp(logs[1, 1]) > 0.7


def test_model_is_normalised():
    rng = np.random.default_rng(1)
    classes = rng.choice(6, 4000, p=[0.4, 0.3, 0.1, 0.1, 0.05, 0.05])
    classes[1::2] = classes[::2]  # every second word repeats the one before
    model = lm.train(classes, np.array([0, 2000]), np.bincount(classes, minlength=6) / 4000)
    every = np.arange(6)
    for far in range(7):
        for near in range(7):
            p = np.exp(model.log_probability(np.full(6, far), np.full(6, near), every))
            assert p.sum() == pytest.approx(1, abs=1e-4)
    assert np.exp(model.log_probability(np.array([1]), np.array([5]), np.array([5])))[0] > 0.2


def plain_components(texts, width=4, percent=85):
    """{row: (set size, smallest row reached)} by comparing all pairs that share a shingle."""
    sets = []
    for t in texts.values():
        words = (t or "").encode().lower().split()
        n = min(width, len(words))
        sets.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set())
    ids, at = list(texts), {}
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in at.get(x, ()))
        for j, both in shared.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b, key=lambda k: ids[k])] = min(a, b, key=lambda k: ids[k])
        for x in s:
            at.setdefault(x, []).append(i)
    return {ids[i]: (len(s), ids[root(i)]) for i, s in enumerate(sets)}


def test_links(spark, rows):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.QUERIES["op8_ngram_jaccard_join"](spark, SF_DIR).collect()}
    assert got == plain_components({r.doc_id: r.text for r in rows["documents"]})


def test_links_of_small_sets_and_groups(spark):
    """Sizes around the boundary, near copies in chains and groups, shared passages."""
    rng = np.random.default_rng(3)
    texts = {}

    def add(words):
        texts[len(texts)] = " ".join(words)

    for size in [*range(4, 24)] * 3:
        words = [f"w{x}" for x in rng.integers(0, 10**6, size)]
        add(words)
        add(words[: len(words) - 1])
        add([*words, "more"])
        add([*words[1:], "end", "here"])
    base = [f"b{i}" for i in range(120)]
    for i in range(60):
        copy = list(base)
        copy[int(rng.integers(0, 120))] = f"changed{i}"
        add(copy)
    for _ in range(40):
        add([*[f"q{x}" for x in rng.integers(0, 10**6, 60)], *base[:50]])
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for width, percent in ((4, 85), (5, 80)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(df, "text", "doc_id", width, percent).collect()}
        assert got == plain_components(texts, width, percent)


def test_small_sets_share_a_key():
    """Any two small sets that are similar enough have a subset key in common."""
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(1, 15))
        a = rng.choice(2**60, n, replace=False).astype(np.uint64)
        b = np.concatenate([a[int(rng.integers(0, 3)) :], rng.choice(2**60, int(rng.integers(0, 3)), replace=False).astype(np.uint64)])
        both = len(np.intersect1d(a, b))
        if len(b) and len(b) <= 14 and 100 * both >= 85 * (len(a) + len(b) - both):
            assert len(np.intersect1d(jaccard.subset_keys(np.sort(a), 14, 85), jaccard.subset_keys(np.sort(b), 14, 85)))


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {ord("A") + i: ord("a") + i for i in range(26)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain_hits(documents, benchmark):
    windows = {}
    for r in benchmark:
        w = words(r.text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(r.item_id)
    out = {}
    for r in documents:
        w, hit, items = words(r.text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if found := windows.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    items |= found
        out[r.doc_id] = (len(w), hit, items)
    return out


def test_hits(spark, rows):
    got = queries.QUERIES["op10_benchmark_decontamination"](spark, SF_DIR).collect()
    plain = plain_hits(rows["documents"], rows["benchmark"])
    assert len(got) == len(plain) and any(r.contaminated for r in got)
    for r in got:
        n, hit, items = plain[r.doc_id]
        digest = hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
        assert tuple(r)[1:] == (n, len(hit), len(items), digest, bool(hit))


def test_verdicts(spark, rows):
    def fit(url):
        rest = url.partition("://")[2] if url and "://" in url else ""
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host) :])[0]
        host = host.translate(LOWER)
        best = None
        for verdict, rule in queries.RULES:
            h, _, p = rule.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
                best = verdict, rule
        return host, path, best

    fits = {r.page_id: fit(r.url) for r in rows["pages"]}
    pages, blocked, allowed = Counter(), Counter(), Counter()
    for host, _, best in fits.values():
        pages[host] += 1
        blocked[host] += bool(best and best[0] == "block")
        allowed[host] += bool(best and best[0] == "allow")
    assert not any(re.search(urlfilter.LINK_HOST, r.html or "") for r in rows["pages"])  # so seeds decide alone
    for r in queries.QUERIES["op9_url_trust"](spark, SF_DIR).collect():
        host, path, best = fits[r.page_id]
        margin = (blocked[host] - allowed[host]) / pages[host]
        verdict = best[0] if best else "block" if margin > urlfilter.THRESHOLD else "allow"
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, best and best[1], verdict)


def test_pipeline(spark, rows):
    """Near copies, passages and tokens against plain versions of those stages; the
    trained ones against their operators."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = corpus_pipeline.quality_classifier(spark, corpus_pipeline.language_id(spark, docs, SF_DIR), SF_DIR).collect()
    assert len(kept) >= 0.7 * len(rows["documents"])
    components = plain_components({r.doc_id: r.text for r in kept}, 5, 80)
    unique = [r for r in kept if components[r.doc_id][1] == r.doc_id]
    hits = plain_hits(unique, rows["benchmark"])
    from tokenizers import Tokenizer

    plain = Tokenizer.from_str(bpe.public_tokenizer())
    expected = {}
    for r in unique:
        n, hit, _ = hits[r.doc_id]
        if hit and len(hit) == n:
            continue
        text = r.text
        for i, m in reversed(list(enumerate(re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", text)))):
            if i in hit:
                text = text[: m.start()] + text[m.end() :]
        expected[r.doc_id] = len(plain.encode(text, add_special_tokens=False).ids)
    got = {r.doc_id: r.n_tokens for r in queries.QUERIES["pipeline"](spark, SF_DIR).collect()}
    assert got == expected


def test_registered():
    assert {f"op{n}" for n in range(1, 11)} | {"pipeline"} == {q.split("_")[0] for q in queries.QUERIES}
    assert set(queries.ORACLES) <= set(queries.QUERIES)


def test_extra_columns_do_not_matter(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(40)
    wide = docs.select("*", *[F.lit(1).alias(c) for c in ("held_out", "score", "__text", "id", "row", "size", "fingerprint", "words", "item", "hash")])
    wide.write.parquet(f"{tmp_path}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF_DIR}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    for name in ("op4_bpe_word_table", "op8_ngram_jaccard_join", "op10_benchmark_decontamination"):
        assert queries.QUERIES[name](spark, str(tmp_path)).count() == 40


def test_long_texts_give_pieces_from_all_over(spark):
    from delaylens.llm import quality

    text = "".join(chr(0x4E00 + i) for i in range(20_000))
    rows = spark.createDataFrame([(0, text), (1, text[:8192]), (2, "")], "id int, text string")
    got = {r.id: r.p for r in rows.select("id", quality.spaced(F.col("text")).alias("p")).collect()}
    gap = (20_000 - 512) / 15
    assert got == {0: "".join(text[int(i * gap) : int(i * gap) + 512] for i in range(16)), 1: text[:8192], 2: ""}
    assert got[0].startswith(text[:512]) and got[0].endswith(text[-512:])


def test_sums_at_need_no_sorting(monkeypatch):
    rng = np.random.default_rng(2)
    at, values = rng.integers(0, 40, 3000).astype(np.uint16), rng.normal(size=(3000, 17)).astype(np.float32)
    expected = np.zeros((50, 17))
    np.add.at(expected, at, values.astype(float))
    monkeypatch.setattr(np, "argsort", None)
    sums = lm.sums_at(at, values, 50)
    assert sums.dtype == np.float32 and np.array_equal(sums, expected.astype(np.float32))
