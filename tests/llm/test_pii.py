"""Patterns against their plain form, disclosing terms against a plain count, odd rows."""

import hashlib
import math
import random
import re
from collections import defaultdict

import pytest

from delaylens.llm import pii, queries

SF_DIR = "/root/testdata/sf0.001"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_base(text):
    out = [(m.start(), 0, m.end(), "email") for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end(), "ip") for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for i, kind, pattern, least, most in ((2, "card", CARD, 12, 19), (3, "phone", PHONE, 9, 15)):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if least <= len(digits) <= most and (kind != "card" or plain_luhn(digits)):
                out.append((m.start(), i, m.end(), kind))
    return [(kind, a, b) for a, _, b, kind in sorted(out)]


def test_patterns_on_random_texts():
    rng = random.Random(11)
    for alphabet in ("ab@@..-+_ é", "0129..  ", "01 -", "+1() .-9x", "a@b.c1.2+-() "):
        for _ in range(3000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
            assert pii.base_spans(text) == plain_base(text), text
    for _ in range(3000):
        number = str(rng.randrange(10**11, 10**19))
        assert pii.luhn(number) == plain_luhn(number)


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "300." * 80_000, "+1" + " " * 300_000, "a@" * 150_000, "1 " * 150_000, "+" * 300_000):
        assert pii.base_spans(text) == []


def plain_words(text):
    return [(m.start(), m.end()) for m in re.finditer(pii.WORD, text)]


def plain_disclosing(texts):
    """{term: share} by counting over all texts."""
    n_t, rows, ctx, pair_rows, pair_ctx = defaultdict(int), defaultdict(set), defaultdict(set), defaultdict(set), defaultdict(set)
    for row, text in enumerate(texts):
        text = text or ""
        words = plain_words(text)
        base = plain_base(text)
        for t in pii.terms_of(text[a:b] for a, b in words):
            n_t[t] += 1
        for kind, start, end in base:
            near = [w for w in words if w[1] <= start][-pii.WINDOW :] + [w for w in words if w[0] >= end][: pii.WINDOW]
            near = [text[a:b] for a, b in near if not any(s < b and a < e for _, s, e in base)]
            e, c = pii.entity(kind, text[start:end]), " ".join(near).lower()
            rows[e].add(row)
            ctx[e].add(c)
            for t in pii.terms_of(near):
                pair_rows[e, t].add(row)
                pair_ctx[e, t].add(c)
    found = {}
    for e, contexts in ctx.items():
        shares = [len(c) / len(contexts) for (x, t), c in pair_ctx.items() if x == e and "[" not in t]
        if len(contexts) < pii.CONTEXTS or not shares or sum(s * s for s in shares) / sum(shares) > pii.COPIED:
            continue
        own = math.log(len(texts) / len(rows[e]))
        for (x, t), c in pair_ctx.items():
            if x == e and len(c) >= pii.CONTEXTS and own > 0:
                share = math.log(len(pair_rows[e, t]) * len(texts) / (len(rows[e]) * n_t[t])) / own
                if share >= pii.SHARE:
                    found[t] = max(share, found.get(t, 0))
    return found


def corpus(capitals=True):
    rng = random.Random(2)
    common = ["the", "of", "and", "to", "in", "on", "was", "for"]
    other = [f"{'W' if capitals and i % 3 == 0 else 'w'}{i}" for i in range(600)]

    def prose(n):
        return " ".join(rng.choice(common if rng.random() < 0.5 else other) for _ in range(n))

    texts = [prose(30) for _ in range(120)]
    texts += [f"{prose(12)} Mrs Quillfeather, jq@mail.example.org {prose(12)}" for _ in range(6)]  # a name near an address
    texts += [prose(5) + f" call +1 (555) 010-9999 zanzibar now {prose(3)}"] * 9  # copies: no evidence
    texts += [f"{prose(6)} 4111 1111 1111 1111 {prose(6)}" for _ in range(5)]
    texts += [f"quillfeather alone {prose(3)} and Quillfeather."]
    return texts


def test_disclosing_terms(spark):
    texts = corpus()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string").repartition(5)
    want = plain_disclosing(texts)
    assert "quillfeather" in want and "zanzibar" not in want
    for limit in (pii.BROADCAST_TERMS, 0):
        got = {r.term: r.share for r in pii.disclosing(df, "text", limit).collect()}
        assert got.keys() == want.keys() and all(abs(got[t] - want[t]) < 1e-9 for t in want)
        shown = {r.id: r.spans for r in pii.report(df, "text", ["id"], limit).collect()}
        for i, text in enumerate(texts):
            base = plain_base(text)
            terms = [("term", a, b) for a, b in plain_words(text) if text[a:b].lower() in want and not any(s < b and a < e for _, s, e in base)]
            spans = sorted(base + terms, key=lambda s: (s[1], pii.ORDER[s[0]]))
            assert shown[i] == ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    clean = {r.id: r.sanitised for r in pii.sanitised(df, "text", ["id"]).collect()}
    assert "[name], [email]" in clean[120] and "Quill" not in clean[120] and "[phone]" in clean[126]
    bare = spark.createDataFrame([(i, t) for i, t in enumerate(corpus(capitals=False))], "id long, text string")
    gone = {r.id: r.sanitised for r in pii.sanitised(bare, "text", ["id"]).where("id = 120").collect()}
    assert " , [email]" in gone[120] and "[name]" not in gone[120]  # capitals stand near the address only
    assert clean[0] == texts[0] and clean[len(texts) - 1].endswith("and [name].")


def test_query(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op12_disclosed_terms"](spark, SF_DIR).collect()}
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    assert len(got) == len(documents)
    for r in documents:
        base = plain_base(r.text or "")
        mine = got[r.doc_id]
        assert [mine.n_email, mine.n_ip, mine.n_card, mine.n_phone] == [sum(k == kind for k, _, _ in base) for kind in pii.KINDS]
        shown = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert mine.base_sha256 == hashlib.sha256(shown.encode()).hexdigest()
        assert set(filter(None, shown.split(","))) <= set(mine.spans.split(","))


def test_odd_rows(spark):
    long = "mot " * 40_000 + "x@y.zz " + "mot " * 40_000
    rows = [(1, None), (1, None), (2, ""), (None, "😀 a@b.cc"), (3, long), (4, "1.2.3.4.5.6.7.8 10.0.0.256"), (4, "@ a@b a@b.c@d.e")]
    df = spark.createDataFrame([(i, t, 1, "q", 3) for i, t in rows], "id long, text string, n_ip long, spans string, row long")
    got = [(r.id, r.spans) for r in pii.report(df, "text", ["id"]).collect()]
    at = 160_000
    want = [(1, ""), (1, ""), (2, ""), (None, "email:2:8"), (3, f"email:{at}:{at + 6}"), (4, "ip:0:7,ip:8:15"), (4, "email:6:11")]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert pii.report(df.limit(0), "text", ["id"]).count() == 0
    assert [r.sanitised for r in pii.sanitised(df.where("id = 4"), "text", ["id", "row"]).collect()] == ["[ip].[ip] 10.0.0.256", "@ a@b [email]@d.e"]
    with pytest.raises(ValueError):
        pii.report(df, "text", ["id", "spans"])
