"""Conversation repair: brute force, blocks against whole, odd rows, hash collisions."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from delaylens.llm import repair

COLUMNS = ("conv_id", "turn", "role", "text")
DDL = "conv_id long, turn long, role string, text string"


def all_ways(rows):
    """Every edit text of at most two inserts a gap, with its cost and result."""
    seen, marks = set(), []
    for role, text in rows:
        found = "blank" if not re.search(r"[^\x20\x09-\x0D]", text) else "duplicate" if (role, text) in seen else None
        if found is None and not re.search(r"[.!?][\x20\x09-\x0D]*\Z", text):
            found = "truncated"
        seen.add((role, text))
        marks.append(found)

    def go(i, cost, edits, roles, said, gap):
        if i == len(rows):
            if re.fullmatch(r"(s?(ua)+)?", roles):
                yield cost, edits, said
        else:
            role, text = rows[i]
            extra = 5 if marks[i] == "truncated" else 0
            yield from go(i + 1, cost + 2, edits + "D", roles, said, 0)
            if marks[i] not in ("blank", "duplicate"):
                yield from go(i + 1, cost + extra, edits + "K", roles + (role[:1] or "?"), [*said, f"{role}:{text}"], 0)
                for own in ("user", "assistant"):
                    yield from go(i + 1, cost + extra + 1, edits + "R", roles + own[0], [*said, f"{own}:{text}"], 0)
        if gap < 2:
            for own in ("user", "assistant"):
                yield from go(i, cost + 5, edits + "I", roles + own[0], [*said, f"{own}:"], gap + 1)

    return marks, min(go(0, 0, "", "", [], 0))


def random_rows(rng, n):
    roles = ["user", "assistant", "system", "tool", ""]
    return [(rng.choice(roles), rng.choice(["a.", "b!", "c?", "d", "e", " ", "", "a.\n", f"x{rng.random()}."])) for _ in range(n)]


def test_every_short_conversation_is_cheapest():
    rng = random.Random(5)
    for _ in range(80):
        rows = random_rows(rng, rng.randint(0, 3))
        marks, (cost, edits, said) = all_ways(rows)
        faults, got_cost, audit = repair.repair_rows([(None, *r) for r in rows])
        assert (got_cost, audit) == (cost, edits)
        assert [f"{role}:{text}" for _, _, role, text in repair.replay(audit, iter(rows))] == said
        assert faults.count == {k: marks.count(k) for k in ("blank", "duplicate", "truncated")}


@pytest.mark.parametrize("hashed", [repair.label_hash, lambda label: 0, lambda label: 1])
def test_order_of_prefixes_whatever_the_hash(hashed):
    rng = random.Random(7)
    tree, texts = repair.Prefixes(hashed), [""]
    children = {}
    for _ in range(400):
        parent, label = rng.randrange(max(0, len(texts) - 30), len(texts)), rng.choice("DIKR")
        if (parent, label) not in children:
            children[parent, label] = tree.add(parent, label)
            texts.append(texts[parent] + label)
    assert ["".join(tree.spelled(n)) for n in range(len(texts))] == texts
    for _ in range(3000):
        a, b = rng.sample(range(len(texts)), 2)
        assert tree.less(a, b) == (texts[a] < texts[b])


def made(spark, seed=3, conversations=12):
    rng, rows = random.Random(seed), []
    for c in range(conversations):
        for role, text in random_rows(rng, rng.choice([1, 3, 8, 60])):
            rows.append((c, rng.choice([None, *range(12)]), role, text))
    return rows, spark.createDataFrame(rows, DDL).repartition(4)


def test_blocks_give_the_same_as_whole_conversations(spark):
    _, df = made(spark)
    whole = {r.conv_id: r for r in repair.report(df, *COLUMNS).collect()}
    assert len(whole) == 12
    for block in (3,):
        parts = repair.report(df, *COLUMNS, long_rows=block).collect()
        assert len(parts) == 12 and all(r == whole[r.conv_id] for r in parts)


def test_repaired_turns_spell_the_digest(spark):
    _, df = made(spark, 4, 8)
    digests = {r.conv_id: r.repaired_sha256 for r in repair.report(df, *COLUMNS).collect()}
    for long_rows in (10_000, 9):
        turns = {c: [] for c in digests}
        for r in sorted(repair.repaired(df, *COLUMNS, long_rows=long_rows).collect()):
            assert r.position == len(turns[r.conv_id])
            turns[r.conv_id].append(f"{r.role}:{r.text}")
        assert {c: hashlib.sha256("\n".join(t).encode()).hexdigest() for c, t in turns.items()} == digests


EMPTY = hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("long_rows", [10_000, 1])
def test_odd_rows(spark, long_rows):
    long = "word " * 50_000 + "end."
    rows = [
        (1, None, None, None, True), (1, 2, "user", long, True), (1, 2, "user", long, True), (1, 5, "assistant", "ok.", True),
        (None, 1, "user", "hi.", True), (None, 1, "assistant", "ho.", True),
        (2, 1, "user", "gone.", False), (3, None, "user", "a.", True), (3, None, "user", "a.", True), (4, 1, "", "x.", None),
    ]
    ddl = DDL + ", present boolean, cost long, audit string, conv string, block long"
    df = spark.createDataFrame([(*r, 9, "z", "q", 4) for r in rows], ddl)
    got = {r.conv_id: r for r in repair.report(df, *COLUMNS, F.col("present"), long_rows).collect()}
    assert set(got) == {1, 2, 3, 4, None}
    assert tuple(got[1])[1:8] == (2, 1, 1, 0, 2, 4, "DKDK")
    assert tuple(got[None])[1:8] == (0, 0, 0, 0, 0, 2, "RR")  # by role: assistant before user
    for c in (2, 4):
        assert tuple(got[c])[1:] == (0, 0, 0, 0, 0, 0, "", EMPTY)
    assert tuple(got[3])[1:8] == (0, 0, 1, 0, 1, 4, "DD") and got[3].repaired_sha256 == EMPTY
    assert repair.report(df.limit(0), *COLUMNS, F.col("present"), long_rows).count() == 0
    with pytest.raises(ValueError):
        repair.report(df.withColumnRenamed("conv_id", "gaps"), "gaps", "turn", "role", "text")
