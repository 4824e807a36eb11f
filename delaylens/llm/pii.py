"""Personal data: patterns, and terms that give a protected entity away.

Patterns find e-mail addresses, IP addresses, card and phone numbers. Each value
found is a protected entity. How much a term near it reveals is estimated from
all documents: the pointwise mutual information of term and entity, as a share of
the entity's own information,

    log(n_et N / (n_e n_t)) / log(N / n_e)

where n_e and n_t are the documents that hold entity and term, n_et those that
hold the term near the entity, and N all documents. A share of 1 means that the
term occurs near this entity only; from SHARE on a term discloses it. A disclosing
term is generalised to its shape (a name, a number, a word), or removed where the
shape itself would disclose.

Copies are no evidence: a term needs several different contexts of the entity, and
an entity most of whose words come back from context to context has none but
copies of one.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import islice
from unicodedata import category

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaylens.llm.common import lean, schema_with, text_batches
from delaylens.session import stage

#: Words on either side of an entity that are its context.
WINDOW = 8
#: Different contexts in which a term must stand near an entity.
CONTEXTS = 3
#: Share of an entity's information from which on a term discloses it.
SHARE = 0.95
#: Share of a context's words expected in another one, above which they are copies.
COPIED = 0.5
#: Terms sent to every task; more are joined by a shuffle.
BROADCAST_TERMS = 200_000

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
ORDER = {kind: i for i, kind in enumerate((*KINDS, TERM))}

# The patterns match what their contract's match, in linear time: a match never
# starts inside a run of digits, and an address is found from its @ sign.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Letters, digits and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORDS = re.compile(WORD)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWERED = str.maketrans(UPPER, LOWER)
#: A term's shapes; no term has a bracket.
NAME, NUMBER, PLAIN = "[name]", "[number]", "[word]"

Span = tuple[str, int, int]


def emails(text: str) -> Iterator[Span]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            free = domain.end()
            yield "email", start, free
        at = text.find("@", max(free, at + 1))


def small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(int(d) * 2 - 9 * (d > "4") for d in digits[-2::-2])) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) of the patterns' matches, by start and kind."""
    found = list(emails(text))
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(map(small, m[0].split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 37 and 12 <= len(digits := digits_of(m[0])) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15] if "+" in text else []
    return sorted(found, key=lambda s: (s[1], ORDER[s[0]]))


def entity(kind: str, value: str) -> str:
    """What makes two matches the same entity."""
    return f"{kind}:{digits_of(value) if kind in ('card', 'phone') else value.translate(LOWERED)}"


def shape(word: str) -> str:
    if word.isdecimal():
        return NUMBER
    return NAME if category(word[0]) == "Lu" else PLAIN


def terms_of(words: Iterable[str]) -> set[str]:
    """Lower-cased words and the shapes among them."""
    found = set(words)
    return {w.translate(LOWERED) for w in found} | {shape(w) for w in found}


def words_before(text: str, stop: int, count: int) -> list[tuple[int, int]]:
    """Places of the last words that end by `stop`."""
    reach = 16 * count
    while True:
        start = max(stop - reach, 0)
        found = [m.span() for m in WORDS.finditer(text, start, stop)]
        if start == 0 or len(found) > count:  # the first may be cut
            return found[-count:]
        reach *= 4


def contexts(text: str) -> Iterator[tuple[str, int, list[str]]]:
    """(entity, hash of its context, the terms of it) at each match."""
    spans = base_spans(text)
    starts, ends, reach = [s for _, s, _ in spans], [], 0
    for _, _, end in spans:
        reach = max(reach, end)
        ends.append(reach)

    def outside(place: tuple[int, int]) -> bool:
        """Whether a word overlaps no match."""
        i = bisect_right(starts, place[1] - 1)
        return not i or ends[i - 1] <= place[0]

    for kind, start, end in spans:
        places = words_before(text, start, WINDOW) + [m.span() for m in islice(WORDS.finditer(text, end), WINDOW)]
        words = [text[a:b] for a, b in filter(outside, places)]
        said = hashlib.blake2b(" ".join(words).translate(LOWERED).encode(), digest_size=8).digest()
        yield entity(kind, text[start:end]), int.from_bytes(said, "big", signed=True), sorted(terms_of(words))


def found_contexts(df: DataFrame, text: str) -> DataFrame:
    """(row, entity, context, terms), once per document and context, written."""
    schema = "row long, entity string, context long, terms array<string>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row, names = TaskContext.get().partitionId() << 36, ["row", "entity", "context", "terms"]
        for batch in batches:
            out: list[tuple] = []
            for said in batch.column(0).to_pylist():
                seen = {(e, c): (row, e, c, t) for e, c, t in contexts(said)} if said else {}
                out += seen.values()
                row += 1
                if len(out) > 10_000:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema=kind)
                    out = []
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema=kind)

    kind = pa.schema([("row", pa.int64()), ("entity", pa.string()), ("context", pa.int64()), ("terms", pa.list_(pa.string()))])
    return stage(text_batches(df).select(text).mapInArrow(lean(work), schema), "contexts")


def near(found: DataFrame) -> DataFrame:
    """(entity, n_e, term, n_et) of the terms in enough different contexts of an
    entity whose contexts aren't copies of each other; written."""
    entities = found.groupBy("entity").agg(F.countDistinct("row").alias("n_e"), F.countDistinct("context").alias("n_c")).where(F.col("n_c") >= CONTEXTS)
    each = found.join(entities.select("entity"), "entity", "left_semi").select("entity", "row", "context", F.explode("terms").alias("term"))
    pairs = each.groupBy("entity", "term").agg(F.countDistinct("row").alias("n_et"), F.countDistinct("context").alias("n_tc"))
    pairs = stage(pairs.join(entities, "entity"), "near")
    share = F.col("n_tc") / F.col("n_c")
    words = pairs.where(~F.col("term").isin(NAME, NUMBER, PLAIN))
    own = words.groupBy("entity").agg((F.sum(share * share) / F.sum(share)).alias("again")).where(F.col("again") <= COPIED)
    kept = pairs.where(F.col("n_tc") >= CONTEXTS).join(own.select("entity"), "entity", "left_semi")
    return stage(kept.select("entity", "n_e", "term", "n_et"), "candidates")


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def split_words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def native_terms(text: Column) -> Column:
    """As terms_of, for the joins of many terms."""
    words = split_words(text)
    shapes = F.transform(words, lambda w: F.when(w.rlike(r"\A\p{Nd}+\z"), NUMBER).when(w.rlike(r"\A\p{Lu}"), NAME).otherwise(PLAIN))
    return F.array_distinct(F.concat(F.transform(words, lowered), shapes))


def documents_with(df: DataFrame, text: str, terms: DataFrame, broadcast_terms: int) -> DataFrame:
    """(term, n_t): in how many rows each of the terms occurs. Rows come out of a
    task summed up."""
    if terms.count() > broadcast_terms:
        return df.select(F.explode(native_terms(F.col(text))).alias("term")).groupBy("term").agg(F.count("*").alias("n_t")).join(terms, "term", "left_semi")
    wanted = frozenset(r[0] for r in terms.collect())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter[str] = Counter()
        for batch in batches:
            for said in batch.column(0).to_pylist():
                n.update(wanted & terms_of(WORDS.findall(said or "")))
        yield pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.string()), pa.array(n.values(), pa.int64())], ["term", "n"])

    return text_batches(df).select(text).mapInArrow(lean(work), "term string, n long").groupBy("term").agg(F.sum("n").alias("n_t"))


def disclosing(df: DataFrame, text: str, broadcast_terms: int = BROADCAST_TERMS) -> DataFrame:
    """(term, entity, share, n_et, n_e, n_t): the disclosing terms, each with the
    entity that it reveals most of; ties go to the least entity. Written."""
    candidates = near(found_contexts(df, text))
    n_t = documents_with(df, text, stage(candidates.select("term").distinct(), "terms"), broadcast_terms)
    total = F.lit(df.count())
    own = F.log(total / F.col("n_e"))
    share = F.when(own > 0, F.log(F.col("n_et") * total / (F.col("n_e") * F.col("n_t"))) / own)
    told = candidates.join(n_t, "term").withColumn("share", share).where(F.col("share") >= SHARE)
    best = F.min_by(F.struct("entity", "share", "n_et", "n_e", "n_t"), F.struct(-F.col("share"), "entity")).alias("best")
    return stage(told.groupBy("term").agg(best).select("term", "best.*"), "disclosing")


class Marked:
    """Texts with the disclosing terms that may stand in them: one set for all
    while it is small, or else a column of each text's own terms."""

    def __init__(self, df: DataFrame, text: str, keep: list[str], broadcast_terms: int):
        if clash := {"__text", "__terms", "__digest"} & set(keep):
            raise ValueError(f"kept columns have names used here: {sorted(clash)}")
        terms = disclosing(df, text, broadcast_terms).select("term")
        self.shapes = frozenset(r[0] for r in terms.where(F.col("term").isin(NAME, NUMBER, PLAIN)).collect())
        self.shared: frozenset[str] | None = None
        said = text_batches(df).select(*keep, F.col(text).alias("__text"))
        if terms.count() <= broadcast_terms:
            self.shared = frozenset(r[0] for r in terms.collect())
            self.rows = said.withColumn("__terms", F.lit(None).cast("array<string>"))
        else:
            digest = F.sha2(F.col(text), 256)
            each = df.select(digest.alias("__digest"), F.explode(native_terms(F.col(text))).alias("term")).distinct()
            held = each.join(terms, "term").groupBy("__digest").agg(F.collect_list("term").alias("__terms"))
            said = said.withColumn("__digest", F.sha2("__text", 256)).join(held, "__digest", "left")
            self.rows = said.select(*keep, "__text", "__terms")

    def mapped(self, keep: list[str], schema: T.StructType, of_text) -> DataFrame:
        """`keep` and the values of `of_text(text, base spans, all spans)`."""
        shared = self.shared

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = []
                for said, own in zip(batch.column(len(keep)).to_pylist(), batch.column(len(keep) + 1).to_pylist()):
                    said = said or ""
                    base = base_spans(said)
                    values.append(of_text(said, base, with_terms(said, base, shared if shared is not None else frozenset(own or ()))))
                columns = [pa.array([v[i] for v in values]) if values else pa.array([], pa.null()) for i in range(len(schema) - len(keep))]
                kinds = [pa.int64() if f.dataType == T.LongType() else pa.string() for f in schema.fields[len(keep) :]]
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *(c.cast(k) for c, k in zip(columns, kinds))], names=schema.names)

        return self.rows.mapInArrow(lean(work), schema)


def with_terms(text: str, base: list[Span], terms: frozenset[str]) -> list[Span]:
    """The base spans and those of disclosing terms outside them, in order."""
    if not terms or terms.isdisjoint(w.translate(LOWERED) for w in WORDS.findall(text)):
        return base
    starts, ends, reach = [s for _, s, _ in base], [], 0
    for _, _, end in base:
        reach = max(reach, end)
        ends.append(reach)
    added = []
    for m in WORDS.finditer(text):
        if m[0].translate(LOWERED) in terms:
            i = bisect_right(starts, m.end() - 1)
            if not i or ends[i - 1] <= m.start():
                added.append((TERM, *m.span()))
    return sorted(base + added, key=lambda s: (s[1], ORDER[s[0]]))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def report(df: DataFrame, text: str, keep: list[str], broadcast_terms: int = BROADCAST_TERMS) -> DataFrame:
    """The columns `keep`, then n_email, n_ip, n_card and n_phone, base_sha256 of
    the patterns' spans and `spans`, all spans with those of disclosing terms
    (kind `term`), as kind:start:end in code points, by start and kind.

    Null and empty texts have no spans. Repeated rows stay and count as documents;
    copies alone never make a term disclose. Texts are read whole. Other columns
    aren't read; kept ones named like a result are refused.
    """
    schema = schema_with(df, keep, "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")

    def values(_: str, base: list[Span], spans: list[Span]) -> tuple:
        n = Counter(kind for kind, _, _ in base)
        return *(n[kind] for kind in KINDS), hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans)

    return Marked(df, text, keep, broadcast_terms).mapped(keep, schema, values)


def sanitised(df: DataFrame, text: str, keep: list[str], broadcast_terms: int = BROADCAST_TERMS) -> DataFrame:
    """The columns `keep` and `sanitised`, the text with each entity replaced by
    its kind in brackets, and each disclosing term by its shape, or by nothing
    where that shape discloses an entity itself. Of overlapping spans the first
    counts. Null stays an empty text."""
    schema = schema_with(df, keep, "sanitised string")
    marked = Marked(df, text, keep, broadcast_terms)
    shapes = marked.shapes

    def values(said: str, _: list[Span], spans: list[Span]) -> tuple[str]:
        parts, at = [], 0
        for kind, start, end in spans:
            if start >= at:
                general = shape(said[start:end])
                parts += [said[at:start], f"[{kind}]" if kind != TERM else "" if general in shapes else general]
            at = max(at, end)
        return ("".join([*parts, said[at:]]),)

    return marked.mapped(keep, schema, values)
