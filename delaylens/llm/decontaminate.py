"""Benchmark decontamination with a broadcast hash set of test n-grams.

Built-in functions only. Benchmark items are cut into windows of consecutive
normalised words; their hashes are a set of checked size that is broadcast.
Every window of every document is hashed and probed; the few that hit are
verified against the benchmark's words, because two windows may share a hash.
Words inside a verified window are hit: their spans, or the whole documents,
can be removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylens.llm.common import free_name
from delaylens.session import stage

WINDOW = 10
#: Benchmark windows that are broadcast at most (about 40 bytes each); above it
#: the probe is a shuffled join.
BROADCAST_WINDOWS = 500_000
#: Rows of verified hits that are broadcast at most.
BROADCAST_HITS = 500_000

# The alphabet that is lower-cased and what stands between words.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: One by one: Java looks these up in a table, but tries ranges one after another.
BETWEEN = "[" + "".join(rf"\x{c:02X}" for c in range(128) if not chr(c).isalnum()) + "]+"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased; the quicker `lower` where a text is ASCII only."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def cut(text: Column) -> Column:
    """The words in order, in their case; null and empty texts have none."""
    # split leaves an empty string before a separator at the start and behind one at the end
    return F.coalesce(F.array_remove(F.split(text, BETWEEN), ""), F.array().cast("array<string>"))


def words(text: Column) -> Column:
    """The normalised words in order."""
    return cut(ascii_lower(text))


def word_hashes(words_column: Column) -> Column:
    return F.transform(words_column, lambda w: F.xxhash64(w))


def window_hashes(worded: DataFrame, key: str, length: int) -> DataFrame:
    """(key, start, hash): each run of `length` words of the column `hashes`, by
    its first word. Windows are rows before they are hashed: the ten look-ups are
    compiled, where a slice in a lambda is not."""
    last = F.size("hashes") - length
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    placed = worded.select(key, "hashes", F.explode(starts).alias("start"))
    return placed.select(key, "start", F.xxhash64(*[F.get("hashes", F.col("start") + i) for i in range(length)]).alias("hash"))


def benchmark_windows(benchmark: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """(item, length, phrase, hash): each item's distinct windows. An item of
    fewer words than a window is one window; one without words has none."""
    worded = benchmark.select(F.col(item).alias("item"), words(F.col(text)).alias("words")).where(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(window))
    starts = F.sequence(F.lit(1), F.size("words") - length + 1)
    cut = worded.select("item", length.alias("length"), F.explode(F.transform(starts, lambda i: F.slice("words", i, length))).alias("part"))
    return cut.select("item", "length", F.concat_ws(" ", "part").alias("phrase"), F.xxhash64(word_hashes(F.col("part"))).alias("hash")).distinct()


def found_windows(documents: DataFrame, benchmark: DataFrame, key: str, text: str, item: str, item_text: str, window: int) -> DataFrame:
    """(key, item, start, length): every occurrence of a benchmark window in a
    document; start counts words from 0. `key` must tell rows apart."""
    windows = stage(benchmark_windows(benchmark, item, item_text, window), "windows")
    sizes = {r["length"]: r["count"] for r in windows.groupBy("length").count().collect()}
    few = sum(sizes.values()) <= BROADCAST_WINDOWS
    probes = None
    worded = documents.select(key, word_hashes(words(F.col(text))).alias("hashes"))
    for length in sorted(sizes):  # the window and, if there are shorter items, their lengths
        hashes = windows.where(F.col("length") == length).select("hash").distinct()
        hit = window_hashes(worded, key, length).join(F.broadcast(hashes) if few else hashes, "hash").withColumn("length", F.lit(length))
        probes = hit if probes is None else probes.unionByName(hit)
    if probes is None:
        return documents.select(key, F.lit(None).cast(benchmark.schema[item].dataType).alias("item"), F.lit(0).alias("start"), F.lit(0).alias("length"), F.lit("").alias("phrase")).limit(0)
    return probes.join(F.broadcast(windows) if few else windows, ["hash", "length"]).select(key, "item", "start", "length", "phrase")


def verified(documents: DataFrame, probes: DataFrame, key: str, text: str) -> DataFrame:
    """The probes whose words are the benchmark's."""
    hits = probes.select(key).distinct()
    few = hits.count() <= BROADCAST_HITS
    again = documents.join(F.broadcast(hits) if few else hits, key, "left_semi").select(key, words(F.col(text)).alias("words"))
    same = F.concat_ws(" ", F.slice("words", F.col("start") + 1, F.col("length"))) == F.col("phrase")
    return probes.join(again, key).where(same).select(key, "item", "start", "length")


def row_key(key: Column, text: Column) -> Column:
    """Tells rows apart unless they are equal in key and text."""
    return F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("null")), F.hex(F.xxhash64(text)), F.length(text).cast("string"))


def hits(documents: DataFrame, benchmark: DataFrame, key: str, text: str, item: str, item_text: str, window: int = WINDOW) -> DataFrame:
    """(row_key, words_hit, items) of the contaminated rows: the sorted places of
    the words inside any benchmark window, and the items found."""
    keyed = documents.select(row_key(F.col(key), F.col(text)).alias("row_key"), F.col(text).alias("text"))
    probes = found_windows(keyed, benchmark, "row_key", "text", item, item_text, window)
    certain = verified(keyed, stage(probes, "probes"), "row_key", "text")
    # one group is one text: no more places than it has words
    grouped = certain.groupBy("row_key").agg(
        F.collect_set(F.struct("start", "length")).alias("spans"), F.collect_set("item").alias("items")
    )
    places = F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1))
    return grouped.select("row_key", F.array_sort(F.array_distinct(F.flatten(places))).alias("words_hit"), "items")


def report(documents: DataFrame, benchmark: DataFrame, key: str, text: str, item: str, item_text: str, window: int = WINDOW) -> DataFrame:
    """Per row: the key, n_words, n_hit, n_items, items_sha256 (ids as text, sorted,
    joined by commas) and contaminated.

    Null and empty texts have no words and no hit; an empty benchmark hits
    nothing; items whose id is null mark words but are not counted; repeated rows
    stay. Other columns are not read."""
    found = hits(documents, benchmark, key, text, item, item_text, window)
    base = documents.select(key, row_key(F.col(key), F.col(text)).alias("row_key"), F.size(cut(F.col(text))).cast("long").alias("n_words"))
    names = F.array_sort(F.transform(F.coalesce("items", F.array().cast(found.schema["items"].dataType)), lambda i: i.cast("string")))
    return base.join(found, "row_key", "left").select(
        key,
        "n_words",
        F.coalesce(F.when(F.col("words_hit").isNotNull(), F.size("words_hit")), F.lit(0)).cast("long").alias("n_hit"),
        F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        F.col("words_hit").isNotNull().alias("contaminated"),
    )


def without_words(text: Column, hit: Column) -> Column:
    """The text without the words at the places `hit` and what follows each."""
    word = F.regexp_extract_all(text, F.lit(WORD_ANY_CASE), F.lit(0))
    gaps = F.split(text, WORD_ANY_CASE)
    # arguments are worked out once a row, what stands in a lambda once a word
    pieces = F.zip_with(word, F.slice(gaps, 2, F.size(gaps)), lambda w, gap: F.concat(w, gap))
    kept = F.filter(pieces, lambda piece, i: ~F.array_contains(hit, i))
    return F.concat(F.get(gaps, F.lit(0)), F.array_join(kept, ""))


def remove(
    documents: DataFrame, benchmark: DataFrame, key: str, text: str, item: str, item_text: str,
    window: int = WINDOW, document_share: float = 1.0, length: str | None = None,
) -> DataFrame:
    """All columns of `documents`, without the hit spans; rows of which at least
    `document_share` of the words are hit are removed whole. `length` names a
    column that gets the new text's length. Rows without a hit are unchanged."""
    row, spans = free_name(documents, "__key"), free_name(documents, "__hit")
    found = hits(documents, benchmark, key, text, item, item_text, window)
    found = stage(found.select(F.col("row_key").alias(row), F.col("words_hit").alias(spans)), "hits")
    few = found.agg(F.coalesce(F.sum(F.size(spans) + 10), F.lit(0))).first()[0] <= 10 * BROADCAST_HITS
    rows = documents.withColumn(row, row_key(F.col(key), F.col(text))).join(F.broadcast(found) if few else found, row, "left")
    hit = F.col(spans).isNotNull()
    kept = rows.where(~hit | (F.size(spans) < document_share * F.size(cut(F.col(text)))))
    cleaned = kept.withColumn(text, F.when(hit, without_words(F.col(text), F.col(spans))).otherwise(F.col(text)))
    if length:
        cleaned = cleaned.withColumn(length, F.when(hit, F.length(text)).otherwise(F.col(length)).cast(documents.schema[length].dataType))
    return cleaned.select(*[F.col(f"`{c}`") for c in documents.columns])
