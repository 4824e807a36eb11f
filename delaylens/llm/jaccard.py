"""Size-aware join of texts by the Jaccard similarity of their word shingles.

Every link between different sets is found or made certain by other links:

1. One pass turns each text into its set of 64-bit shingle hashes, a 128-bit
   fingerprint of the set, and the lowest hashes of the set (the zone). Sets
   that link share at least k hashes of their zones, so a set most of whose zone
   hashes no other text has can link with nothing. Zone hashes are counted over
   all texts; most texts end here, and only the zones have been shuffled.
2. Texts with equal sets fall into one class. Only the classes' whole sets are
   built (a second pass over their texts).
3. Signatures. A small set (size up to a boundary) enumerates its subsets of the
   size that a link with the larger set of m elements must share; large sets are
   found by scanning the inverted lists of their rarest elements (the prefix),
   counted over all classes, so passages that many texts share stay out of the
   lists. The boundary is the one with the least counted cost.
4. Lists are not expanded into all pairs. In hub rounds each member of a list is
   compared with one member only; groups of near copies melt into one component.
   The last round compares all pairs of a list that are still in different
   components, so no link between components is lost. A pair is only compared
   where enough elements are left from the shared one on, in both orders, for the
   overlap that the two sizes need.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from delaylens.llm.common import free_name, lean, schema_with, text_batches, unit_hash
from delaylens.llm.graph import components
from delaylens.session import stage

#: Words of a shingle, and the least similarity in hundredths.
SHINGLE = 5
PERCENT = 80
HUB_ROUNDS = 5
#: Classes whose ids are sent to all tasks at most (8 bytes each); above it the
#: texts are joined by a shuffle.
BROADCAST_IDS = 2_000_000
#: The largest boundary that the cost model looks at.
LARGEST_SMALL = 20
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: Stands for a null key while texts are read again.
NO_ID = -(1 << 63)
#: Rows to remove that are broadcast at most (about 60 bytes each).
BROADCAST_LOSERS = 500_000


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (the finaliser of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, width: int, cache: dict[bytes, int]) -> np.ndarray:
    """The sorted distinct hashes of the text's word shingles. A text of fewer
    words is one shingle; without words the set is empty."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = []
    for w in words:
        h = cache.get(w)
        if h is None:
            h = cache[w] = xxhash.xxh3_64_intdigest(w)
        hashes.append(h)
    h = np.array(hashes, np.uint64)
    n = min(width, len(h))
    value = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        value = value * MULTIPLIER + h[k : len(h) - n + 1 + k]
    return np.unique(mix(value))


def least_overlap(size, percent: int = PERCENT):
    """Elements a set shares at least with any partner at least as small."""
    return (percent * size + 99) // 100


def prefix_length(size, percent: int = PERCENT):
    """Lowest elements of which any partner shares one."""
    return size - least_overlap(size, percent) + 1


def zone_need(size, percent: int = PERCENT):
    """k of the zone: the zone is k - 1 longer than the prefix and shares k."""
    return np.maximum(1, prefix_length(size, percent) // 2)


def word_cache(cache: dict, bound: int = 100_000) -> dict:
    return cache if len(cache) < bound else {}


def features(df: DataFrame, text: str, key: str, width: int, percent: int) -> DataFrame:
    """(key, size, fingerprint, need, zone) of each row. Empty sets have neither
    fingerprint nor zone."""
    schema = schema_with(df, [key], "size long, fingerprint binary, need int, zone array<long>")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, int] = {}
        for batch in batches:
            sizes, prints, needs, zones = [], [], [], []
            for t in batch.column(1).to_pylist():
                cache = word_cache(cache)
                s = shingles(t, width, cache)
                n = len(s)
                sizes.append(n)
                prints.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if n else None)
                needs.append(int(zone_need(least_overlap(n, percent), percent)) if n else 0)
                zones.append(s[: prefix_length(n, percent) + zone_need(n, percent) - 1].view(np.int64) if n else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(needs, pa.int32()), pa.array(zones, pa.list_(pa.int64()))],
                names=[f.name for f in schema],
            )

    return text_batches(df).select(key, F.col(text).alias("text")).mapInArrow(lean(make), schema)


def possible(rows: DataFrame) -> DataFrame:
    """The staged feature rows that may link: enough of their zone's hashes occur
    in other rows too."""
    postings = rows.select("row", F.explode("zone").alias("hash"))
    shared = postings.groupBy("hash").count().where("count > 1").select("hash")
    enough = postings.join(shared, "hash").groupBy("row").count()
    return rows.drop("zone").join(enough, "row").where("count >= need").drop("count")


def whole_sets(documents: DataFrame, text: str, key: str, classes: DataFrame, width: int) -> DataFrame:
    """(class, size, hashes) of the classes: their texts are read again, hashed,
    and matched by fingerprint. `documents`' key is without nulls here."""
    ids = classes.select(F.col("first_id").alias(key)).distinct()
    few = classes.count() <= BROADCAST_IDS
    chosen = documents.join(F.broadcast(ids) if few else ids, key, "left_semi")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, int] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                cache = word_cache(cache)
                sets = [shingles(t, width, cache) for t in whole.column(0).slice(at, 1000).to_pylist()]
                prints = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                lists = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(prints, pa.binary()), lists], ["fingerprint", "hashes"])

    again = chosen.select(F.col(text).alias("text")).mapInArrow(lean(make), "fingerprint binary, hashes array<long>")
    matched = again.join(classes.select("fingerprint", "class", "size"), "fingerprint")
    # repeated ids bring the same set twice
    return matched.groupBy("class", "size").agg(F.max("hashes").alias("hashes"))


def subset_sizes(size: int, boundary: int, percent: int) -> list[tuple[int, int]]:
    """(larger size m, shared size c) of the pairs in which a set of this size is
    the smaller one, as far as m is small too."""
    return [(m, least_overlap(m, percent)) for m in range(size, min(boundary, size * 100 // percent) + 1)]


def scans_lists(size: int, boundary: int, percent: int) -> bool:
    """Whether a set of this size can have a partner above the boundary."""
    return size * 100 // percent > boundary


def choose_boundary(counts: dict[int, int], list_length: float, percent: int) -> int:
    """The size up to which enumerating subsets costs less than scanning lists:
    a subset key costs one step, a list one step and its mean length."""

    def cost(boundary: int) -> float:
        total = 0.0
        for size, n in counts.items():
            if size <= boundary:
                # as the smaller set it makes keys for each m, as the larger one for its own size
                total += n * sum(comb(size, c) for _, c in subset_sizes(size, boundary, percent))
            if scans_lists(size, boundary, percent):
                total += n * prefix_length(size, percent) * (1 + list_length)
        return total

    return min(range(0, LARGEST_SMALL + 1), key=lambda x: (cost(x), x))


def rare_postings(sets: DataFrame, percent: int) -> DataFrame:
    """(key, class, size, place): each class's prefix in order of rarity, and each
    element's place in that order. Elements of one class only come first; a class
    whose prefix is full of them has no posting, for it can link with nothing."""
    every = sets.select("class", "size", F.explode("hashes").alias("key"))
    shared = every.groupBy("key").count().where("count > 1")
    own = W.partitionBy("class")
    ranked = every.join(shared, "key").select(
        "key", "class", "size", F.row_number().over(own.orderBy("count", "key")).alias("rank"), F.count("*").over(own).alias("shared")
    )
    placed = ranked.withColumn("place", F.col("size") - F.col("shared") + F.col("rank"))
    return placed.where(F.col("place") <= prefix_sql(F.col("size"), percent)).select("key", "class", "size", "place")


def prefix_sql(size, percent: int):
    return size - F.floor((size * percent + 99) / 100) + 1


def subset_keys(hashes: np.ndarray, boundary: int, percent: int) -> np.ndarray:
    """Keys of a small set: any two small sets that link have one in common."""
    n = len(hashes)
    keys = [np.zeros(0, np.uint64)]
    mixed = mix(hashes + np.uint64(1))
    total = mixed.sum(dtype=np.uint64)
    for m, c in subset_sizes(n, boundary, percent):
        left_out = np.array(list(combinations(range(n), n - c)), np.intp).reshape(comb(n, c), n - c)
        part = total - mixed[left_out].sum(axis=1, dtype=np.uint64)
        keys.append(mix(part + np.uint64(m) * MULTIPLIER))
    return np.concatenate(keys)


def subset_postings(sets: DataFrame, boundary: int, percent: int) -> DataFrame:
    """(key, class, size, place) of the small sets' subsets; place says nothing."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [subset_keys(s, boundary, percent).view(np.int64) for s in rows_of(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.list_(pa.int64()))], ["class", "size", "keys"])

    small = sets.where(F.col("size") <= boundary).select("class", "size", "hashes")
    made = small.mapInArrow(lean(make), "class long, size long, keys array<long>")
    return made.select(F.explode("keys").alias("key"), "class", "size", F.lit(1).cast("long").alias("place"))


def rows_of(lists: pa.Array) -> list[np.ndarray]:
    """Each row's hashes."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    return np.split(flat, ends[:-1]) if len(lists) else []


def postings(sets: DataFrame, percent: int) -> DataFrame:
    """(key, class, size, place): the signatures of all classes; any two that
    link have a key in common at places that pass `may_link`."""
    lists = stage(rare_postings(sets, percent), "lists")
    lengths = lists.groupBy("key").count().agg(F.sum(F.col("count") * F.col("count")), F.sum("count")).first()
    sizes = {r["size"]: r["count"] for r in sets.where(F.col("size") <= 2 * LARGEST_SMALL).groupBy("size").count().collect()}
    boundary = choose_boundary(sizes, lengths[0] / lengths[1] if lengths[1] else 0.0, percent)
    scanned = lists.where(F.floor(F.col("size") * 100 / percent) > boundary)
    return stage(scanned.union(subset_postings(sets, boundary, percent)), "keys")


def may_link(percent: int):
    """Of a joined pair of postings: sizes close enough, and from the shared
    element on enough elements left. True for a linking pair's first shared
    element, because all it shares lies from there on."""
    size, size_b, place, place_b = (F.col(c) for c in ("size", "size_b", "place", "place_b"))
    close = (size * percent <= size_b * 100) & (size_b * percent <= size * 100)
    left = F.least(size - place, size_b - place_b) + 1
    return close & (left * (100 + percent) >= percent * (size + size_b))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(rows_of(batch.column(2)), rows_of(batch.column(3)), strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    whole_b = pairs.join(sets.select(F.col("class").alias("b"), F.col("hashes").alias("hashes_b")), "b")
    whole = whole_b.join(sets.select(F.col("class").alias("a"), F.col("hashes").alias("hashes_a")), "a")
    return whole.select("a", "b", "hashes_a", "hashes_b").mapInArrow(lean(check), "a long, b long")


def class_components(sets: DataFrame, keys: DataFrame, percent: int) -> DataFrame:
    """(node, component) of the classes that link with another."""
    spark = sets.sparkSession
    found = spark.createDataFrame([], "node long, component long")

    def apart() -> DataFrame:
        """Postings of the lists that still hold several components."""
        now = keys.join(found.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
        several = now.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
        return now.join(several, "key")

    links = None
    number = 0
    while True:
        rows = stage(apart(), "lists")
        if rows.isEmpty():
            return found
        last = number >= HUB_ROUNDS
        if not last:
            # a member with few elements of its own is near most of its group
            turn = F.col("place") * (unit_hash(F.col("class"), F.lit(number)) if number else F.lit(1.0))
            hub = rows.groupBy("key").agg(F.min(F.struct(turn.alias("turn"), "class", "size", "place", "component")).alias("hub"))
            other = hub.select("key", "hub.*").toDF("key", "turn", "b", "size_b", "place_b", "component_b")
        else:
            other = rows.toDF("key", *[c + "_b" for c in rows.columns[1:]]).withColumnRenamed("class_b", "b")
        pairs = rows.join(other, "key").where(may_link(percent) & (F.col("component") != F.col("component_b")))
        if last:
            pairs = pairs.where("class < b")
        new = stage(verified(pairs.select(F.col("class").alias("a"), "b").distinct(), sets, percent), "links")
        if not new.isEmpty():
            links = new if links is None else links.union(new)
            found = components(links)
        if last:
            return found
        # a round without a new link: go on to all that is left
        number = HUB_ROUNDS if new.isEmpty() else number + 1


def join(df: DataFrame, text: str, key: str, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row: the key, n_shingles and component_id, the smallest key that links
    reach from the row's set. Sets link when 100 * intersection >= percent * union.

    Null and empty texts have an empty set and link with nothing, so they keep
    their own key. Null keys take part; a component's id leaves them out. Equal
    texts, and repeated keys, link as any others. Other columns are not read."""
    source = df.select(F.col(key).alias("id"), F.col(text).alias("text"))
    no_id = F.lit(NO_ID).cast(source.schema["id"].dataType)
    rows = stage(features(source, "text", "id", width, percent).withColumn("row", F.monotonically_increasing_id()), "shingles")
    alike = stage(possible(rows), "alike")
    classes = stage(
        alike.groupBy("fingerprint", "size").agg(
            F.min("row").alias("class"), F.min("id").alias("least_id"), F.min(F.coalesce("id", no_id)).alias("first_id")
        ),
        "classes",
    )
    sets = stage(whole_sets(source.withColumn("id", F.coalesce("id", no_id)), "text", "id", classes, width), "sets")
    found = class_components(sets, postings(sets, percent), percent)
    placed = classes.join(found.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    smallest = placed.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_print = placed.join(smallest, "component").select("fingerprint", "component_id")
    out = rows.select("id", "size", "fingerprint").join(of_print, "fingerprint", "left")
    return out.select(F.col("id").alias(key), F.col("size").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def one_of_each(df: DataFrame, text: str, key: str, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of `df`, all columns, less the near copies: of each component the
    row with the smallest key, as its type orders it, stays (null keys come last;
    of rows with that key, one stays). Rows with an empty set all stay, but for
    repeated rows. Columns may have any names."""
    tag = free_name(df, "__tag")
    named = F.concat_ws(":", F.col(key).isNull().cast("int").cast("string"), F.col(key).cast("string"))
    tagged = df.withColumn(tag, F.concat_ws(":", named, F.hex(F.xxhash64(text)), F.length(text).cast("string")))
    joined = stage(join(tagged.select(F.col(tag).alias("tag"), F.col(text).alias("text")), "text", "tag", width, percent).select("tag", "component_id"), "components")
    # components of several different rows, few beside all rows
    several = joined.groupBy("component_id").agg(F.min("tag").alias("low"), F.max("tag").alias("high")).where("low <> high")
    members = joined.join(several.select("component_id"), "component_id", "left_semi").distinct()
    keys = tagged.select(F.col(tag).alias("tag"), F.col(key).alias("key")).join(members, "tag")
    first = F.min_by("tag", F.struct(F.col("key").isNull(), "key", "tag")).alias("first")
    losers = members.join(keys.groupBy("component_id").agg(first), "component_id").where("tag <> first")
    losers = stage(losers.select(F.col("tag").alias(tag)).distinct(), "losers")
    kept = tagged.join(F.broadcast(losers) if losers.count() <= BROADCAST_LOSERS else losers, tag, "left_anti")
    repeated = joined.groupBy("tag").count().where("count > 1").select(F.col("tag").alias(tag))
    if not repeated.isEmpty():
        kept = kept.join(repeated, tag, "left_anti").unionByName(kept.join(repeated, tag).dropDuplicates([tag]))
    return kept.select(*[F.col(f"`{c}`") for c in df.columns])
