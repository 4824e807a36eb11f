"""Shared by the operators: whole-table readers, held-out folds, class samples."""

from __future__ import annotations

import contextlib
import ctypes
import os
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# one BLAS or tokenizer thread per task: Spark already runs one task per core
ONE_THREAD = {"OMP_NUM_THREADS": "1", "OPENBLAS_NUM_THREADS": "1", "TOKENIZERS_PARALLELISM": "false"}


#: Rows of an Arrow batch that holds texts. Spark's own default suits short rows;
#: ten thousand texts at once fill a worker, and the JVM's buffers beside it.
TEXT_ROWS = 1000


def text_batches(df: DataFrame) -> DataFrame:
    """The same rows; from now on the session sends at most TEXT_ROWS at a time to
    Python, or fewer where it says so already."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= TEXT_ROWS:
        conf.set(name, str(TEXT_ROWS))
    return df


Batches = Iterator[pa.RecordBatch]


def lean(work: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """For a function given to mapInArrow: when its task ends, freed memory goes
    back to the system. Workers are used again and live beside the executor's JVM;
    what their allocators keep would otherwise count against its memory."""

    @wraps(work)
    def run(batches: Batches) -> Batches:
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # glibc only
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return run


def single_threaded() -> None:
    """For the start of a Python task, before a native library is loaded."""
    for name, value in ONE_THREAD.items():
        os.environ.setdefault(name, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def schema_with(df: DataFrame, keep: list[str], ddl: str) -> T.StructType:
    """The schema of the columns `keep`, then those of `ddl`, under new names."""
    added = T.StructType.fromDDL(ddl)
    if clash := set(keep) & set(added.names):
        raise ValueError(f"kept columns have the names of results: {sorted(clash)}")
    return T.StructType(df.select(*keep).schema.fields + added.fields)


def free_name(df: DataFrame, stem: str) -> str:
    """A name that no column of `df` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null ids count as remainder 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(0))


def held_out(doc_id: Column, modulus: int) -> Column:
    return remainder(doc_id, modulus) == 2


def unit_hash(*columns: Column) -> Column:
    """A repeatable number in [0, 1) for each row's key."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))


def class_sample(rows: DataFrame, label: str, key: str, per_class: int) -> DataFrame:
    """About `per_class` rows of each label value (all, if fewer), chosen by a
    hash of `key`; never over twice that for all classes together. Labels are
    the output classes of a model, so their counts fit the driver."""
    sizes = {r[0]: r[1] for r in rows.where(F.col(label).isNotNull()).groupBy(label).count().collect()}
    if not sizes:
        return rows.limit(0)
    counts = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])
    ranked = rows.withColumn("sample_rank", unit_hash(F.col(key)) * counts[F.col(label)])
    chosen = ranked.where(F.col("sample_rank") < per_class)
    return chosen.orderBy("sample_rank", key).limit(2 * per_class * len(sizes)).drop("sample_rank")


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The rows of a written table counts(word, n) with n from the least value on
    of which at most `most` rows exist, to a sixteenth of a power of two. Only a
    histogram of those steps comes to the driver; nothing is sorted."""
    step = F.floor(F.log2("n") * 16).alias("step")
    total, least = 0, None
    for row in sorted(counts.groupBy(step).count().collect(), reverse=True):
        total += row["count"]
        if total > most:
            break
        least = row["step"]
    return counts.where(step >= least) if least is not None else counts.limit(0)
