"""Batch-tagged loads: a batch can be repeated or taken back on its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def write_batches(tagged: DataFrame, target: str) -> None:
    """Replaces the batches that the rows name; others are not touched. The
    folders change only when the whole job commits."""
    (
        tagged.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(f"{target}/rows")
    )


def load_batch(rows: DataFrame, target: str, batch_id: int | str) -> None:
    """Writes the rows under their batch id. Repeating a batch replaces that
    batch only; other batches are not touched."""
    write_batches(rows.withColumn("batch_id", F.lit(batch_id)), target)
    log(rows.sparkSession, target, F.lit(str(batch_id)), "loaded", "")


def load_batches(tagged: DataFrame, target: str) -> None:
    """Loads every batch that the column batch_id names, in one job."""
    write_batches(tagged, target)
    written = tagged.sparkSession.read.parquet(f"{target}/rows").select("batch_id")
    ids = tagged.select("batch_id").distinct().join(written.distinct(), "batch_id")
    ids.select(*_entry(F.col("batch_id").cast("string"), "loaded", "")).write.mode("append").parquet(f"{target}/log")


def take_back_batch(spark: SparkSession, target: str, batch_id: int | str, error: str) -> None:
    """Removes the rows of that batch only, through the session's file system
    so that it works on any store, and logs why."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/rows/batch_id={batch_id}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    log(spark, target, F.lit(str(batch_id)), "taken back", error)


def run_batch(rows: DataFrame, target: str, batch_id: int | str) -> None:
    """Loads a batch; an error is logged whole. A load that fails commits
    nothing, so the rows of an earlier good load of the batch stay."""
    try:
        load_batch(rows, target, batch_id)
    except Exception as error:
        log(rows.sparkSession, target, F.lit(str(batch_id)), "failed", str(error))
        raise


def _entry(batch_id: Column, status: str, message: str) -> list[Column]:
    return [
        batch_id.alias("batch_id"),
        F.lit(status).alias("status"),
        F.lit(message).alias("message"),
        F.current_timestamp().alias("at"),
    ]


def log(spark: SparkSession, target: str, batch_id: Column, status: str, message: str) -> None:
    spark.range(1).select(*_entry(batch_id, status, message)).write.mode("append").parquet(f"{target}/log")
