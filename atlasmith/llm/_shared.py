"""Helpers of the training-data operators: inputs, row keys, stage tables and word rules."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of all word and line rules: space and 0x09 to 0x0D.
SPACE = " \t\n\x0b\x0c\r"
#: A word, for regular expressions that Java and RE2 both read.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Up to these sizes join_small sends a table to every executor; beyond, rows of a key are spread over SALTS tasks.
SMALL_ROWS, SMALL_BYTES, SALTS = 100_000, 16 << 20, 16
#: While a stage table is written, rows go to Python in batches of so many bytes: texts of 10,000 rows at once, Spark's bound, fill executors.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 2 << 20


def by_value(name: str) -> None:
    """Ship a module's functions inside tasks, so that executors need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def lower_ascii(column: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(column, UPPER, UPPER.lower())


def hash_pair(*columns: Column) -> list[Column]:
    """128 bits of hash as two longs, for keys that are too long to be shuffled themselves."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns)]


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    The cluster names it in spark.checkpoint.dir. Only a local master may leave that unset, as in tests.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
    return (named or "/tmp/checkpoints").rstrip("/")


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark hands rows to Python in batches of about BATCH_BYTES; then as before."""
    before = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


def stage_table(df: DataFrame, what: str) -> DataFrame:
    """Cut the lineage: write df as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._staged_at = path
    return staged


def drop_stage(df: DataFrame) -> None:
    """Delete a stage table that nothing reads any more."""
    path = getattr(df, "_staged_at", None)
    if path:
        spark = df.sparkSession
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def join_small(large: DataFrame, small: DataFrame, keys: list[str], how: str = "inner", spread: tuple[str, ...] = ()) -> DataFrame:
    """large joined with a table that has one row per key.

    small is counted first, in rows and bytes (it should be a stage table, or it is computed twice).
    Within SMALL_ROWS and SMALL_BYTES it goes whole to each executor. Beyond, both sides are shuffled;
    a key that many rows hold is then spread over SALTS tasks, by a hash of the spread columns.
    """
    size = small.agg(F.count("*").alias("n"), F.sum(F.length(F.to_json(F.struct("*")))).alias("bytes")).first()
    if size["n"] <= SMALL_ROWS and (size["bytes"] or 0) <= SMALL_BYTES:
        return large.join(F.broadcast(small), keys, how)
    if not spread:
        return large.join(small, keys, how)
    salted = large.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
