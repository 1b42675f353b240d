"""Tables and published files that are replaced as a whole or not at all.

A table is a folder of data folders and of numbered commits. A commit names the data folders that are
the table (by bucket, if it has buckets) and its schema; the commit of the highest number counts. Data is
written first, to a folder of its own, by Spark; the commit is then one rename, which fails if
another writer has taken its number. So a write that breaks leaves the table as it was, readers of
the old folders go on, and a table can be written from what it was. Folders that no recent
commit names are deleted by the next write.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Commits that readers may still use.
KEPT = 2
#: Part of a published set whose rows are one file.
FILE = "file"


class Conflict(Exception):
    """Another writer has committed first."""


class PrivateData(Exception):
    """Files hold private data and were not published."""

    def __init__(self, violations: int):
        super().__init__(f"{violations} lines of published text hold private data")
        self.violations = violations


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir.

    Only a local master may leave it unset, as in tests; a cluster's machines share no folder by default.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
    return (named or "/tmp/checkpoints").rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _path(spark: SparkSession, path: str):  # noqa: ANN202
    """A Hadoop file system and a path in it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _path(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _path(spark, path)
    fs.delete(target, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if there is no folder."""
    fs, target = _path(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(target)) if fs.exists(target) else []


def stamp(spark: SparkSession, path: str) -> tuple[int, int]:
    """The time of a file or folder's last change and its size, or of a folder the latest and the sum of what is in it."""
    fs, target = _path(spark, path)
    if not fs.exists(target):
        return 0, 0
    found = [fs.getFileStatus(target), *fs.listStatus(target)]
    return max(x.getModificationTime() for x in found), sum(x.getLen() for x in found)


def put(spark: SparkSession, path: str, text: str) -> None:
    """A small file, complete or not there: written under another name, then renamed; Conflict if the name is taken."""
    fs, part = _path(spark, f"{path}.{uuid.uuid4().hex}.part")
    out = fs.create(part, False)
    out.write(bytearray(text.encode()))
    out.close()
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(part, target, options)
    except Exception as error:
        fs.delete(part, False)
        if "FileAlreadyExistsException" in str(error):
            raise Conflict(path) from None
        raise


def get(spark: SparkSession, path: str) -> str:
    fs, target = _path(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


# Commits


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(n) for n in names(spark, f"{path}/commits") if n.isdigit()]


def current(spark: SparkSession, path: str) -> tuple[int, dict] | None:
    """The number and content of the commit that counts: {"folders": {bucket or "": folder}, "schema": ...}."""
    found = _numbers(spark, path)
    return (max(found), json.loads(get(spark, f"{path}/commits/{max(found):012d}"))) if found else None


def commit(spark: SparkSession, path: str, before: int, folders: dict[str, str], schema: T.StructType) -> None:
    """Make these folders the table, if its last commit is still number before; then delete what no kept commit names."""
    put(spark, f"{path}/commits/{before + 1:012d}", json.dumps({"folders": folders, "schema": schema.jsonValue()}, sort_keys=True))
    numbers = sorted(_numbers(spark, path))
    used = {f.split("/")[0] for n in numbers[-KEPT:] for f in json.loads(get(spark, f"{path}/commits/{n:012d}"))["folders"].values()}
    gone = {f.split("/")[0] for n in numbers[:-KEPT] for f in json.loads(get(spark, f"{path}/commits/{n:012d}"))["folders"].values()} - used
    for n in numbers[:-KEPT]:
        delete(spark, f"{path}/commits/{n:012d}")
    for folder in gone:
        delete(spark, f"{path}/data/{folder}")


def read_snapshot(spark: SparkSession, path: str, buckets: Iterable[int] | None = None) -> DataFrame | None:
    """The table as of its last commit, or some of its buckets; None if there is none."""
    found = current(spark, path)
    if found is None:
        return None
    folders = found[1]["folders"]
    wanted = folders.values() if buckets is None else [folders[str(b)] for b in buckets if str(b) in folders]
    schema = T.StructType.fromJson(found[1]["schema"])
    return spark.read.schema(schema).parquet(*(f"{path}/data/{f}" for f in sorted(wanted))) if wanted else spark.createDataFrame([], schema)


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Replace the table by df, which may read it; the table as it is then."""
    spark = df.sparkSession
    before = (current(spark, path) or (0, None))[0]
    folder = uuid.uuid4().hex
    df.write.parquet(f"{path}/data/{folder}")
    commit(spark, path, before, {"": folder}, df.schema)
    return read_snapshot(spark, path)


def replace_split(rows: DataFrame, good: Column, path: str, columns: list[str], gate: Callable[[str], None]) -> DataFrame:
    """Replace the table by the good rows, written in one pass with the others, unless gate raises.

    gate is called with the folder of the other rows once all are written. They stay there in either case.
    """
    spark = rows.sparkSession
    before = (current(spark, path) or (0, None))[0]
    folder = uuid.uuid4().hex
    rows.withColumn("__good", good).write.partitionBy("__good").parquet(f"{path}/data/{folder}")
    for part in ("true", "false"):
        fs, target = _path(spark, f"{path}/data/{folder}/__good={part}")
        fs.mkdirs(target)
    gate(f"{path}/data/{folder}/__good=false")
    commit(spark, path, before, {"": f"{folder}/__good=true"}, rows.select(*columns).schema)
    return read_snapshot(spark, path)


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def merge_table(new: DataFrame, path: str, keys: list[str], buckets: int, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """Merge rows into a table of so many hash buckets; the table as it is then.

    merge(old, new) sees the touched buckets alone, and gives their new rows. The others keep their
    files. A table keeps the number of buckets that it was made with.
    """
    spark = new.sparkSession
    found = current(spark, path)
    before, folders = (found[0], found[1]["folders"]) if found else (0, {})
    rows = new.withColumn("__bucket", bucket_of(keys, buckets))
    touched = sorted(r[0] for r in rows.select("__bucket").distinct().collect())  # at most buckets
    old = read_snapshot(spark, path, touched) if found else spark.createDataFrame([], new.schema)
    folder = uuid.uuid4().hex
    merged = merge(old, new).select(*new.columns).withColumn("__bucket", bucket_of(keys, buckets))
    # A bucket is one task's, and with it one file.
    merged.repartition("__bucket").write.partitionBy("__bucket").parquet(f"{path}/data/{folder}")
    written = {n.split("=")[1] for n in names(spark, f"{path}/data/{folder}") if n.startswith("__bucket=")}
    now = {k: v for k, v in folders.items() if int(k) not in touched} | {b: f"{folder}/__bucket={b}" for b in written}
    commit(spark, path, before, now, new.schema)
    return read_snapshot(spark, path)


# Months


def committed_months(spark: SparkSession, path: str) -> list[int]:
    return [int(n) for n in names(spark, f"{path}/_months") if n.isdigit()]


def append_months(df: DataFrame, path: str) -> list[int]:
    """Write the months of df that are not committed yet; return them.

    Months are partitions, overwritten one by one, and a month counts once its marker is there. What a
    broken run has left of a month is overwritten, so no row is there twice; committed months are neither read
    nor written.
    """
    spark = df.sparkSession
    new = df.where(~F.col("month").isin(committed_months(spark, path)))
    done = sorted(r[0] for r in new.select("month").distinct().collect())  # a row per month
    if done:
        new.write.partitionBy("month").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{path}/rows")
    for month in done:
        put(spark, f"{path}/_months/{month}", "")
    return done


def read_months(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of committed months alone."""
    months = committed_months(spark, path)
    if not months:
        return spark.createDataFrame([], schema)
    last = T.StructType([*(f for f in schema if f.name != "month"), schema["month"]])
    return spark.read.schema(last).parquet(f"{path}/rows").where(F.col("month").isin(months)).select(*schema.names)


# Published files


def read_files(spark: SparkSession, path: str) -> DataFrame | None:
    """(geo_level, file, text) of the published set, a line of text per file; None if nothing was published."""
    found = current(spark, path)
    return _files(spark, f"{path}/data/{found[1]['folders']['']}") if found else None


def _files(spark: SparkSession, folder: str) -> DataFrame:
    schema = T.StructType([T.StructField("text", T.StringType()), T.StructField("geo_level", T.StringType()), T.StructField(FILE, T.StringType())])
    if not any(n.startswith("geo_level=") for n in names(spark, folder)):
        return spark.createDataFrame([], schema).select("geo_level", FILE, "text")
    return spark.read.schema(schema).text(folder).select("geo_level", FILE, "text")


def publish_files(rows: DataFrame, path: str, scan: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Publish (geo_level, file, payload) as a file each, if scan finds nothing in the files as written.

    Files are written to a folder of their own and read back for the scan. Then one commit makes them the published set,
    or PrivateData is raised and the set that was published before stays.
    """
    spark = rows.sparkSession
    before = (current(spark, path) or (0, None))[0]
    folder = uuid.uuid4().hex
    files = rows.select("geo_level", FILE, F.col("payload").alias("text"))
    files.repartition("geo_level", FILE).write.partitionBy("geo_level", FILE).text(f"{path}/data/{folder}")
    lines = _files(spark, f"{path}/data/{folder}").select(F.concat_ws("/", "geo_level", FILE).alias(FILE), "text")
    violations = scan(lines).count()
    if violations:
        delete(spark, f"{path}/data/{folder}")
        raise PrivateData(violations)
    commit(spark, path, before, {"": folder}, files.schema)
    return read_files(spark, path)
