"""Scans, stage tables, landed API responses and published files."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atlasmith import settings as C
from atlasmith.functions import expressions as X
from atlasmith.sources import snapshots

#: Buckets of tables that take upserts.
BUCKETS = 64
EVENT_COLUMNS = ("repo_name", "actor_login", "type", "created_at", "payload")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: a table in the folder that the cluster shares (spark.checkpoint.dir), read back."""
    path = snapshots.fresh(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scan_events(events: DataFrame) -> DataFrame:
    """The five columns and six types that count; both reach the Parquet scan."""
    return events.select(*EVENT_COLUMNS).where(F.col("type").isin(*C.EVENT_TYPES))


def months_in_window(spark: SparkSession, start: datetime.date, end: datetime.date) -> DataFrame:
    if start > end:
        raise ValueError(f"window starts at {start}, after its end {end}")
    bounds = F.sequence(F.trunc(F.lit(start), "MM"), F.trunc(F.lit(end), "MM"), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(bounds).alias("d")).select(X.month_of("d").alias("month"))


def grid_union(grid: DataFrame, months: list[int]) -> DataFrame:
    """Rows of these months; month is the partition column, so other months aren't read."""
    return grid.where(F.col("month").isin(*months))


def materialize_months(grid: DataFrame, path: str) -> DataFrame:
    """Append months that the table doesn't have yet; return the months written."""
    done = snapshots.append_months(grid, path)
    return grid.sparkSession.createDataFrame([(m,) for m in done], "month int")


def refresh_table(df: DataFrame, path: str) -> DataFrame:
    """Replace the table by df, as a whole or not at all; df may read it."""
    return snapshots.replace_table(df, path)


write_stage_parquet = refresh_table


def read_stage_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A stage table as it was last written."""
    df = snapshots.read_snapshot(spark, path)
    if df is None:
        raise FileNotFoundError(path)
    return df.select(*columns) if columns else df


def human_grid_view(grid: DataFrame, name: str | None = None) -> DataFrame:
    view = grid.where(~F.col("is_bot")).drop("is_bot", "bot_pattern")
    if name:
        view.createOrReplaceTempView(name)
    return view


def export_contract(df: DataFrame, columns: list[str]) -> DataFrame:
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*columns)


def export_summary(discovery: DataFrame, path: str) -> DataFrame:
    return refresh_table(discovery, path)


def candidates(discovery: DataFrame) -> DataFrame:
    return discovery.where(F.col("discovery_status").isin("accepted", "excluded"))


def export_candidates(discovery: DataFrame, path: str) -> DataFrame:
    """Write the candidates; return counts by status."""
    return refresh_table(candidates(discovery), path).agg(F.count_if(F.col("discovery_status") == "accepted").alias("accepted"), F.count_if(F.col("discovery_status") == "excluded").alias("excluded"))


def with_subdomains(activity: DataFrame) -> DataFrame:
    return activity.withColumn("subdomains", F.array().cast("array<string>"))


def export_contributors(activity: DataFrame, path: str) -> DataFrame:
    return refresh_table(with_subdomains(activity), path)


def read_dim_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV whose header must have exactly these names; empty fields are null."""
    header = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    names = [f.name for f in T._parse_datatype_string(schema).fields]
    if header != names:
        raise ValueError(f"{path}: header {header}, expected {names}")
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    return df.select(*(F.when(F.trim(F.col(c)) == "", None).otherwise(F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes))


# Landed API responses: one JSON object per batch, {"data": {alias: node}, "errors": [...]}

REPO_NODE = """nameWithOwner string, description string, isFork boolean, isArchived boolean, isDisabled boolean, primaryLanguage struct<name:string>,
 repositoryTopics struct<nodes:array<struct<topic:struct<name:string>>>>, stargazerCount bigint, forkCount bigint, licenseInfo struct<spdxId:string>,
 pushedAt timestamp, updatedAt timestamp, releases struct<totalCount:bigint>, issues struct<totalCount:bigint>, pullRequests struct<totalCount:bigint>"""
SIGNALS = {"has_readme": "readme", "has_contributing": "contributing", "has_code_of_conduct": "codeOfConduct", "has_ci": "workflows", "has_tests_signal": "tests"}


def landed_nodes(landed: DataFrame) -> DataFrame:
    """(alias, node JSON or null) from (response, fetched_at)."""
    nodes = F.from_json(F.get_json_object("response", "$.data"), "map<string,string>")
    return landed.select("fetched_at", F.explode(nodes).alias("alias", "node"))


def flatten_repo_nodes(nodes: DataFrame) -> DataFrame:
    """Repository metadata rows; a content signal that the node doesn't have stays null."""
    keys = F.from_json("node", "map<string,string>")
    parsed = nodes.where("node is not null").withColumn("n", F.from_json("node", REPO_NODE)).withColumn("keys", keys)
    signals = {name: F.when(F.map_contains_key("keys", key), F.element_at("keys", F.lit(key)).isNotNull()) for name, key in SIGNALS.items()}
    return parsed.where("n.nameWithOwner is not null").select(
        F.col("n.nameWithOwner").alias("repo_name"), "n.description", F.col("n.isFork").alias("is_fork"), F.col("n.isArchived").alias("is_archived"),
        F.col("n.isDisabled").alias("is_disabled"), F.col("n.primaryLanguage.name").alias("primary_language"),
        F.coalesce(F.transform("n.repositoryTopics.nodes", lambda x: x.topic["name"]), F.array().cast("array<string>")).alias("topics"),
        F.col("n.stargazerCount").alias("stargazer_count"), F.col("n.forkCount").alias("fork_count"), F.col("n.licenseInfo.spdxId").alias("license_spdx_id"),
        F.col("n.pushedAt").alias("pushed_at"), F.col("n.updatedAt").alias("updated_at"), F.coalesce("n.releases.totalCount", F.lit(0)).alias("release_count"),
        F.coalesce("n.issues.totalCount", F.lit(0)).alias("issue_count"), F.coalesce("n.pullRequests.totalCount", F.lit(0)).alias("pull_request_count"),
        *(c.alias(name) for name, c in signals.items()), F.col("fetched_at").alias("graphql_fetched_at"),
    )


def flatten_user_nodes(nodes: DataFrame) -> DataFrame:
    """Profile rows. nodes: (actor_login, node, fetched_at); null: not found; organisations have no location."""
    n = F.from_json("node", "__typename string, login string, location string, createdAt timestamp, followers struct<totalCount:bigint>")
    kind = F.when(F.col("node").isNull(), "unknown").otherwise(F.col("n.__typename"))
    user = F.col("n.__typename") == "User"
    return nodes.withColumn("n", n).select(
        "actor_login", kind.alias("account_type"), F.when(user, F.col("n.location")).alias("public_location_raw"), F.when(user, F.col("n.createdAt")).alias("created_at"),
        F.when(user, F.col("n.followers.totalCount")).alias("followers_count"), F.col("fetched_at").alias("profile_fetched_at"),
        F.when(F.col("node").isNull(), "not_found").otherwise("success").alias("fetch_status"),
    )


def upsert_latest(old: DataFrame, new: DataFrame, key: str, ts: str) -> DataFrame:
    """One row per key, the latest; on equal times the new row."""
    both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    first = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(ts), F.desc("__new")))
    return both.withColumn("__rank", first).where("__rank = 1").drop("__rank", "__new")


def merge_latest(new: DataFrame, path: str, key: str, ts: str, buckets: int = BUCKETS) -> DataFrame:
    """Keep the latest row per key in a bucketed table; buckets without new rows are neither read nor written.

    new may have several rows of a key. The table as it is then.
    """
    return snapshots.merge_table(new, path, [key], buckets, lambda old, rows: upsert_latest(old, rows, key, ts))


def quarantine_nodes(nodes: DataFrame, errors: DataFrame) -> DataFrame:
    """(key, reason) of nodes that are missing. nodes: (alias, key, node); errors: (alias, type, message)."""
    reason = F.substring(F.coalesce("type", "message", F.lit("MISSING")), 1, 200)
    return nodes.where("node is null").join(errors, "alias", "left").select("key", reason.alias("reason"))


def error_rate_gate(failures: DataFrame, attempted: int | Column, most: float = 0.01, min_sample: int = 100) -> DataFrame:
    """One row: attempted, failed (permanent ones aside) and ok."""
    counted = failures.agg(F.count_if(F.col("reason") != "NOT_FOUND").alias("failed")).withColumn("attempted", F.lit(attempted).cast("long") if isinstance(attempted, int) else attempted)
    return counted.withColumn("ok", (F.col("attempted") < min_sample) | (F.col("failed") <= most * F.col("attempted")))


def retry_worklist(worklist: DataFrame, done: DataFrame, failed: DataFrame, key: str, max_retries: int = 3, limit: int | None = None) -> DataFrame:
    """Pending keys: neither done, nor failed for good or too often. failed: (key, reason, retries)."""
    over = failed.where((F.col("reason") == "NOT_FOUND") | (F.col("retries") >= max_retries))
    pending = worklist.select(key).distinct().join(done.select(key), key, "left_anti").join(over.select(key), key, "left_anti")
    return pending.orderBy(key).limit(limit) if limit else pending


def exhausted_failures(worklist: DataFrame, failed: DataFrame, key: str, cap: int = 3) -> DataFrame:
    return failed.where((F.col("retries") >= cap) & (F.col("reason") != "NOT_FOUND")).join(worklist.select(key), key, "left_semi").select(key, "reason")


def json_row(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Key-sorted camel-case JSON of a row, doubles rounded to four digits, nulls kept."""
    kinds = dict(df.dtypes)
    named = {X.camel_case(c): X.round4(c) if kinds[c] == "double" else F.col(c) for c in columns or df.columns}
    return F.to_json(F.struct(*(named[k].alias(k) for k in sorted(named))), {"ignoreNullFields": "false"})


def publish_json(rows: DataFrame, path: str, scan: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Publish (geo_level, file, payload) as a file each, after scan has read the files; the published set, or PrivateData."""
    return snapshots.publish_files(rows, path, scan)
