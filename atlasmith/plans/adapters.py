"""The star-schema tables seen as activity, metadata, classification, locations and text.

Each view is plain DataFrame code over whole tables; sql.py has the same views for DuckDB.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasmith.sources.tables import read_table

WINDOW = datetime.date(1995, 1, 1), datetime.date(2001, 11, 30)
DOMAIN = "hardware"
TERMS = ["3", "7", "11", "15", "19", "23"]
#: Small tables, so smaller (and, for the long window, larger) minimums than in production.
MINIMUMS = {"unique_human_contributors": 150, "meaningful_events": 490, "pull_requests_or_reviews": 115, "active_months": 70}
SAMPLES = {"country": (3, 2, 2), "city": (2, 2, 2)}
TAXONOMY = [
    *((DOMAIN, "fasteners", "topic", x) for x in ("standard", "small")), *((DOMAIN, "fasteners", "term", x) for x in ("bolt", "rod", "red bolt")),
    (DOMAIN, "fasteners", "negative", "old"), (DOMAIN, "fasteners", "language", "Brand#2"), (DOMAIN, "fasteners", "signal", "has_ci"),
    *((DOMAIN, "machines", "topic", x) for x in ("economy", "promo", "large")), *((DOMAIN, "machines", "term", x) for x in ("gear", "gizmo", "hot gizmo", "widget")),
    (DOMAIN, "machines", "negative", "cold"), (DOMAIN, "machines", "language", "Brand#4"), (DOMAIN, "machines", "signal", "has_tests_signal"),
    (DOMAIN, "plates", "topic", "medium"), (DOMAIN, "plates", "term", "plate"), (DOMAIN, "plates", "term", "anvil"),
]


def act_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as public activity: supplier is the repository, customer the actor."""
    line = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    kinds = {"NO": "PushEvent", "RO": "PullRequestEvent", "RF": "PullRequestReviewEvent", "NF": "IssuesEvent", "AF": "IssueCommentEvent", "AO": "ReleaseEvent"}
    kind = F.concat("l_returnflag", "l_linestatus")
    kind = F.coalesce(*(F.when(kind == k, F.lit(v)) for k, v in kinds.items()))
    action = F.when(F.col("o_orderstatus") == "F", "closed").when(F.col("o_orderstatus") == "O", "opened").otherwise("merged")
    actor = (
        F.when(F.col("o_custkey") % 37 == 0, F.concat(F.lit("c"), "o_custkey", F.lit("[bot]"))).when(F.col("o_custkey") % 41 == 0, F.concat(F.lit("build-bot-"), "o_custkey"))
        .otherwise(F.concat(F.lit("c"), "o_custkey"))
    )
    payload = F.concat(
        F.lit('{"action":"'), action, F.when(F.col("l_linenumber") % 3 == 0, '","size":').otherwise('","distinct_size":'), F.col("l_quantity").cast("int"), F.lit(',"pull_request":{"merged":'),
        F.when(F.col("l_linenumber") % 2 == 0, "true").otherwise("false"), F.lit("}}"),
    )
    joined = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return joined.select(
        F.concat(F.lit("NATION_"), "s_nationkey", F.lit("/"), "s_name").alias("repo_name"), actor.alias("actor_login"), kind.alias("type"), F.col("l_shipdate").alias("created_at"), payload.alias("payload")
    )


def repo_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A part as metadata of the supplier of the same number."""
    part, supplier = read_table(spark, sf_dir, "part"), read_table(spark, sf_dir, "supplier")
    size = F.col("p_size")
    return supplier.join(part, F.col("s_suppkey") == F.col("p_partkey")).select(
        F.concat(F.lit("NATION_"), "s_nationkey", F.lit("/"), "s_name").alias("repo_name"), F.col("p_name").alias("description"), (size % 17 == 0).alias("is_fork"), (size % 19 == 0).alias("is_archived"),
        F.lit(False).alias("is_disabled"), F.col("p_brand").alias("primary_language"), F.array(F.lower("p_type")).alias("topics"), size.cast("long").alias("release_count"),
        F.when(size % 3 == 0, "MIT").when(size % 3 == 1, "Apache-2.0").alias("license_spdx_id"), F.when(size % 5 > 0, size % 2 == 0).alias("has_ci"), (size % 4 == 0).alias("has_tests_signal"),
        F.when(size % 7 > 0, size % 3 == 0).alias("has_contributing"), F.lit(None).cast("boolean").alias("has_code_of_conduct"),
    )


def taxonomy(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TAXONOMY, "domain_id string, subdomain_id string, kind string, item string")


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A classification by part type and size, for the score stages."""
    part, supplier = read_table(spark, sf_dir, "part"), read_table(spark, sf_dir, "supplier")
    size, topic, name = F.col("p_size"), F.lower("p_type"), F.split("p_name", " ")
    return supplier.join(part, F.col("s_suppkey") == F.col("p_partkey")).select(
        F.concat(F.lit("NATION_"), "s_nationkey", F.lit("/"), "s_name").alias("repo_name"), F.lit(DOMAIN).alias("domain_id"), F.array_sort(F.array(topic, F.get(name, F.lit(1)))).alias("subdomains"),
        size.cast("double").alias("classification_score"), F.when(size % 6 > 0, "accepted").otherwise("rejected").alias("classification_status"),
        F.array(topic).alias("evidence_topics"), F.when(size % 2 == 0, name).otherwise(F.array().cast("array<string>")).alias("evidence_terms"),
        F.array().cast("array<string>").alias("evidence_files"), F.when(size % 4 == 0, F.array(F.lit("negative_term:x"))).otherwise(F.array().cast("array<string>")).alias("negative_evidence"),
    )


def actor_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a country, a market segment as city, and a confidence."""
    c, k = read_table(spark, sf_dir, "customer"), F.col("c_custkey") % 4
    some = k < 3
    return c.select(
        F.concat(F.lit("c"), "c_custkey").alias("actor_login"), F.when(some, F.concat(F.lit("N"), "c_nationkey")).alias("normalized_country_code"), F.when(k < 2, F.col("c_mktsegment")).alias("normalized_city"),
        F.when(k < 2, "city").when(k == 2, "country").otherwise("unresolved").alias("location_level"), F.when(k < 2, "high").when(k == 2, "medium").otherwise("unusable").alias("location_confidence"),
    )


def actor_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actor_geo(spark, sf_dir).where("normalized_country_code is not null").select("actor_login", F.col("normalized_country_code").alias("country_code"))


def country_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "nation").select(F.concat(F.lit("N"), "n_nationkey").alias("country_code"), F.col("n_name").alias("country_name"))


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(F.concat(F.lit("documents/"), "doc_id").alias("file"), "text")
    pages = read_table(spark, sf_dir, "pages").select(F.concat(F.lit("pages/"), "page_id").alias("file"), F.col("html").alias("text"))
    return docs.unionByName(pages)
