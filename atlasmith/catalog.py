"""All queries of the analytics part, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from atlasmith import settings as C
from atlasmith.functions import expressions as X
from atlasmith.functions import stats
from atlasmith.operators import classify, discovery, locations, publish, quality, scores
from atlasmith.plans import adapters as A
from atlasmith.plans import gazetteer
from atlasmith.plans import sql as Q
from atlasmith.plans.stages import Stages, stages
from atlasmith.sources import tables as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to four digits, arrays joined: comparable between engines."""
    def shown(c: str, t: str) -> Column:
        return F.round(c, 4).alias(c) if t == "double" else F.array_join(c, "|").alias(c) if t.startswith("array<string") else F.col(c)

    return df.select(*(shown(c, t) for c, t in df.dtypes))


def add(name: str, make: Callable[[Stages], DataFrame], select: str | None = None, doubles: str = "") -> None:
    QUERIES[name] = lambda spark, sf_dir: rounded(make(stages(spark, sf_dir)))
    if select is not None:
        whole = Q.query(select)
        ORACLES[name] = f"SELECT * REPLACE ({', '.join(f'round({c}, 4) AS {c}' for c in doubles.split())}) FROM ({whole})" if doubles else whole


def table(s: Stages, name: str) -> DataFrame:
    return T.read_table(s.spark, s.sf_dir, name)


# 2.1 scans, sources, sinks

add("scan_events", lambda s: s.events.groupBy("type").agg(F.count("*").alias("n")), "SELECT type, count(*) AS n FROM act_events WHERE type IS NOT NULL GROUP BY 1")
add("months_in_window", lambda s: T.months_in_window(s.spark, *A.WINDOW).join(s.grid.groupBy("month").agg(F.count("*").alias("rows")), "month", "left").select("month", F.coalesce("rows", F.lit(0)).alias("rows")),
    f"SELECT month, count(repo_name) AS rows FROM (SELECT CAST(year(m) * 100 + month(m) AS INTEGER) AS month FROM (SELECT unnest(range(date_trunc('month', DATE '{A.WINDOW[0]}'), DATE '{A.WINDOW[1]}' + INTERVAL 1 DAY, INTERVAL 1 MONTH)) AS m)) LEFT JOIN grid USING (month) GROUP BY 1")
_window = [y * 100 + m for y in range(A.WINDOW[0].year, A.WINDOW[1].year + 1) for m in range(1, 13) if (A.WINDOW[0].year, A.WINDOW[0].month) <= (y, m) <= (A.WINDOW[1].year, A.WINDOW[1].month)]
add("grid_union", lambda s: T.grid_union(s.grid, _window).groupBy("month").agg(F.count("*").alias("n")), f"SELECT month, count(*) AS n FROM grid WHERE month BETWEEN {_window[0]} AND {_window[-1]} GROUP BY 1")
add("human_grid_view", lambda s: T.human_grid_view(s.grid).groupBy("repo_name").agg(F.count("*").alias("n")), "SELECT repo_name, count(*) AS n FROM grid WHERE NOT is_bot GROUP BY 1")
add("export_contract", lambda s: T.export_contract(s.contributors, ["actor_login", "repo_name", "domain_id", "push_events", "raw_contribution_points"]), "SELECT actor_login, repo_name, domain_id, push_events, raw_contribution_points FROM contributor", "raw_contribution_points")


def _landed(s: Stages) -> DataFrame:
    """Suppliers with parts as landed API responses, one object each; every thirteenth node is null."""
    m = s.metadata
    node = F.to_json(F.struct(
        F.col("repo_name").alias("nameWithOwner"), "description", F.col("is_fork").alias("isFork"), F.struct(F.col("primary_language").alias("name")).alias("primaryLanguage"),
        F.struct(F.transform("topics", lambda t: F.struct(F.struct(t.alias("name")).alias("topic"))).alias("nodes")).alias("repositoryTopics"),
        F.struct(F.col("license_spdx_id").alias("spdxId")).alias("licenseInfo"), F.struct(F.col("release_count").alias("totalCount")).alias("releases"),
        F.when(F.col("has_ci"), F.struct(F.lit("x").alias("oid"))).alias("workflows"),
    ))
    lost = F.col("release_count") % 13 == 0
    return m.select("repo_name", lost.alias("lost"), F.concat(F.lit('{"data":{"r0":'), F.when(lost, "null").otherwise(node), F.lit("}}")).alias("response"), F.lit("2026-08-01").cast("timestamp").alias("fetched_at"))


add("flatten_repo_nodes", lambda s: T.flatten_repo_nodes(T.landed_nodes(_landed(s))).select("repo_name", "description", "is_fork", "primary_language", "topics", "license_spdx_id", "release_count", "has_ci"),
    "SELECT repo_name, description, is_fork, primary_language, topic AS topics, license_spdx_id, release_count, CASE WHEN has_ci THEN true END AS has_ci FROM repo_meta WHERE release_count % 13 > 0")
add("quarantine_nodes", lambda s: T.quarantine_nodes(_landed(s).select(F.col("repo_name").alias("alias"), F.col("repo_name").alias("key"), F.when(~F.col("lost"), F.col("response")).alias("node")), s.metadata.where("is_fork").select(F.col("repo_name").alias("alias"), F.lit("NOT_FOUND").alias("type"), F.lit("gone").alias("message"))),
    "SELECT repo_name AS key, CASE WHEN is_fork THEN 'NOT_FOUND' ELSE 'MISSING' END AS reason FROM repo_meta WHERE release_count % 13 = 0")
add("flatten_user_nodes", lambda s: T.flatten_user_nodes(table(s, "customer").select(
        F.concat(F.lit("c"), "c_custkey").alias("actor_login"), F.lit(None).cast("timestamp").alias("fetched_at"),
        F.when(F.col("c_custkey") % 5 > 0, F.to_json(F.struct(F.when(F.col("c_custkey") % 5 == 1, "Organization").otherwise("User").alias("__typename"), F.col("c_mktsegment").alias("location"), F.struct(F.col("c_nationkey").cast("long").alias("totalCount")).alias("followers")))).alias("node"),
    )).select("actor_login", "account_type", "public_location_raw", "followers_count", "fetch_status"),
    "SELECT 'c' || c_custkey AS actor_login, CASE c_custkey % 5 WHEN 0 THEN 'unknown' WHEN 1 THEN 'Organization' ELSE 'User' END AS account_type, CASE WHEN c_custkey % 5 > 1 THEN c_mktsegment END AS public_location_raw, CASE WHEN c_custkey % 5 > 1 THEN CAST(c_nationkey AS BIGINT) END AS followers_count, CASE WHEN c_custkey % 5 = 0 THEN 'not_found' ELSE 'success' END AS fetch_status FROM customer")


def _failed(s: Stages) -> DataFrame:
    return s.metadata.where("is_fork or is_archived").select("repo_name", F.when(F.col("is_fork"), "NOT_FOUND").otherwise("TIMEOUT").alias("reason"), (F.col("release_count") % 5).alias("retries"))


add("error_rate_gate", lambda s: T.error_rate_gate(_failed(s), s.metadata.count()), "SELECT count(*) FILTER (is_archived AND NOT is_fork) AS failed, count(*) AS attempted, count(*) < 100 OR count(*) FILTER (is_archived AND NOT is_fork) <= 0.01 * count(*) AS ok FROM repo_meta")
add("retry_worklist", lambda s: T.retry_worklist(s.metadata, s.metadata.where("has_ci").select("repo_name"), _failed(s), "repo_name"),
    "SELECT DISTINCT repo_name FROM repo_meta WHERE has_ci IS DISTINCT FROM true AND NOT is_fork AND NOT (is_archived AND release_count % 5 >= 3)")
add("exhausted_failures", lambda s: T.exhausted_failures(s.metadata, _failed(s), "repo_name"), "SELECT repo_name, 'TIMEOUT' AS reason FROM repo_meta WHERE is_archived AND NOT is_fork AND release_count % 5 >= 3")

# 2.2 and 2.4 discovery

_grid = "month, repo_name, actor_login, push_events, push_commit_count, prs_opened, prs_closed, prs_merged, reviews_submitted, issues_opened, issue_comments, releases, active_days, active_day_mask, first_seen, last_seen, is_bot, bot_pattern"
add("event_grid", lambda s: s.grid.select(*_grid.split(", ")), f"SELECT {_grid} FROM grid")
add("payload_extract", lambda s: X.payload_extract(A.act_events(s.spark, s.sf_dir)).groupBy("action", "pr_merged").agg(F.count("*").alias("n"), F.sum("push_distinct_size").alias("commits"), F.count("push_size").alias("sizes")),
    "SELECT action, CASE WHEN flag THEN 'true' ELSE 'false' END AS pr_merged, count(*) AS n, CAST(sum(size) FILTER (NOT is_old) AS BIGINT) AS commits, count(*) FILTER (is_old) AS sizes FROM act_events GROUP BY 1, 2")
add("stream_grid", lambda s: table(s, "events").select(F.get_json_object("props", "$.k").alias("repo_name"), "user_id", "event_type", "ts").groupBy("repo_name").agg(F.count_distinct("user_id").alias("actors"), F.bit_count(F.bit_or(F.expr("shiftleft(1L, day(ts) - 1)"))).cast("long").alias("active_days"), F.count_if(F.col("event_type") == "purchase").alias("purchases")),
    "SELECT props->>'$.k' AS repo_name, count(DISTINCT user_id) AS actors, count(DISTINCT CAST(ts AS DATE)) AS active_days, count(*) FILTER (event_type = 'purchase') AS purchases FROM events GROUP BY 1")
add("bot_label", lambda s: s.grid.select("actor_login", "bot_pattern", "is_bot").distinct(), "SELECT DISTINCT actor_login, bot_pattern, is_bot FROM grid")
add("bot_audit", lambda s: discovery.bot_audit(s.grid), f"SELECT CASE WHEN is_bot THEN 'bot' ELSE 'human' END AS actor_class, bot_pattern, count(DISTINCT actor_login) AS distinct_actors, count(DISTINCT repo_name) AS distinct_repos, count(*) AS grid_rows, CAST(sum({Q.COUNTED}) AS BIGINT) AS total_counted_events FROM grid GROUP BY 1, 2")
add("per_actor_rollup", lambda s: discovery.per_actor_rollup(s.grid), "SELECT * FROM per_actor")
add("active_days_exact", lambda s: discovery.active_days_exact(discovery.month_day_mask(s.grid)), "SELECT * FROM repo_days")
_activity = "repo_name, owner_login, repo_short_name, unique_human_contributors, active_days, active_months, push_events, push_commit_count, pull_requests_opened, pull_requests_closed, merged_pull_requests, reviews_submitted, issues_opened, issue_comments, releases, weighted_activity_score, first_seen, last_seen, automation_event_share, single_actor_event_share, meaningful_events, is_taxonomy_candidate"
add("repo_activity", lambda s: s.activity.select(*_activity.split(", ")), f"SELECT {_activity} FROM repo_activity", "weighted_activity_score automation_event_share single_actor_event_share")
add("discovery_status", lambda s: s.discovered.select("repo_name", "discovery_status", "exclusion_reason", "pull_requests_or_reviews"), "SELECT repo_name, discovery_status, exclusion_reason, pull_requests_or_reviews FROM discovery")
_contributor = "actor_login, repo_name, domain_id, push_events, pull_requests_opened, merged_pull_requests_authored, reviews_submitted, issues_opened, issue_comments, active_days, active_months, first_seen, last_seen, raw_contribution_points"
add("contributor_rollup", lambda s: s.contributors.select(*_contributor.split(", ")), f"SELECT {_contributor} FROM contributor", "raw_contribution_points")
add("join_accepted_events", lambda s: discovery.join_accepted_events(s.grid, s.discovered).groupBy("month").agg(F.count("*").alias("n")), "SELECT month, count(*) AS n FROM grid WHERE repo_name IN (SELECT repo_name FROM discovery WHERE discovery_status = 'accepted') GROUP BY 1")
add("dup_keys", lambda s: discovery.dup_keys(s.grid, ["month", "repo_name"]), "SELECT month, repo_name, count(*) AS n_rows FROM grid GROUP BY 1, 2 HAVING count(*) > 1")
add("repo_worklist", lambda s: discovery.repo_worklist(s.discovered), "SELECT DISTINCT repo_name FROM discovery WHERE discovery_status = 'accepted'")
add("user_worklist", lambda s: discovery.user_worklist(s.contributors, s.classified), "SELECT DISTINCT actor_login FROM contributor WHERE repo_name IN (SELECT repo_name FROM classified WHERE classification_status = 'accepted')")
add("valid_login", lambda s: s.grid.select("actor_login").distinct().withColumn("valid", X.valid_login("actor_login")), "SELECT DISTINCT actor_login, regexp_full_match(actor_login, '[A-Za-z0-9][A-Za-z0-9-]{0,38}') AS valid FROM grid")
add("taxonomy_terms", lambda s: discovery.taxonomy_terms(s.taxonomy).join(s.metadata.select(F.explode(F.split("description", " ")).alias("term")).distinct(), "term", "left_semi"),
    "SELECT DISTINCT term FROM (SELECT replace(lower(item), ' ', '-') AS term FROM taxonomy WHERE kind IN ('topic', 'term') UNION SELECT replace(lower(item), ' ', '') FROM taxonomy WHERE kind IN ('topic', 'term')) WHERE length(term) >= 3 AND term IN (SELECT unnest(string_split(description, ' ')) FROM repo_meta)")
add("anti_membership", lambda s: discovery.anti_membership(s.grid.select("repo_name", "actor_login").distinct(), s.discovered), "SELECT DISTINCT repo_name, actor_login FROM grid WHERE repo_name NOT IN (SELECT repo_name FROM discovery WHERE discovery_status = 'accepted')")
add("geo_monthly_trend", lambda s: discovery.geo_monthly_trend(s.grid, A.actor_country(s.spark, s.sf_dir)), "SELECT * FROM trend")
_months = [200106, 200107, 200108, 200109, 200110, 200111]
add("expanded_momentum", lambda s: discovery.expanded_momentum(s.grid, A.actor_country(s.spark, s.sf_dir), _months),
    """SELECT country_code, recent, earlier, CASE WHEN recent > earlier THEN 'up' WHEN recent < earlier THEN 'down' ELSE 'flat' END AS direction, new_actor_logins, new_repo_names FROM (
  SELECT country_code, count(DISTINCT actor_login) FILTER (month >= 200109) AS recent, count(DISTINCT actor_login) FILTER (month < 200109) AS earlier FROM grid JOIN actor_country USING (actor_login) WHERE NOT is_bot AND month >= 200106 AND month <= 200111 GROUP BY 1)
  JOIN (SELECT country_code, count(*) FILTER (m >= 200109) AS new_actor_logins FROM (SELECT country_code, actor_login, min(month) AS m FROM grid JOIN actor_country USING (actor_login) WHERE NOT is_bot AND month BETWEEN 200106 AND 200111 GROUP BY 1, 2) GROUP BY 1) USING (country_code)
  JOIN (SELECT country_code, count(*) FILTER (m >= 200109) AS new_repo_names FROM (SELECT country_code, repo_name, min(month) AS m FROM grid JOIN actor_country USING (actor_login) WHERE NOT is_bot AND month BETWEEN 200106 AND 200111 GROUP BY 1, 2) GROUP BY 1) USING (country_code)""")

# 2.5 statistics

_seg = ["c_mktsegment"]
_by = "PARTITION BY c_mktsegment"
_bal = "c_acctbal"
add("percentile_value", lambda s: stats.percentile_value(table(s, "customer"), _seg, _bal, 0.9), "SELECT c_mktsegment, quantile_cont(c_acctbal, 0.9) AS percentile FROM customer GROUP BY 1", "percentile")
add("winsorize", lambda s: stats.winsorize(table(s, "customer"), _seg, _bal, 0.9).select("c_custkey", _bal), f"SELECT c_custkey, least(c_acctbal, quantile_cont(c_acctbal, 0.9) OVER ({_by})) AS c_acctbal FROM customer", "c_acctbal")
add("percentile_rank", lambda s: stats.percentile_rank(table(s, "part"), ["p_brand"], "p_size", "pr").select("p_partkey", "pr"), "SELECT p_partkey, (rank() OVER (PARTITION BY p_brand ORDER BY p_size) + (count(*) OVER (PARTITION BY p_brand, p_size) - 1) / 2.0 - 0.5) / count(*) OVER (PARTITION BY p_brand) AS pr FROM part", "pr")
add("scale_rank", lambda s: stats.scale_rank(table(s, "part"), [], "p_size", "score").select("p_partkey", "score"), f"SELECT p_partkey, {Q.scale_rank('p_size')} AS score FROM part", "score")
add("minmax_to_100", lambda s: stats.minmax_to_100(table(s, "customer"), _seg, _bal, "score").select("c_custkey", "score"), f"SELECT c_custkey, (c_acctbal - min(c_acctbal) OVER ({_by})) / (max(c_acctbal) OVER ({_by}) - min(c_acctbal) OVER ({_by})) * 100 AS score FROM customer", "score")
add("scale_count", lambda s: stats.scale_counts(table(s, "part"), ["p_brand"], {"score": "p_size"}).select("p_partkey", "score"), f"SELECT p_partkey, {Q.scale_count('p_size', 'PARTITION BY p_brand')} AS score FROM part", "score")
add("log1p_scale", lambda s: table(s, "part").select("p_partkey", stats.log1p_scale("p_size").alias("x")), "SELECT p_partkey, ln(1 + p_size) AS x FROM part", "x")
add("weighted_median", lambda s: stats.weighted_median(table(s, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice", "l_quantity"),
    "SELECT l_returnflag, l_linestatus, min(l_extendedprice) FILTER (upto * 2 >= total) AS weighted_median FROM (SELECT *, sum(w) OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY l_extendedprice) AS upto, sum(w) OVER (PARTITION BY l_returnflag, l_linestatus) AS total FROM (SELECT l_returnflag, l_linestatus, l_extendedprice, sum(CAST(l_quantity AS DECIMAL(38,12))) AS w FROM lineitem GROUP BY 1, 2, 3)) GROUP BY 1, 2", "weighted_median")
add("saturating_ratio", lambda s: table(s, "part").select("p_partkey", X.saturating_ratio("p_size", 10).alias("x")), "SELECT p_partkey, least(p_size / 20.0, 1.0) AS x FROM part", "x")
# 2 * p_size reaches 100 at the largest size; parts beyond it are an error, as in the reference (scoring/normalization.py:139-142).
add("weighted_blend", lambda s: table(s, "part").select("p_partkey", X.weighted_blend({"a": F.col("p_size").cast("double"), "b": F.col("p_size") * 2.0}, {"a": 0.4, "b": 0.6}).alias("x")), "SELECT p_partkey, greatest(0.0, least(100.0, p_size * CAST(0.4 AS DOUBLE) + p_size * 2 * CAST(0.6 AS DOUBLE))) AS x FROM part", "x")
add("sample_rows", lambda s: quality.sample_rows(table(s, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", "o_orderkey", 50, 7), "SELECT o_orderkey, o_orderpriority FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('7:' || o_orderkey), o_orderkey) <= 50")

# 2.6 set operations

_keys = lambda s, w: table(s, "orders").where(w).select("o_custkey").distinct()
add("set_difference", lambda s: _keys(s, "true").join(_keys(s, "o_orderstatus = 'F'"), "o_custkey", "left_anti"), "SELECT o_custkey FROM orders EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
add("set_intersection", lambda s: _keys(s, "o_orderstatus = 'O'").join(_keys(s, "o_orderstatus = 'F'"), "o_custkey", "left_semi"), "SELECT o_custkey FROM orders WHERE o_orderstatus = 'O' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
add("distinct_pairs", lambda s: publish.distinct_pairs(s.contributors), "SELECT DISTINCT actor_login, repo_name FROM contributor")
add("union_all", lambda s: table(s, "customer").select(F.col("c_nationkey").alias("k")).unionByName(table(s, "supplier").select(F.col("s_nationkey").alias("k"))).groupBy("k").agg(F.count("*").alias("n")), "SELECT k, count(*) AS n FROM (SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier) GROUP BY 1")

# 2.7 scalar functions

add("string_functions", lambda s: table(s, "part").select("p_partkey", X.normalize_token(F.concat("p_name", F.lit(" _"), "p_brand", F.lit("./"))).alias("token"), X.repo_short_name(F.concat("p_type", F.lit("/"), "p_name")).alias("short"), X.city_geo_id("p_brand", "p_name").alias("geo"), X.city_slug(F.concat("p_type", F.lit("/"), "p_name")).alias("slug"),
        F.array_join(X.comma_segments(F.concat("p_name", F.lit(" , ,"), "p_type")), "|").alias("segments"), F.array_join(X.split_multi_location(F.concat("p_name", F.lit(" / "), "p_type", F.lit(" and "), "p_brand")), "|").alias("parts"), X.subdomain_display(F.concat_ws("_", "p_type", "p_brand")).alias("shown")),
    r"""SELECT p_partkey, trim(regexp_replace(lower(p_name || ' _' || p_brand || './'), '[\s\-_./]+', '-', 'g'), '-') AS token, p_name AS short, p_brand || '-' || replace(lower(p_name), ' ', '-') AS geo, replace(replace(lower(p_type || '/' || p_name), '/', '-'), ' ', '-') AS slug,
  p_name || '|' || p_type AS segments, p_name || '|' || p_type || '|' || p_brand AS parts, upper(p_type[1]) || lower(p_type[2:]) || ' ' || upper(p_brand[1]) || lower(p_brand[2:]) AS shown FROM part""")
add("date_functions", lambda s: table(s, "orders").select("o_orderkey", X.month_of("o_orderdate").alias("month"), X.month_bounds(F.to_date("o_orderdate"))[1].alias("last"), X.previous_month(F.to_date("o_orderdate")).alias("previous"), X.days_since(F.lit(A.WINDOW[1]), F.to_date("o_orderdate")).cast("long").alias("days")),
    f"SELECT o_orderkey, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS month, last_day(o_orderdate) AS last, CAST(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH AS DATE) AS previous, {Q.END} - CAST(o_orderdate AS DATE) AS days FROM orders")
add("interval_overlap", lambda s: s.contributors.groupBy("repo_name").agg(F.count_if(X.interval_overlap("first_seen", "last_seen", F.to_date(F.lit("1998-05-01")), F.to_date(F.lit("1998-05-31")))).alias("n")), "SELECT repo_name, count(*) FILTER (first_seen <= DATE '1998-05-31' AND last_seen >= DATE '1998-05-01') AS n FROM contributor GROUP BY 1")
add("score_functions", lambda s: s.rankings.select("geo_level", "geo_id", X.confidence_band("confidence_score").alias("band"), X.is_low_confidence("recommendation_tier", "confidence_score").alias("low"), X.round4("opportunity_score").alias("rounded")),
    "SELECT geo_level, geo_id, CASE WHEN confidence_score >= 70 THEN 'high' WHEN confidence_score >= 40 THEN 'medium' ELSE 'low' END AS band, recommendation_tier = 'insufficient_data' OR confidence_score < 40 AS low, round(opportunity_score, 4) AS rounded FROM rankings")

# 2.8 classification

_words = r"[\s\-_./]+"
_phrase = r"'(^|[^a-z0-9])' || replace(lower(item), ' ', '[\s\-_./]+') || '($|[^a-z0-9])'"
_matches = f"""SELECT repo_name, subdomain_id, kind, item FROM (
  SELECT repo_name, subdomain_id, 'topic' AS kind, item FROM repo_meta JOIN taxonomy ON kind = 'topic' AND topic = item
  UNION ALL SELECT repo_name, subdomain_id, 'term', item FROM repo_meta JOIN taxonomy ON kind = 'term' AND regexp_matches(lower(description), {_phrase})
  UNION ALL SELECT repo_name, subdomain_id, 'name', item FROM repo_meta JOIN taxonomy ON kind = 'term' AND regexp_matches(lower(split_part(repo_name, '/', 2)), {_phrase})
  UNION ALL SELECT repo_name, subdomain_id, 'negative', item FROM repo_meta JOIN taxonomy ON kind = 'negative' AND regexp_matches(lower(split_part(repo_name, '/', 2) || ' ' || description || ' ' || topic), {_phrase})
  UNION ALL SELECT repo_name, subdomain_id, 'file', item FROM repo_meta JOIN taxonomy ON kind = 'signal' AND ((item = 'has_ci' AND has_ci) OR (item = 'has_tests_signal' AND has_tests_signal))
  UNION ALL SELECT repo_name, subdomain_id, 'language', item FROM repo_meta JOIN taxonomy ON kind = 'language' AND primary_language = item)"""
_scored = f"""SELECT repo_name, subdomain_id, CAST(3.0 * count(*) FILTER (kind = 'topic') + count(*) FILTER (kind = 'term') + 1.5 * count(*) FILTER (kind = 'name') + count(*) FILTER (kind = 'file') + count(*) FILTER (kind = 'language') - 2.0 * count(*) FILTER (kind = 'negative') AS DOUBLE) AS score,
  count(DISTINCT kind) FILTER (kind <> 'negative') AS kinds FROM ({_matches}) GROUP BY 1, 2"""
add("taxonomy_matches", lambda s: classify.all_matches(s.metadata, s.taxonomy).select("repo_name", "subdomain_id", "kind", "item"), _matches)
add("subdomain_score", lambda s: classify.subdomain_score(classify.all_matches(s.metadata, s.taxonomy)).select("repo_name", "subdomain_id", "score", "kinds"), _scored, "score")
_excluded = "SELECT repo_name, concat_ws('|', CASE WHEN is_fork THEN 'fork' END, CASE WHEN is_archived THEN 'archived' END, CASE WHEN license_spdx_id IS NULL THEN 'license' END, CASE WHEN single_actor_event_share > 0.9 THEN 'single_actor' END) AS reasons FROM repo_meta LEFT JOIN repo_activity USING (repo_name)"
_classified = f"""WITH scored AS ({_scored}), best AS (SELECT repo_name, max(CASE WHEN score >= 4 AND kinds >= 2 THEN 2 WHEN score >= 2 THEN 1 ELSE 0 END) AS grade, max(score) AS best FROM scored GROUP BY 1),
  judged AS (SELECT m.repo_name, b.best, CASE WHEN is_fork OR is_archived OR license_spdx_id IS NULL OR coalesce(single_actor_event_share > 0.9, false) THEN -1 ELSE coalesce(grade, 0) END AS grade FROM repo_meta m LEFT JOIN repo_activity a USING (repo_name) LEFT JOIN best b USING (repo_name)),
  listed AS (SELECT j.repo_name, string_agg(subdomain_id, '|' ORDER BY score DESC, subdomain_id) AS subdomains, max(score) AS top FROM judged j JOIN scored s ON s.repo_name = j.repo_name AND j.grade > 0 AND j.grade = CASE WHEN score >= 4 AND kinds >= 2 THEN 2 WHEN score >= 2 THEN 1 ELSE 0 END GROUP BY 1)
  SELECT repo_name, coalesce(subdomains, '') AS subdomains, CASE WHEN grade < 0 THEN 0.0 ELSE greatest(0.0, least(100.0, coalesce(top, best, 0))) END AS classification_score, CASE grade WHEN 2 THEN 'accepted' WHEN 1 THEN 'borderline' ELSE 'rejected' END AS classification_status FROM judged LEFT JOIN listed USING (repo_name)"""
#: Short names and descriptions, and the exclusion that each stands for.
_BAD_NAMES = {"awesome-things": "awesome_list", "learn-metal": "tutorial", "leetcode-answers": "interview_prep", "my-dotfiles": "dotfiles", "cse110-lab": "student_assignment", "handbook": "documentation_only", "cve-2021-44228": None, "sha256-tool": None}
_BAD_TEXTS = {"a curated list of bolts": "awesome_list", "crash course in gears": "tutorial", "interview questions about rods": "interview_prep", "my dotfiles": "dotfiles", "semester work": "student_assignment", "docs only": "documentation_only", "documentation of gears": None}


def _named_badly(s: Stages) -> DataFrame:
    """Repositories renamed and described in turn, so that each pattern meets names and texts that it fits, and some that look alike."""
    k = F.regexp_extract("repo_name", "([0-9]+)$", 1).cast("long")
    pick = lambda values, at, other: F.coalesce(F.get(F.array(*map(F.lit, values)), at.cast("int")), other)
    rows = classify.join_single_actor_share(s.metadata, s.activity).withColumns({"short": pick(_BAD_NAMES, k % 10, F.lit("plain")), "description": pick(_BAD_TEXTS, F.floor(k / 10) % 9, F.col("description"))})
    return rows.withColumn("repo_name", F.concat_ws("/", F.replace("repo_name", F.lit("/"), F.lit("~")), "short"))


_tag = lambda values, at: f"CASE {at} " + " ".join(f"WHEN {i} THEN {Q.quoted(t)}" for i, t in enumerate(values.values()) if t) + " END"
_short = "CASE k % 10 " + " ".join(f"WHEN {i} THEN {Q.quoted(n)}" for i, n in enumerate(_BAD_NAMES)) + " ELSE 'plain' END"
add("hard_exclusions", lambda s: _named_badly(s).select("repo_name", classify.hard_exclusions().alias("reasons")),
    f"""SELECT replace(repo_name, '/', '~') || '/' || {_short} AS repo_name, concat_ws('|', CASE WHEN is_fork THEN 'fork' END, CASE WHEN is_archived THEN 'archived' END, CASE WHEN license_spdx_id IS NULL THEN 'license' END, CASE WHEN single_actor_event_share > 0.9 THEN 'single_actor' END,
  {_tag(_BAD_NAMES, 'k % 10')}, CASE WHEN {_tag(_BAD_TEXTS, '(k // 10) % 9')} IS DISTINCT FROM {_tag(_BAD_NAMES, 'k % 10')} THEN {_tag(_BAD_TEXTS, '(k // 10) % 9')} END) AS reasons
  FROM (SELECT *, CAST(regexp_extract(repo_name, '([0-9]+)$', 1) AS BIGINT) AS k FROM repo_meta LEFT JOIN repo_activity USING (repo_name))""")
add("classify_run", lambda s: s.classification.select("repo_name", "subdomains", "classification_score", "classification_status"),
    _classified, "classification_score")
_items = lambda name, *kinds: f"coalesce(string_agg(DISTINCT item, '|' ORDER BY item) FILTER (kind IN ({', '.join(map(Q.quoted, kinds))})), '') AS {name}"
add("merge_evidence", lambda s: s.classification.select("repo_name", "evidence_topics", "evidence_terms", "evidence_files", "negative_evidence"),
    f"""WITH judged AS ({_classified}), excluded AS ({_excluded}),
  items AS (SELECT repo_name, kind, CASE kind WHEN 'name' THEN 'name:' WHEN 'language' THEN 'language:' WHEN 'negative' THEN 'negative_term:' ELSE '' END || item AS item FROM ({_matches}) JOIN judged USING (repo_name) WHERE subdomains = '' OR list_contains(string_split(subdomains, '|'), subdomain_id)),
  merged AS (SELECT repo_name, {_items('evidence_topics', 'topic')}, {_items('evidence_terms', 'term', 'name')}, {_items('evidence_files', 'file', 'language')}, {_items('negatives', 'negative')} FROM judged LEFT JOIN items USING (repo_name) GROUP BY 1)
  SELECT repo_name, evidence_topics, evidence_terms, evidence_files, concat_ws('|', nullif(reasons, ''), nullif(negatives, '')) AS negative_evidence FROM merged JOIN excluded USING (repo_name)""")
add("classification_counts", lambda s: classify.classification_counts(s.classified), "SELECT count(*) AS total, count(*) FILTER (classification_status = 'accepted') AS accepted, count(*) FILTER (classification_status = 'rejected') AS rejected, count(*) FILTER (classification_status = 'borderline') AS borderline FROM classified")

# 2.9 locations: texts and dimensions from the tables; the SQL says what a form of text means

_located = lambda s: s.normalized
add("normalize_run", lambda s: _located(s).select("actor_login", "normalized_country_code", "normalized_city", "location_level", "location_confidence"),
    f"SELECT actor_login, normalized_country_code, normalized_city, location_level, location_confidence FROM ({gazetteer.ORACLE})")
add("normalization_summary", lambda s: locations.normalization_summary(_located(s)),
    f"SELECT count(*) AS total, count(normalized_country_code) AS located_country, count(normalized_city) AS located_city, count(*) FILTER (location_confidence = 'unusable') AS unusable, count(normalized_country_code) / count(*) AS country_rate FROM ({gazetteer.ORACLE})", "country_rate")
add("eligible_geography", lambda s: _located(s).select("actor_login", locations.eligible_country().alias("country"), locations.eligible_city().alias("city")), f"SELECT actor_login, location_confidence IN ('high', 'medium') AS country, location_level = 'city' AND location_confidence = 'high' AS city FROM ({gazetteer.ORACLE})")

# 2.10 scores

_repo = "recent_activity_score contributor_diversity_score collaboration_quality_score technical_relevance_score repository_maturity_score repository_quality_score"
add("score_repositories", lambda s: s.repo_scores, f"SELECT repo_name, {_repo.replace(' ', ', ')} FROM repo_scores", _repo)
add("capped_points", lambda s: scores.capped_points(scores.semi_accepted_activity(s.contributors, s.classified)).select("actor_login", "repo_name", "points", "capped"), "SELECT actor_login, repo_name, points, capped FROM capped", "points capped")
add("contributor_evidence", lambda s: s.contributor_evidence.select("actor_login", "qualified_repo_count", "weighted_event_points", "raw_event_count", "org_count", "subdomain_count", "days", "months", F.col("span_days").cast("long").alias("span_days"), "exposure"),
    "SELECT actor_login, qualified_repo_count, weighted_event_points, raw_event_count, org_count, subdomain_count, days, months, CAST(span_days AS BIGINT) AS span_days, exposure FROM evidence", "weighted_event_points exposure")
_contrib = "expert_score domain_activity_score contribution_quality_score repository_quality_exposure_score continuity_score collaboration_score weighted_event_points"
add("score_contributors", lambda s: s.contributor_scores, f"SELECT actor_login, domain_id, {_contrib.replace(' ', ', ')}, qualified_repo_count, active_months, normalized_country_code AS country_code, normalized_city AS city, coalesce(location_confidence, 'unusable') AS location_confidence, qualified_repo_count = 1 AS one_repo, raw_event_count FROM contributor_scores LEFT JOIN actor_geo USING (actor_login)", _contrib)
add("geo_membership", lambda s: scores.geo_membership(s.contributor_scores, s.locations).groupBy("geo_level", "country_code", "city").agg(F.count("*").alias("n")), "SELECT geo_level, country_code, city, count(*) AS n FROM members GROUP BY ALL")
add("located_coverage", lambda s: scores.located_coverage(s.contributor_scores, s.locations), f"SELECT '{A.DOMAIN}' AS domain_id, avg(CASE WHEN location_confidence IN ('high', 'medium') AND normalized_country_code IS NOT NULL THEN 1.0 ELSE 0.0 END) AS coverage FROM contributor_scores LEFT JOIN actor_geo USING (actor_login)", "coverage")
add("geo_evidence", lambda s: s.geo_evidence.select("geo_level", "country_code", "city", "capped_supply", "weighted_median", "top_quartile_share", "max_repo_share", "max_org_share", "qualified_repo_count", "organization_count", "subdomain_count", "latest_active", "previous_active"),
    "SELECT geo_level, country_code, city, capped_supply, weighted_median, top_quartile_share, max_repo_share, max_org_share, qualified_repo_count, organization_count, subdomain_count, latest_active, previous_active FROM geo_evidence", "capped_supply weighted_median top_quartile_share max_repo_share max_org_share")
_rank = "opportunity_score confidence_score expert_supply_score expert_quality_score collaboration_depth_score momentum_score ecosystem_breadth_score"
add("rank_geographies", lambda s: s.rankings.select("geo_level", "geo_id", *_rank.split(), "recommendation_tier", F.col("rank").cast("long").alias("rank"), "org_concentration_flag"),
    f"SELECT geo_level, geo_id, {_rank.replace(' ', ', ')}, recommendation_tier, rank, max_org_share > {C.ORG_SHARE_FLAG} AS org_concentration_flag FROM rankings", _rank)

# 2.11 quality

# RE2 has no lookahead: the character after the match is matched, or the end.
_BEFORE, _AFTER = r"(?![\w/-])", r"(?:[^\w/-]|$)"
_privacy_sql = " UNION ALL ".join(f"SELECT file, {Q.quoted(n)} AS pattern, trim(line, ' ' || chr(9) || chr(11) || chr(12)) AS t FROM lines WHERE regexp_matches(line, {Q.quoted(p.replace(_BEFORE, _AFTER))})" for n, p in C.PRIVACY)
add("privacy_scan", lambda s: quality.privacy_scan(A.text_lines(s.spark, s.sf_dir)).groupBy("file", "pattern").agg(F.count("*").alias("n"), F.min("excerpt").alias("excerpt")),
    f"WITH lines AS (SELECT file, unnest(regexp_split_to_array(text, '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e]')) AS line FROM text_lines) SELECT file, pattern, count(*) AS n, min(CASE WHEN length(t) <= 120 THEN t ELSE t[1:120] || '…' END) AS excerpt FROM ({_privacy_sql}) GROUP BY 1, 2")
add("precision_metrics", lambda s: quality.precision_metrics(table(s, "documents").select("doc_id", (F.col("n_chars") > 500).alias("predicted")), table(s, "labels").select("doc_id", (F.col("quality") == 1).alias("label")), "doc_id"),
    "SELECT count(*) AS reviewed, avg(CASE WHEN quality = 1 THEN 1.0 ELSE 0.0 END) AS precision, avg(CASE WHEN quality = 1 THEN 0.0 ELSE 1.0 END) AS false_inclusion_rate FROM documents JOIN labels USING (doc_id) WHERE n_chars > 500", "precision false_inclusion_rate")
_dimensions = {"activity_decile": "CAST(decile AS VARCHAR)", "one_repo": "CAST(one_repo AS VARCHAR)", "language": "primary_language", "organization_size": "size"}
add("coverage_bias", lambda s: quality.coverage_bias(quality.bias_rows(s.contributor_scores, s.contributors, s.metadata), list(_dimensions)),
    """WITH cuts AS (SELECT quantile_cont(raw_event_count, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS cuts FROM contributor_scores),
  main AS (SELECT actor_login, repo_name FROM contributor QUALIFY row_number() OVER (PARTITION BY actor_login ORDER BY raw_contribution_points DESC, repo_name DESC) = 1),
  sizes AS (SELECT owner, CASE WHEN n <= 5 THEN '1-5' WHEN n <= 50 THEN '6-50' WHEN n <= 500 THEN '51-500' ELSE '501+' END AS size FROM (SELECT split_part(repo_name, '/', 1) AS owner, count(DISTINCT actor_login) AS n FROM contributor GROUP BY 1)),
  rows AS (SELECT 1 + len(list_filter(cuts, lambda c: raw_event_count > c)) AS decile, qualified_repo_count = 1 AS one_repo, primary_language, size, normalized_country_code IS NOT NULL AS located
    FROM contributor_scores LEFT JOIN actor_geo USING (actor_login) LEFT JOIN main USING (actor_login) LEFT JOIN repo_meta USING (repo_name) LEFT JOIN sizes ON owner = split_part(repo_name, '/', 1) CROSS JOIN cuts)
  """ + " UNION ALL ".join(f"SELECT '{n}' AS dimension, {c} AS bucket, count(*) AS n, avg(CASE WHEN located THEN 1.0 ELSE 0.0 END) AS located_share FROM rows GROUP BY 2" for n, c in _dimensions.items()), "located_share")
add("sensitivity", lambda s: quality.sensitivity(s.contributor_scores, s.contributors, s.classified, s.locations, s.repo_scores, A.WINDOW[1], A.SAMPLES).select("scenario", "geo_level", "geo_id", F.col("rank").cast("long").alias("rank"), F.col("shift").cast("long").alias("shift")),
    " UNION ALL ".join(f"SELECT '{n}' AS scenario, x.geo_level, x.geo_id, x.rank, x.rank - b.rank AS shift FROM rankings{v} x JOIN rankings b ON x.domain_id = b.domain_id AND x.geo_level = b.geo_level AND x.geo_id = b.geo_id" for n, v in Q.SCENARIOS.items()))
add("raw_vs_weighted", lambda s: quality.raw_vs_weighted(s.rankings).select("geo_level", "geo_id", F.col("raw_rank").cast("long").alias("raw_rank"), F.col("weighted_rank").cast("long").alias("weighted_rank")),
    "SELECT geo_level, geo_id, row_number() OVER (PARTITION BY geo_level ORDER BY observable_expert_count DESC, geo_id) AS raw_rank, row_number() OVER (PARTITION BY geo_level ORDER BY weighted_expert_count DESC, geo_id) AS weighted_rank FROM rankings")
def _windows(s: Stages) -> DataFrame:
    states = tuple(T.stage(x, "states") for x in discovery.monthly_states(s.grid))
    short, long = (quality.window_ranks(states, months, s.discovered, s.classified, s.metadata, s.locations, A.TERMS, A.DOMAIN, A.WINDOW[1], A.SAMPLES) for months in Q.WINDOWS.values())
    return quality.window_comparison(short, long).select("geo_level", "geo_id", *(F.col(c).cast("long").alias(c) for c in ("short_rank", "long_rank", "shift")))


add("window_comparison", _windows,
    "SELECT geo_level, geo_id, x.rank AS short_rank, y.rank AS long_rank, x.rank - y.rank AS shift FROM rankings_w3 x FULL JOIN rankings_w12 y USING (domain_id, geo_level, geo_id)")

# 2.12 published datasets

counts = lambda s: publish.explode_subdomain_join(s.classified, s.contributors, s.contributor_scores)
add("explode_subdomain_join", counts, "SELECT * FROM subdomain_counts")
add("subdomain_hubs", lambda s: publish.subdomain_hubs(counts(s)), "SELECT * FROM subdomain_counts QUALIFY row_number() OVER (PARTITION BY subdomain ORDER BY experts DESC, country_code) = 1")
add("subdomain_mix", lambda s: publish.subdomain_mix(counts(s)), "SELECT *, experts / greatest(sum(experts) OVER (PARTITION BY country_code), 1) AS share FROM subdomain_counts", "share")
add("kpis", lambda s: publish.kpis(s.classified, s.contributor_scores, s.locations, s.rankings), "SELECT (SELECT count(*) FROM classified WHERE classification_status = 'accepted') AS qualified_repos, (SELECT count(DISTINCT actor_login) FROM contributor_scores) AS experts, (SELECT count(normalized_country_code) / count(*) FROM actor_geo) AS located_coverage, (SELECT count(*) FROM rankings WHERE geo_level = 'country' AND recommendation_tier <> 'insufficient_data') AS sufficient_countries", "located_coverage")
add("coverage_by_country", lambda s: publish.coverage_by_country(s.locations), "SELECT normalized_country_code AS country_code, count(*) AS located, count(*) / sum(count(*)) OVER () AS share FROM actor_geo WHERE normalized_country_code IS NOT NULL GROUP BY 1 ORDER BY located DESC, country_code LIMIT 40", "share")
add("confidence_distribution", lambda s: publish.confidence_distribution(s.locations), "SELECT location_confidence, count(*) AS n FROM actor_geo GROUP BY 1")
add("score_summary", lambda s: publish.score_summary(s.contributor_scores, "expert_score"), "SELECT count(*) AS n_rows, min(expert_score) AS lowest, median(expert_score) AS middle, max(expert_score) AS highest FROM contributor_scores", "lowest middle highest")
add("funnel", lambda s: publish.funnel({"repositories": s.activity, "contributor_rows": s.contributors, "scored_contributors": s.contributor_scores, "geographies": s.rankings}).select("stage", "n"), "SELECT 'repositories' AS stage, count(*) AS n FROM repo_activity UNION ALL SELECT 'contributor_rows', count(*) FROM contributor UNION ALL SELECT 'scored_contributors', count(*) FROM contributor_scores UNION ALL SELECT 'geographies', count(*) FROM rankings")
add("top_priority", lambda s: publish.top_priority(s.rankings).select("geo_id", "opportunity_score"), "SELECT geo_id, opportunity_score FROM rankings WHERE geo_level = 'country' AND recommendation_tier <> 'insufficient_data' ORDER BY rank LIMIT 5", "opportunity_score")
_named = "coalesce(city, country_name, country_code)"
_parts = {n: f"{n}_score" for n in publish.COMPONENTS}
_most = lambda parts, f: "CASE " + " ".join(f"WHEN {c} = {f}({', '.join(parts.values())}) THEN '{n}'" for n, c in parts.items()) + " END"
add("recommendations", lambda s: publish.recommendations(s.rankings, s.countries).select("geo_id", "name", "strongest", "weakest"),
    f"SELECT geo_id, {_named} AS name, {_most(_parts, 'greatest')} AS strongest, {_most(_parts, 'least')} AS weakest FROM rankings LEFT JOIN country_names USING (country_code) WHERE geo_level = 'country' AND recommendation_tier <> 'insufficient_data' ORDER BY CASE recommendation_tier WHEN 'priority' THEN 0 WHEN 'promising' THEN 1 ELSE 2 END, rank LIMIT 3")
_all = {n: f"{n}_score" for n in publish.ALL_COMPONENTS}
add("why_statements", lambda s: publish.why_statements(s.rankings, s.countries), f"SELECT geo_level, geo_id, {_named} || ' does best in ' || replace({_most(_all, 'greatest')}, '_', ' ') || '.|' || {_named} || ' does worst in ' || replace({_most(_all, 'least')}, '_', ' ') || '.' AS statements FROM rankings LEFT JOIN country_names USING (country_code)")
_caveats = f"""concat_ws('|', CASE WHEN located_profile_coverage < 0.4 THEN printf('Only %.0f%% of scored profiles could be located.', located_profile_coverage * 100) END,
  CASE WHEN max_org_share > {C.ORG_SHARE_FLAG} THEN printf('One organization accounts for %.0f%% of activity.', max_org_share * 100) END, 'Momentum compares two months only and is provisional.')"""
add("caveats", lambda s: s.rankings.select("geo_level", "geo_id", publish.caveats().alias("caveats")), f"SELECT geo_level, geo_id, {_caveats} AS caveats FROM rankings")
add("explorer_filter", lambda s: publish.explorer_filter(s.rankings, min_confidence=30, text="building").select("geo_id", "confidence_score"), "SELECT geo_id, confidence_score FROM rankings WHERE confidence_score >= 30 AND contains(lower(concat_ws(' ', city, country_code)), 'building')", "confidence_score")
_metrics = ("opportunity_score", "confidence_score", "observable_expert_count")
add("subdomain_options", lambda s: publish.subdomain_options(s.rankings),
    f"SELECT DISTINCT s AS subdomain FROM geo_top WHERE r <= {C.TOP_SUBDOMAINS}")
add("comparison_summary", lambda s: publish.comparison_summary(s.rankings, s.countries, ["N1", "N2", "N3"]),
    f"""WITH long AS (SELECT {_named} AS name, unnest([{', '.join(map(Q.quoted, _metrics))}]) AS metric, unnest([{', '.join(f'CAST({m} AS DOUBLE)' for m in _metrics)}]) AS value FROM rankings LEFT JOIN country_names USING (country_code) WHERE geo_id IN ('N1', 'N2', 'N3'))
  SELECT *, printf('%s: %s leads with %.1f.', replace(metric, '_', ' '), leaders, best) AS text FROM (SELECT metric, value AS best, string_agg(name, ' and ' ORDER BY name) AS leaders FROM (SELECT *, max(value) OVER (PARTITION BY metric) AS top FROM long) WHERE value = top GROUP BY 1, 2)""", "best")
_read = lambda df, *keep, **kinds: df.select(*keep, F.from_json("payload", ", ".join(f"{k} {t}" for k, t in kinds.items())).alias("x")).select(*keep, "x.*")
_payload = {"name": "string", "rank": "long", "opportunityScore": "double", "confidenceScore": "double", "recommendationTier": "string", "topSubdomains": "array<string>", "momentumProvisional": "boolean"}
_scores = {X.camel_case(f"{n}_score"): f"{n}_score" for n in publish.ALL_COMPONENTS}
_more = _scores | {"weightedExpertCount": "weighted_expert_count", "multiRepoExpertShare": "multi_repo_share / 100", "locatedProfileCoverage": "coverage", "highConfidenceLocationShare": "high_confidence_count / observable_expert_count"}
_counted = {"observableExpertCount": "observable_expert_count", "qualifiedRepoCount": "qualified_repo_count", "organizationCount": "organization_count"}
_doubles = " ".join(f'"{c}"' for c in ("opportunityScore", "confidenceScore", *_more))


def _payload_sql(fields: dict[str, str]) -> str:
    more = "".join(f', r.{x} AS "{n}"' if x.isidentifier() else f', {x} AS "{n}"' for n, x in fields.items())
    return f"""WITH best AS (SELECT geo_level, country_code, city, string_agg(s, '|' ORDER BY r) AS subs FROM geo_top WHERE r <= {C.TOP_SUBDOMAINS} GROUP BY ALL)
  SELECT r.geo_level, r.geo_id, coalesce(r.city, country_name, r.country_code) AS name, rank, opportunity_score AS "opportunityScore", confidence_score AS "confidenceScore", recommendation_tier AS "recommendationTier", coalesce(subs, '') AS "topSubdomains", true AS "momentumProvisional"{more}
  FROM rankings r LEFT JOIN country_names n ON n.country_code = r.country_code LEFT JOIN best b ON b.geo_level = r.geo_level AND b.country_code = r.country_code AND b.city IS NOT DISTINCT FROM r.city"""


add("compare_payload", lambda s: _read(publish.compare_payload(s.rankings, s.countries), "geo_level", "geo_id", **_payload), _payload_sql({}), '"opportunityScore" "confidenceScore"')
add("rankings_payload", lambda s: _read(publish.rankings_payload(s.rankings, s.countries), "geo_level", "geo_id", **_payload, **dict.fromkeys(_more, "double"), **dict.fromkeys(_counted, "long")), _payload_sql(_more | _counted), _doubles)
_details = lambda s: publish.country_detail(s.rankings, s.countries, publish.subdomain_mix(counts(s)), discovery.geo_monthly_trend(s.grid, A.actor_country(s.spark, s.sf_dir)))
_detail = {"name": "string", "rank": "long", "caveats": "array<string>", "subdomainMix": "array<struct<subdomain: string, experts: long, share: double>>", "trend": "array<struct<month: int, events: long, active_contributors: long>>"}
add("country_detail", lambda s: _read(_details(s), "geo_id", "file", **_detail).select("geo_id", "file", "name", "rank", "caveats", F.array_join(F.transform("subdomainMix", lambda x: F.concat_ws(":", x["subdomain"], x["experts"])), "|").alias("mix"), F.array_join(F.transform("trend", lambda x: F.concat_ws(":", x["month"], x["events"], x["active_contributors"])), "|").alias("trend")),
    f"""SELECT geo_id, replace(lower(geo_id), ' ', '-') AS file, {_named} AS name, rank, {_caveats} AS caveats, mix, trend
  FROM rankings LEFT JOIN country_names USING (country_code) LEFT JOIN (SELECT country_code, string_agg(subdomain || ':' || experts, '|' ORDER BY subdomain) AS mix FROM subdomain_counts GROUP BY 1) USING (country_code)
  LEFT JOIN (SELECT country_code, string_agg(month || ':' || events || ':' || active_contributors, '|' ORDER BY month) AS trend FROM trend GROUP BY 1) USING (country_code) WHERE geo_level = 'country'""")
add("city_detail", lambda s: _read(publish.city_detail(s.rankings, s.countries), "geo_id", "file", name="string", rank="long", caveats="array<string>", opportunityScore="double", qualifiedRepoCount="long", recommendationTier="string"),
    f"""SELECT geo_id, replace(replace(lower(geo_id), '/', '-'), ' ', '-') AS file, {_named} AS name, rank, 'City samples count high-confidence locations only.' AS caveats, opportunity_score AS "opportunityScore", qualified_repo_count AS "qualifiedRepoCount", recommendation_tier AS "recommendationTier"
  FROM rankings LEFT JOIN country_names USING (country_code) WHERE geo_level = 'city'""", '"opportunityScore"')
_rows = lambda df, column, *fields: df.select(F.explode(F.from_json(column, f"array<struct<{', '.join(fields)}>>")).alias("x")).select("x.*")


def _coverage(s: Stages) -> DataFrame:
    """Both lists of the payload, read back as rows."""
    payload = publish.coverage_payload(s.locations)
    countries = _rows(payload, "coverage_by_country", "country_code: string", "located: long", "share: double").select(F.lit("country").alias("list"), F.col("country_code").alias("key"), F.col("located").alias("n"), "share")
    levels = _rows(payload, "confidence_distribution", "location_confidence: string", "n: long")
    return countries.unionByName(levels.select(F.lit("confidence").alias("list"), F.col("location_confidence").alias("key"), "n"), allowMissingColumns=True)


add("coverage_payload", _coverage,
    """SELECT * FROM (SELECT 'country' AS list, normalized_country_code AS key, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM actor_geo WHERE normalized_country_code IS NOT NULL GROUP BY 2 ORDER BY n DESC, key LIMIT 40)
  UNION ALL SELECT 'confidence', location_confidence, count(*), NULL FROM actor_geo GROUP BY 2""", "share")


def _summary(s: Stages) -> DataFrame:
    """Measures and both lists of the payload, read back as rows."""
    payload = publish.summary_payload(publish.kpis(s.classified, s.contributor_scores, s.locations, s.rankings), s.rankings, publish.subdomain_hubs(counts(s)))
    measures = payload.select(F.explode(F.array(*(F.struct(F.lit("kpi").alias("list"), F.lit(c).alias("key"), F.col(c).cast("double").alias("value")) for c in ("qualified_repos", "experts", "located_coverage", "sufficient_countries")))).alias("x")).select("x.*")
    top = _rows(payload, "top", "rank: int", "geo_id: string", "opportunity_score: double").select(F.lit("top").alias("list"), F.col("geo_id").alias("key"), F.col("opportunity_score").alias("value"))
    hubs = _rows(payload, "hubs", "subdomain: string", "country_code: string", "experts: long").select(F.lit("hub").alias("list"), F.concat_ws(":", "subdomain", "country_code").alias("key"), F.col("experts").cast("double").alias("value"))
    return measures.unionByName(top).unionByName(hubs)


add("summary_payload", _summary,
    """SELECT 'kpi' AS list, unnest(['qualified_repos', 'experts', 'located_coverage', 'sufficient_countries']) AS key, unnest([(SELECT CAST(count(*) AS DOUBLE) FROM classified WHERE classification_status = 'accepted'), (SELECT count(DISTINCT actor_login) FROM contributor_scores), (SELECT count(normalized_country_code) / count(*) FROM actor_geo), (SELECT count(*) FROM rankings WHERE geo_level = 'country' AND recommendation_tier <> 'insufficient_data')]) AS value
  UNION ALL SELECT * FROM (SELECT 'top', geo_id, opportunity_score FROM rankings WHERE geo_level = 'country' AND recommendation_tier <> 'insufficient_data' ORDER BY rank LIMIT 5)
  UNION ALL SELECT 'hub', subdomain || ':' || country_code, experts FROM (SELECT * FROM subdomain_counts QUALIFY row_number() OVER (PARTITION BY subdomain ORDER BY experts DESC, country_code) = 1)""", "value")


def _sorted(s: Stages) -> DataFrame:
    """Countries by experts, as a table shows them, with the place that each row has."""
    shown = publish.table_sort(s.rankings.where("geo_level = 'country'").select("geo_id", "observable_expert_count"), "observable_expert_count", "geo_id", ascending=False)
    return shown.withColumn("place", F.row_number().over(Window.orderBy(F.monotonically_increasing_id())).cast("long"))  # a row per country


add("table_sort", _sorted, "SELECT geo_id, observable_expert_count, row_number() OVER (ORDER BY observable_expert_count DESC, geo_id) AS place FROM rankings WHERE geo_level = 'country'")
