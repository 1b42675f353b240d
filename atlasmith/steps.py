"""Queries of the single rules and steps, beside the whole jobs of catalog.py, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from atlasmith import catalog as K
from atlasmith import settings as C
from atlasmith.functions import expressions as X
from atlasmith.operators import classify, discovery, locations, publish, quality, scores
from atlasmith.plans import adapters as A
from atlasmith.plans import gazetteer
from atlasmith.plans import sql as Q
from atlasmith.plans.stages import Stages
from atlasmith.sources import snapshots
from atlasmith.sources import tables as T

add, table = K.add, K.table
#: All queries of the analytics part, those of catalog.py included.
QUERIES, ORACLES = K.QUERIES, K.ORACLES


# 2.1 sources


def _dim_csv(s: Stages) -> DataFrame:
    path = snapshots.fresh(s.spark, "dim")
    table(s, "customer").select("c_name", F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment")).alias("c_mktsegment"), "c_nationkey").write.option("header", True).csv(path)
    return T.read_dim_csv(s.spark, path, "c_name string, c_mktsegment string, c_nationkey long")


add("read_dim_csv", _dim_csv, "SELECT c_name, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS c_mktsegment, c_nationkey FROM customer")

# 2.2 discovery rules

_with_payload = lambda s: X.payload_extract(s.events)
_repos = lambda s: s.grid.select("repo_name").distinct()
_whole = lambda s: discovery.per_repo_rollup(discovery.per_actor_rollup(s.grid))
add("pr_era_logic", lambda s: _with_payload(s).groupBy("repo_name").agg(F.count_if(X.pr_closed()).alias("closed"), F.count_if(X.pr_merged()).alias("merged")),
    "SELECT repo_name, count(*) FILTER (type = 'PullRequestEvent' AND action IN ('closed', 'merged')) AS closed, count(*) FILTER (type = 'PullRequestEvent' AND (action = 'merged' OR (action = 'closed' AND flag))) AS merged FROM act_events WHERE type IS NOT NULL GROUP BY 1")
add("push_commits", lambda s: _with_payload(s).groupBy("repo_name").agg(F.sum(X.push_commits()).alias("commits")), "SELECT repo_name, CAST(coalesce(sum(size) FILTER (type = 'PushEvent'), 0) AS BIGINT) AS commits FROM act_events WHERE type IS NOT NULL GROUP BY 1")
add("is_bot", lambda s: s.grid.select("actor_login").distinct().select("actor_login", X.is_bot(X.bot_label("actor_login")).alias("is_bot")), "SELECT DISTINCT actor_login, is_bot FROM grid")
add("taxonomy_name_match", lambda s: _repos(s).select("repo_name", X.taxonomy_name_match("repo_name", A.TERMS).alias("is_match")), f"SELECT DISTINCT repo_name, {Q.MATCH} AS is_match FROM grid")
add("split_repo_name", lambda s: _repos(s).select("repo_name", X.owner_of("repo_name").alias("owner"), X.short_name_of("repo_name").alias("short")), "SELECT DISTINCT repo_name, split_part(repo_name, '/', 1) AS owner, split_part(repo_name, '/', 2) AS short FROM grid")
add("weighted_activity", lambda s: s.activity.select("repo_name", X.weighted_activity({c: c for c in C.EVENT_WEIGHTS}).alias("weighted")), f"SELECT repo_name, {Q.weighted({c: c for c in C.EVENT_WEIGHTS})} AS weighted FROM repo_activity", "weighted")
add("safe_share", lambda s: _whole(s).select("repo_name", X.safe_share("bot_counted_events", F.col("bot_counted_events") + F.col("human_counted_events")).alias("share")),
    "SELECT repo_name, coalesce(coalesce(sum(counted_events) FILTER (is_bot), 0) / nullif(sum(counted_events), 0), 0) AS share FROM per_actor GROUP BY 1", "share")
add("summary_bound", lambda s: _whole(s).withColumn("is_taxonomy_candidate", X.taxonomy_name_match("repo_name", A.TERMS)).where(discovery.summary_bound()).select("repo_name", "unique_human_contributors"), "SELECT repo_name, unique_human_contributors FROM repo_activity")
add("prs_or_reviews", lambda s: s.activity.select("repo_name", X.prs_or_reviews().alias("pull_requests_or_reviews")), "SELECT repo_name, pull_requests_opened + reviews_submitted AS pull_requests_or_reviews FROM repo_activity")
add("candidate_floor", lambda s: s.activity.select("repo_name", X.candidate_floor().alias("is_floor")), "SELECT repo_name, is_floor FROM discovery")
add("failed_minimums", lambda s: s.discovered.select("repo_name", X.failed_minimums(A.MINIMUMS).alias("failed")), "SELECT repo_name, failed FROM discovery")
add("exclusion_reason", lambda s: s.discovered.groupBy("exclusion_reason").agg(F.count("*").alias("n")), "SELECT exclusion_reason, count(*) AS n FROM discovery GROUP BY 1")

# 2.3 joins

_actor_repo = ["actor_login", "repo_name"]
_accepted = "SELECT repo_name FROM classified WHERE classification_status = 'accepted'"
add("join_repo_days", lambda s: discovery.join_repo_days(_whole(s), discovery.active_days_exact(discovery.month_day_mask(s.grid))).select("repo_name", "active_days", "active_months"),
    "SELECT repo_name, coalesce(active_days, 0) AS active_days, coalesce(active_months, 0) AS active_months FROM (SELECT DISTINCT repo_name FROM per_actor) LEFT JOIN repo_days USING (repo_name)")
add("join_score_inputs", lambda s: scores.join_score_inputs(s.classified, s.activity, s.metadata).select("repo_name", "classification_score", "meaningful_events", "release_count"),
    "SELECT repo_name, classification_score, meaningful_events, release_count FROM classified JOIN repo_activity USING (repo_name) JOIN repo_meta USING (repo_name) WHERE classification_status = 'accepted'", "classification_score")
add("join_single_actor_share", lambda s: classify.join_single_actor_share(s.metadata, s.activity).select("repo_name", "single_actor_event_share"), "SELECT repo_name, single_actor_event_share FROM repo_meta LEFT JOIN repo_activity USING (repo_name)", "single_actor_event_share")
add("semi_accepted_activity", lambda s: scores.semi_accepted_activity(s.contributors, s.classified).select(*_actor_repo), f"SELECT actor_login, repo_name FROM contributor WHERE repo_name IN ({_accepted})")
add("semi_qualified_activity", lambda s: scores.semi_qualified_activity(s.contributors, s.classified, s.repo_scores).select(*_actor_repo), f"SELECT actor_login, repo_name FROM contributor WHERE repo_name IN ({_accepted} INTERSECT SELECT repo_name FROM repo_scores)")
add("join_quality", lambda s: scores.join_quality(s.contributors, s.repo_scores).select(*_actor_repo, "quality"), "SELECT actor_login, repo_name, repository_quality_score AS quality FROM contributor JOIN repo_scores USING (repo_name)", "quality")
add("join_location_default", lambda s: scores.join_location_default(s.grid.select("actor_login").distinct(), s.locations), "SELECT actor_login, normalized_country_code AS country_code, normalized_city AS city, coalesce(location_confidence, 'unusable') AS location_confidence FROM (SELECT DISTINCT actor_login FROM grid) LEFT JOIN actor_geo USING (actor_login)")
add("join_scored_actors", lambda s: scores.join_scored_actors(s.contributors, s.contributor_scores).select(*_actor_repo), "SELECT actor_login, repo_name FROM contributor JOIN contributor_scores USING (domain_id, actor_login)")

# 2.4 aggregations

add("month_day_mask", lambda s: discovery.month_day_mask(s.grid), "SELECT * FROM masks")
add("per_repo_rollup", lambda s: _whole(s).select("repo_name", "unique_human_contributors", "push_events", "human_counted_events", "bot_counted_events", "top_human_actor_events", "first_seen", "last_seen"),
    "SELECT repo_name, count(*) FILTER (NOT is_bot AND counted_events > 0) AS unique_human_contributors, CAST(coalesce(sum(push_events) FILTER (NOT is_bot), 0) AS BIGINT) AS push_events, CAST(coalesce(sum(counted_events) FILTER (NOT is_bot), 0) AS BIGINT) AS human_counted_events, CAST(coalesce(sum(counted_events) FILTER (is_bot), 0) AS BIGINT) AS bot_counted_events, max(counted_events) FILTER (NOT is_bot) AS top_human_actor_events, min(first_seen) FILTER (NOT is_bot) AS first_seen, max(last_seen) FILTER (NOT is_bot) AS last_seen FROM per_actor GROUP BY 1")
add("event_points", lambda s: s.contributors.select(*_actor_repo, scores.event_points().alias("points")), f"SELECT actor_login, repo_name, {Q._points} AS points FROM contributor", "points")
_evidence_rows = lambda s: scores.evidence_rows(s.contributors, s.classified, s.repo_scores)
for _name, _column in (("days_lower_bound", "days"), ("months_lower_bound", "months")):
    add(_name, lambda s, c=_column: scores.active_time_bounds(_evidence_rows(s)).where(F.col("days") >= C.MIN_ACTIVE_DAYS).select("domain_id", "actor_login", c), f"SELECT domain_id, actor_login, {_column} FROM evidence")
add("quality_exposure", lambda s: _evidence_rows(s).join(s.contributor_evidence, scores.CONTRIBUTOR_KEY, "left_semi").groupBy(*scores.CONTRIBUTOR_KEY).agg(scores.quality_exposure().alias("exposure")), "SELECT domain_id, actor_login, exposure FROM evidence", "exposure")

_members = lambda s: scores.geo_membership(s.contributor_scores, s.locations)
_known = lambda s: scores.join_scored_actors(scores.semi_accepted_activity(s.contributors, s.classified), s.contributor_scores)
_org = lambda s: scores.repo_org_activity(scores.geo_repo_points(_members(s), _known(s)))
_geo = ["geo_level", "country_code", "city"]
_geo_sql = ", ".join(_geo)
add("weighted_supply", lambda s: _members(s).groupBy(*_geo).agg(F.sum(scores.weighted_supply()).alias("supply")), f"SELECT {_geo_sql}, sum(least(expert_score, 85.0) / 100) AS supply FROM members GROUP BY ALL", "supply")
add("capped_supply", lambda s: scores.capped_supply(_members(s), _org(s)[0]).select(*_geo, "weighted_expert_count", "capped_supply"), f"SELECT {_geo_sql}, weighted_expert_count, capped_supply FROM geo_evidence", "weighted_expert_count capped_supply")
add("repo_org_activity", lambda s: _org(s)[1].select(*_geo, "owner", "points"), f"SELECT {_geo_sql}, owner, points FROM geo_owners", "points")
add("max_share", lambda s: scores.max_share(_org(s)[1], "share", "n").select(*_geo, "share", "n"), f"SELECT {_geo_sql}, max(points) / sum(points) AS share, count(*) AS n FROM geo_owners GROUP BY ALL", "share")
add("share_signals", lambda s: scores.share_signals(scores.actor_activity(_members(s), _known(s), A.WINDOW[1])).select(*_geo, "observable_expert_count", "multi_repo_share", "review_participation", "recurring_share"),
    f"SELECT {_geo_sql}, observable_expert_count, multi_repo_share, review_participation, recurring_share FROM geo_members", "multi_repo_share review_participation recurring_share")
add("momentum_direction", lambda s: s.geo_evidence.select(*_geo, scores.momentum_direction().alias("momentum")), f"SELECT {_geo_sql}, momentum_score AS momentum FROM geo_scaled", "momentum")
add("sample_gate", lambda s: s.geo_evidence.select(*_geo, scores.sample_gate(A.SAMPLES).alias("ok")), f"SELECT {_geo_sql}, samples_ok AS ok FROM geo_scaled")

# 2.5 statistics over geographies

add("top_quartile_share", lambda s: scores.top_quartile_share(_members(s)).select(*_geo, "top_quartile_share"), f"SELECT {_geo_sql}, top_quartile_share FROM geo_members", "top_quartile_share")
add("geo_rank", lambda s: scores.geo_rank(s.rankings.drop("rank")).select("geo_level", "geo_id", F.col("rank").cast("long").alias("rank")), "SELECT geo_level, geo_id, rank FROM rankings")
add("top_subdomains", lambda s: scores.top_subdomains(_org(s)[0], s.classified).select(*_geo, "subdomain_count"), f"SELECT {_geo_sql}, count(DISTINCT s) AS subdomain_count FROM geo_repos JOIN subdomain_rows USING (repo_name) GROUP BY ALL")
add("recommendation_topk", lambda s: publish.recommendation_topk(s.rankings).select("geo_id", "recommendation_tier"), "SELECT geo_id, recommendation_tier FROM rankings WHERE geo_level = 'country' AND recommendation_tier <> 'insufficient_data' ORDER BY CASE recommendation_tier WHEN 'priority' THEN 0 WHEN 'promising' THEN 1 ELSE 2 END, rank LIMIT 3")


def _two_rankings(s: Stages) -> DataFrame:
    """Ranks by score, and by number of experts as the other scenario."""
    by = Window.partitionBy("domain_id", "geo_level").orderBy(F.desc("observable_expert_count"), "geo_id")
    base = s.rankings.select(F.lit("baseline").alias("scenario"), "domain_id", "geo_level", "geo_id", "rank")
    return base.unionByName(s.rankings.select(F.lit("experts").alias("scenario"), "domain_id", "geo_level", "geo_id", F.row_number().over(by).alias("rank")))


add("scenario_shift", lambda s: quality.scenario_shift(_two_rankings(s)).select("scenario", "geo_level", "geo_id", F.col("shift").cast("long").alias("shift")),
    "SELECT unnest(['baseline', 'experts']) AS scenario, geo_level, geo_id, unnest([0, moved - rank]) AS shift FROM (SELECT *, row_number() OVER (PARTITION BY domain_id, geo_level ORDER BY observable_expert_count DESC, geo_id) AS moved FROM rankings)")

# 2.7 scalar functions, each over a table

_part = lambda s, c: table(s, "part").select("p_partkey", c.alias("x"))
_messy, _messy_sql = lambda: F.concat("p_name", F.lit(" _"), "p_brand", F.lit("./")), "p_name || ' _' || p_brand || './'"
_path, _path_sql = lambda: F.concat("p_type", F.lit("/"), "p_name"), "p_type || '/' || p_name"
for _name, _make, _sql in (
    ("normalize_token", lambda: X.normalize_token(_messy()), rf"trim(regexp_replace(lower({_messy_sql}), '[\s\-_./]+', '-', 'g'), '-')"),
    ("repo_short_name", lambda: X.repo_short_name(_path()), f"regexp_replace({_path_sql}, '^[^/]*/', '')"),
    ("term_pattern", lambda: F.lower("p_name").rlike(X.term_pattern("red widget")), r"regexp_matches(lower(p_name), '(^|[^a-z0-9])red[\s\-_./]+widget($|[^a-z0-9])')"),
    ("normalize_key", lambda: locations.normalize_key(F.concat(F.lit("  É"), "p_name", F.lit("  "), "p_brand")), "'e' || lower(p_name) || ' ' || lower(p_brand)"),
    ("clean_text", lambda: locations.clean_text(F.concat(F.lit(" ,🌍 "), "p_name", F.lit("  "), "p_type", F.lit(" ;-"))), "p_name || ' ' || p_type"),
    ("split_multi_location", lambda: F.array_join(X.split_multi_location(F.concat("p_name", F.lit(" / "), "p_type", F.lit(" AND "), "p_brand")), "|"), "concat_ws('|', p_name, p_type, p_brand)"),
    ("comma_segments", lambda: F.array_join(X.comma_segments(F.concat("p_name", F.lit(" , ,"), "p_type")), "|"), "concat_ws('|', p_name, p_type)"),
    ("city_geo_id", lambda: X.city_geo_id("p_brand", "p_name"), "p_brand || '-' || replace(lower(p_name), ' ', '-')"),
    ("city_slug", lambda: X.city_slug(_path()), f"replace(replace(lower({_path_sql}), '/', '-'), ' ', '-')"),
    ("subdomain_display", lambda: X.subdomain_display(F.concat_ws("_", "p_type", "p_brand")), "upper(p_type[1]) || lower(p_type[2:]) || ' ' || upper(p_brand[1]) || lower(p_brand[2:])"),
    ("display_name", lambda: X.display_name("p_brand", F.when(F.col("p_size") % 2 == 0, F.col("p_type")), F.when(F.col("p_size") % 3 == 0, F.col("p_name"))), "coalesce(CASE WHEN p_size % 3 = 0 THEN p_name END, CASE WHEN p_size % 2 = 0 THEN p_type END, p_brand, 'Unknown')"),
    ("evidence_count", lambda: X.evidence_count(F.split("p_name", " "), F.when(F.col("p_size") % 2 == 0, F.split("p_brand", "#"))).cast("long"), "len(string_split(p_name, ' ')) + CASE WHEN p_size % 2 = 0 THEN len(string_split(p_brand, '#')) ELSE 0 END"),
    ("confidence_band", lambda: X.confidence_band(F.col("p_size") * 2), "CASE WHEN p_size * 2 >= 70 THEN 'high' WHEN p_size * 2 >= 40 THEN 'medium' ELSE 'low' END"),
    ("is_low_confidence", lambda: X.is_low_confidence(F.when(F.col("p_type") == "PROMO", "insufficient_data").otherwise("monitor"), F.col("p_size") * 2), "p_type = 'PROMO' OR p_size * 2 < 40"),
):
    add(_name, lambda s, make=_make: _part(s, make()), f"SELECT p_partkey, {_sql} AS x FROM part")
for _name, _make, _sql in (
    ("review_ratio", lambda: X.review_ratio("p_size", F.lit(30)), "least(p_size / 30.0, 1.0) * 100"), ("round4", lambda: X.round4(F.col("p_retailprice") / 7), "p_retailprice / 7"),
    ("null_or_positive", lambda: X.null_or_positive(F.when(F.col("p_size") % 3 > 0, F.col("p_size") % 2 == 0)), "CAST(CASE WHEN p_size % 3 > 0 AND p_size % 2 = 0 THEN 100 ELSE 0 END AS DOUBLE)"),
):
    add(_name, lambda s, make=_make: _part(s, make()), f"SELECT p_partkey, {_sql} AS x FROM part", "x")
_order = lambda s, *c: table(s, "orders").select("o_orderkey", *c)
add("month_bounds", lambda s: _order(s, *(c.alias(n) for c, n in zip(X.month_bounds(F.to_date("o_orderdate")), ("first", "last"), strict=True))), "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS first, last_day(o_orderdate) AS last FROM orders")
add("previous_month", lambda s: _order(s, X.previous_month(F.to_date("o_orderdate")).alias("x")), "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH AS DATE) AS x FROM orders")
add("days_since", lambda s: _order(s, X.days_since(F.lit(A.WINDOW[1]), F.to_date("o_orderdate")).cast("long").alias("x")), f"SELECT o_orderkey, {Q.END} - CAST(o_orderdate AS DATE) AS x FROM orders")


def _camel(s: Stages) -> DataFrame:
    named = table(s, "supplier").select(F.col("s_name").alias("supplier_full_name"))
    return named.select(F.get_json_object(T.json_row(named), f"$.{X.camel_case('supplier_full_name')}").alias("x"))


add("camel_case", _camel, "SELECT s_name AS x FROM supplier")


# 2.8 classification

for _name, _match, _kind in (
    ("match_topics", classify.match_topics, "topic"), ("match_description_terms", classify.match_description_terms, "term"),
    ("negative_terms", classify.negative_terms, "negative"), ("content_signals", classify.content_signals, "file"), ("language_hint", classify.language_hint, "language"),
):
    add(_name, lambda s, match=_match: match(s.metadata, s.taxonomy).select("repo_name", "subdomain_id", "item"), f"SELECT repo_name, subdomain_id, item FROM ({K._matches}) WHERE kind = '{_kind}'")
_named = lambda s: s.metadata.withColumn("repo_name", F.concat_ws("/", F.split("repo_name", "/")[1], F.replace("description", F.lit(" "), F.lit("-"))))
add("match_name_terms", lambda s: classify.match_name_terms(_named(s), s.taxonomy).select("repo_name", "subdomain_id", "item"),
    f"SELECT split_part(repo_name, '/', 2) || '/' || replace(description, ' ', '-') AS repo_name, subdomain_id, item FROM repo_meta JOIN taxonomy ON kind = 'term' AND regexp_matches(replace(description, ' ', '-'), {K._phrase})")
add("license_recognized", lambda s: s.metadata.select("repo_name", classify.license_recognized("license_spdx_id").alias("ok")), "SELECT repo_name, license_spdx_id IS NOT NULL AS ok FROM repo_meta")
_judged = lambda s: classify.judged(s.metadata, s.activity, classify.best_subdomains(classify.subdomain_score(classify.all_matches(s.metadata, s.taxonomy.where(F.col("domain_id") == A.DOMAIN)))))
for _name, _make, _column in (("classification_decision", classify.classification_decision, "classification_status"), ("chosen_order", classify.chosen_order, "subdomains"), ("classification_score", classify.classification_score, "classification_score")):
    add(_name, lambda s, make=_make, c=_column: _judged(s).select("repo_name", make().alias(c)), f"SELECT repo_name, {_column} FROM ({K._classified})", "classification_score" if _name == "classification_score" else "")

# 2.9 locations: each stage runs on the texts that come to it; the SQL names the forms of text that it decides

_place = ["actor_login", "normalized_country_code", "normalized_city", "location_level", "location_confidence"]
#: Forms (of gazetteer.profiles) on which a stage is the first with an answer.
STAGES = {
    "stage_country": "form = 2", "stage_us_state_pair": "form = 4 AND nation = 0", "stage_city_country": "form IN (3, 7)", "stage_region_anchor": "(form = 5 AND nation > 0) OR form = 9",
    "stage_state_or_region_city": "(form = 4 AND nation > 0) OR form = 10", "stage_head_only": "form = 15", "stage_single_term": "form IN (6, 8, 14)",
}


def _texts(s: Stages) -> tuple[DataFrame, locations.Dims]:
    tables = [table(s, t) for t in ("customer", "nation", "region")]
    return gazetteer.profiles(*tables).select("actor_login", F.col("public_location_raw").alias("raw_location")), gazetteer.star_dims(*tables)


def _placed(found: DataFrame) -> DataFrame:
    """(actor_login, answer) as columns."""
    return found.select("actor_login", F.col("answer.code").alias("normalized_country_code"), F.col("answer.city").alias("normalized_city"), F.col("answer.level").alias("location_level"), F.col("answer.confidence").alias("location_confidence"))


def _stage_alone(s: Stages, name: str) -> DataFrame:
    people, dims = _texts(s)
    usable, _ = locations.null_and_placeholder(people)
    one = usable.where(F.size("parts") < 2)
    answers = locations.run_stage(one.select("text").distinct(), dims, name)
    return _placed(people.join(one.select("raw_location", "text"), "raw_location").join(answers, "text"))


for _name, _decided in STAGES.items():
    add(_name, lambda s, name=_name: _stage_alone(s, name), f"SELECT {', '.join(_place)} FROM ({gazetteer.ORACLE}) WHERE {_decided}")


def _lost(s: Stages) -> DataFrame:
    people, _ = _texts(s)
    return _placed(people.join(locations.null_and_placeholder(people)[1], "raw_location"))


def _several(s: Stages) -> DataFrame:
    people, dims = _texts(s)
    usable, _ = locations.null_and_placeholder(people)
    _, several = locations.located_parts(usable, dims)
    return _placed(people.join(locations.stage_multi(several).withColumnRenamed("merged", "answer"), "raw_location"))


def _city_candidates(s: Stages) -> DataFrame:
    """Cities of a text's first segment in the country that its last one names: the largest, and how many there are."""
    people, dims = _texts(s)
    usable, _ = locations.null_and_placeholder(people)
    wide = locations.pivoted(usable.select("text").distinct(), dims).where("country_city is not null")
    return people.join(usable.select("raw_location", "text"), "raw_location").join(wide, "text").select("actor_login", F.col("country_city.c.name").alias("city"), F.col("country_city.c.country_code").alias("country_code"), F.col("country_city.n").alias("n"))


add("null_and_placeholder", _lost, f"SELECT {', '.join(_place)} FROM ({gazetteer.ORACLE}) WHERE form = 1")
add("stage_multi", _several, f"SELECT {', '.join(_place)} FROM ({gazetteer.ORACLE}) WHERE form IN (11, 12)")
add("dim_city_join", _city_candidates, f"SELECT actor_login, normalized_city AS city, normalized_country_code AS country_code, CAST(1 AS BIGINT) AS n FROM ({gazetteer.ORACLE}) WHERE form IN (3, 7)")


def _curated_dims(s: Stages) -> locations.Dims:
    """Segments of nations as curated strings: overrides for one nation in four, aliases for another."""
    segment = table(s, "customer").select("c_mktsegment", "c_nationkey").distinct()
    rows = segment.join(table(s, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.concat("c_mktsegment", F.lit(" of "), "n_name").alias("raw"), F.concat(F.lit("N"), "n_nationkey").alias("code"), "n_nationkey")
    level = F.when(F.col("n_nationkey") % 3 == 0, "region").otherwise("country")
    none = F.lit(None).cast("string").alias("city")
    dims = gazetteer.dims(s.spark)
    dims.override = rows.where("n_nationkey % 4 = 0").select(F.col("raw").alias("raw_location"), "code", none, level.alias("level"))
    dims.alias = rows.where("n_nationkey % 4 = 1").select(F.upper("raw").alias("alias"), "code", none, level.alias("level"))
    return dims


def _curated_people(s: Stages) -> DataFrame:
    people = table(s, "customer").join(table(s, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return people.select(F.concat(F.lit("c"), "c_custkey").alias("actor_login"), F.concat("c_mktsegment", F.lit("  of "), "n_name").alias("public_location_raw"), F.lit("success").alias("fetch_status"))


for _name, _join, _method, _value, _rest in (("override", locations.dim_override_join, "override", "over", 0), ("alias", locations.dim_alias_join, "alias", "also", 1)):
    _level = "CASE WHEN c_nationkey % 3 = 0 THEN 'region' ELSE 'country' END"
    add(f"stage_{_name}", lambda s, m=_method: locations.normalize_run(_curated_people(s), _curated_dims(s)).where(F.col("normalization_method") == m).select("actor_login", "normalized_country_code", "location_level", "location_confidence", "normalization_method"),
        f"SELECT 'c' || c_custkey AS actor_login, 'N' || c_nationkey AS normalized_country_code, {_level} AS location_level, CASE WHEN c_nationkey % 3 = 0 THEN 'low' ELSE 'high' END AS location_confidence, '{_method}' AS normalization_method FROM customer WHERE c_nationkey % 4 = {_rest}")
    add(f"dim_{_name}_join", lambda s, join=_join, v=_value: join(_curated_people(s).select("actor_login", locations.normalize_key("public_location_raw").alias("whole_key")), _curated_dims(s)).select("actor_login", "whole_key", F.col(f"{v}.code").alias("code"), F.col(f"{v}.level").alias("level")),
        f"SELECT 'c' || c_custkey AS actor_login, lower(c_mktsegment || ' of ' || n_name) AS whole_key, CASE WHEN c_nationkey % 4 = {_rest} THEN 'N' || c_nationkey END AS code, CASE WHEN c_nationkey % 4 = {_rest} THEN {_level} END AS level FROM customer JOIN nation ON c_nationkey = n_nationkey")

_cities = lambda s: table(s, "part").select(F.lower("p_name").alias("key"), F.col("p_name").alias("name"), F.col("p_brand").alias("country_code"), F.col("p_type").alias("admin1"), (F.col("p_size").cast("long") * F.col("p_partkey")).alias("population"), F.lit(None).cast("double").alias("latitude"), F.lit(None).cast("double").alias("longitude"))
add("dominant_city", lambda s: locations.dominant_city(_cities(s)).select("key", F.col("top.country_code").alias("country_code"), F.col("top.population").alias("population"), "dominant", "n"),
    """SELECT key, max(country_code) FILTER (r = 1) AS country_code, max(population) FILTER (r = 1) AS population, max(population) FILTER (r = 1) >= 100000 AND (coalesce(max(population) FILTER (r = 2), 0) <= 0 OR max(population) FILTER (r = 1) >= 5 * max(population) FILTER (r = 2)) AS dominant, count(*) AS n
  FROM (SELECT lower(p_name) AS key, p_brand AS country_code, CAST(p_size AS BIGINT) * p_partkey AS population, row_number() OVER (PARTITION BY lower(p_name) ORDER BY CAST(p_size AS BIGINT) * p_partkey DESC, p_brand, p_type, p_name) AS r FROM part) GROUP BY 1""")


def _regions(s: Stages) -> DataFrame:
    dims = gazetteer.dims(s.spark)
    people = table(s, "customer")
    dims.us_state = people.where("c_custkey % 5 = 1").select(F.lower("c_name").alias("key"), F.lit("XX").alias("code"))
    dims.region = people.select(F.lower("c_name").alias("key"), F.concat(F.lit("N"), "c_nationkey").alias("country"))
    return locations.region_country(dims)


add("region_country", _regions, "SELECT lower(c_name) AS key, CASE WHEN c_custkey % 5 = 1 THEN 'US' ELSE 'N' || c_nationkey END AS country FROM customer")
add("country_key_dim", lambda s: locations.country_key_dim(table(s, "customer").select(F.concat(F.lit("N"), "c_custkey").alias("code"), F.col("c_name").alias("name"), F.array(F.lower("c_name"), "c_mktsegment").alias("forms"))),
    "SELECT key, code, name FROM (SELECT 'N' || c_custkey AS code, c_name AS name, unnest([c_name, 'N' || c_custkey, lower(c_name), c_mktsegment]) AS form, unnest([0, 1, 2, 3]) AS pos, lower(form) AS key FROM customer) QUALIFY row_number() OVER (PARTITION BY key ORDER BY pos, code) = 1")
add("city_key_dim", lambda s: locations.city_key_dim(_cities(s).drop("key").withColumn("alternates", F.array(F.lower("admin1"), F.lit("ab"), F.lit("東京")))).groupBy("key").agg(F.count("*").alias("n")),
    "SELECT key, count(*) AS n FROM (SELECT DISTINCT unnest([lower(p_name), lower(p_type), '東京']) AS key, p_name, p_brand, p_type FROM part) GROUP BY 1")
for _name, _make, _sql in (("eligible_country", locations.eligible_country, "location_confidence IN ('high', 'medium')"), ("eligible_city", locations.eligible_city, "location_level = 'city' AND location_confidence = 'high'")):
    add(_name, lambda s, make=_make: s.locations.select("actor_login", make().alias("ok")), f"SELECT actor_login, {_sql} AS ok FROM actor_geo")

# 2.10 components of the scores, each from its table of signals

_repo_signals, _contrib_signals = lambda s: s.repo_signals, lambda s: s.contributor_signals
_geo_signals = lambda s: scores.geo_signals(s.geo_evidence).withColumn("geo_id", scores.geo_id())
_confidence = lambda: scores.geo_confidence(A.SAMPLES)
for _signals, _source, _keys, _made in (
    (_repo_signals, "repo_scores", "repo_name", {"repo_recent_activity": (scores.repo_recent_activity, "recent_activity_score"), "repo_diversity": (scores.repo_diversity, "contributor_diversity_score"), "repo_collaboration": (scores.repo_collaboration, "collaboration_quality_score"), "repo_relevance": (scores.repo_relevance, "technical_relevance_score"), "repo_maturity": (scores.repo_maturity, "repository_maturity_score")}),
    (_contrib_signals, "contributor_scores", "actor_login, domain_id", {"contrib_domain_activity": (scores.contrib_domain_activity, "domain_activity_score"), "contrib_quality": (scores.contrib_quality, "contribution_quality_score"), "contrib_exposure": (scores.contrib_exposure, "repository_quality_exposure_score"), "contrib_continuity": (scores.contrib_continuity, "continuity_score"), "contrib_collaboration": (scores.contrib_collaboration, "collaboration_score")}),
    (_geo_signals, "rankings", "geo_level, geo_id", {"geo_supply": (scores.geo_supply, "expert_supply_score"), "geo_quality": (scores.geo_quality, "expert_quality_score"), "geo_collaboration": (scores.geo_collaboration, "collaboration_depth_score"), "geo_breadth": (scores.geo_breadth, "ecosystem_breadth_score"), "geo_confidence": (_confidence, "confidence_score")}),
):
    for _name, (_component, _column) in _made.items():
        add(_name, lambda s, signals=_signals, keys=_keys, component=_component, c=_column: signals(s).select(*keys.split(", "), component().alias(c)), f"SELECT {_keys}, {_column} FROM {_source}", _column)
_opportunity = lambda s: scores.geo_components(_geo_signals(s), A.SAMPLES).withColumn("opportunity_score", scores.geo_opportunity())
add("geo_opportunity", lambda s: _opportunity(s).select("geo_level", "geo_id", "opportunity_score"), "SELECT geo_level, geo_id, opportunity_score FROM rankings", "opportunity_score")
add("assign_tier", lambda s: _opportunity(s).select("geo_level", "geo_id", X.assign_tier("opportunity_score", "confidence_score", "samples_ok").alias("recommendation_tier")), "SELECT geo_level, geo_id, recommendation_tier FROM rankings")
add("org_concentration_flag", lambda s: s.geo_evidence.select("geo_level", scores.geo_id().alias("geo_id"), scores.org_concentration_flag().alias("org_concentration_flag")), f"SELECT geo_level, geo_id, max_org_share > {C.ORG_SHARE_FLAG} AS org_concentration_flag FROM rankings")
