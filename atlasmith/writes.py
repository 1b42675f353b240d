"""Queries of what is written: tables replaced, appended to and merged, checks at the write, and published files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlasmith import catalog as K
from atlasmith import settings as C
from atlasmith import steps
from atlasmith.operators import discovery, publish, quality
from atlasmith.plans import adapters as A
from atlasmith.plans import planted as P
from atlasmith.plans import sql as Q
from atlasmith.plans.stages import Stages
from atlasmith.sources import snapshots
from atlasmith.sources import tables as T

add, table = K.add, K.table
#: All queries of the analytics part, those of catalog.py and steps.py included.
QUERIES, ORACLES = steps.QUERIES, steps.ORACLES


def fresh(s: Stages, name: str) -> str:
    return snapshots.fresh(s.spark, name)


# 2.1 tables


def _months(s: Stages) -> DataFrame:
    """Even months, then what a broken run left of odd ones, then all, then all again: (month, rows, run that wrote it)."""
    path = fresh(s, "months")
    runs = [T.materialize_months(s.grid.where("month % 2 = 0"), path)]
    s.grid.where("month % 2 = 1").write.partitionBy("month").mode("append").parquet(f"{path}/rows")
    runs += [T.materialize_months(s.grid, path) for _ in range(2)]
    written = [m.withColumn("run", F.lit(i + 1)) for i, m in enumerate(runs)]
    rows = snapshots.read_months(s.spark, path, s.grid.schema).groupBy("month").agg(F.count("*").alias("rows"), F.sum("push_events").alias("pushes"))
    return rows.join(written[0].unionByName(written[1]).unionByName(written[2]), "month")


add("materialize_months", _months, "SELECT month, count(*) AS rows, CAST(sum(push_events) AS BIGINT) AS pushes, CAST(CASE WHEN month % 2 = 0 THEN 1 ELSE 2 END AS INTEGER) AS run FROM grid GROUP BY 1")


def _refreshed(s: Stages) -> DataFrame:
    """A table replaced from itself, and then by a write that breaks, which leaves it as it was."""
    path = fresh(s, "statuses")
    counts = T.refresh_table(s.discovered.groupBy("discovery_status").agg(F.count("*").alias("n")), path)
    twice = T.refresh_table(counts.withColumn("n", F.col("n") * 2), path)
    try:
        T.refresh_table(twice.select("discovery_status", F.when(F.col("n") > 0, F.raise_error(F.lit("broken write")).cast("long")).alias("n")), path)
    except Exception as broken:
        if "broken write" not in str(broken):
            raise
        return T.read_stage_parquet(s.spark, path)
    raise AssertionError("the write should have broken")


add("refresh_table", _refreshed, "SELECT discovery_status, count(*) * 2 AS n FROM discovery GROUP BY 1")
add("export_summary", lambda s: T.export_summary(s.discovered, fresh(s, "summary")).select("repo_name", "discovery_status", "meaningful_events"), "SELECT repo_name, discovery_status, meaningful_events FROM discovery")


def _candidates(s: Stages) -> DataFrame:
    """Written, then read back; each row with the counts that the export gives."""
    path = fresh(s, "candidates")
    counts = T.export_candidates(s.discovered, path).first()
    return T.read_stage_parquet(s.spark, path, ["repo_name", "discovery_status"]).withColumns({c: F.lit(counts[c]).cast("long") for c in ("accepted", "excluded")})


add("export_candidates", _candidates, "SELECT repo_name, discovery_status, count(*) FILTER (discovery_status = 'accepted') OVER () AS accepted, count(*) FILTER (discovery_status = 'excluded') OVER () AS excluded FROM discovery WHERE discovery_status IN ('accepted', 'excluded')")
add("export_contributors", lambda s: T.export_contributors(s.contributors, fresh(s, "contributors")).select("actor_login", "repo_name", "raw_contribution_points", "subdomains"), "SELECT actor_login, repo_name, raw_contribution_points, '' AS subdomains FROM contributor", "raw_contribution_points")


def _stage_file(s: Stages) -> str:
    path = fresh(s, "profiles")
    T.write_stage_parquet(table(s, "supplier").where("s_suppkey % 2 = 0"), path)
    T.write_stage_parquet(table(s, "supplier"), path)
    return path


add("write_stage_parquet", lambda s: T.write_stage_parquet(s.locations, fresh(s, "locations")).select("actor_login", "normalized_country_code", "location_confidence"), "SELECT actor_login, normalized_country_code, location_confidence FROM actor_geo")
add("read_stage_parquet", lambda s: T.read_stage_parquet(s.spark, _stage_file(s), ["s_suppkey", "s_name"]), "SELECT s_suppkey, s_name FROM supplier")


def _upserted(s: Stages) -> DataFrame:
    """Orders by customer, merged into buckets in two rounds: those that aren't finished, then all dates of the finished ones."""
    path = fresh(s, "latest")
    dates = table(s, "orders").select("o_custkey", "o_orderdate", F.when(F.col("o_orderstatus") == "F", "new").otherwise("old").alias("source"))
    T.merge_latest(dates.where("source = 'old'"), path, "o_custkey", "o_orderdate", 16)
    return T.merge_latest(dates.where("source = 'new'"), path, "o_custkey", "o_orderdate", 16)


add("upsert_latest", _upserted, """SELECT o_custkey, o_orderdate, source FROM (SELECT o_custkey, max(o_orderdate) AS o_orderdate, CASE WHEN o_orderstatus = 'F' THEN 'new' ELSE 'old' END AS source FROM orders GROUP BY 1, 3)
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, source) = 1""")

# 2.11 checks over tables with planted bad rows, each counted by its own SQL

_shown = ("check_name", "failing_rows", "status")
_negative = lambda columns: " OR ".join(f"{c} < 0" for c in columns.split())
_duplicates = lambda keys, view: f"SELECT count(*) AS n FROM (SELECT {keys} FROM {view} GROUP BY {keys} HAVING count(*) > 1)"
_count = lambda view, test: f"SELECT count(*) FILTER ({test}) AS n FROM {view}"
_row = lambda name, body: f"SELECT '{name}' AS check_name, n AS failing_rows, CASE WHEN n = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({body})"
CHECKS = {
    "check_repo_date_bounds": ("repo_date_bounds", _count("bad_repos", f"first_seen < {Q.START} OR last_seen > {Q.END} OR first_seen > last_seen")),
    "check_repo_non_negative": ("repo_non_negative_counts", _count("bad_repos", _negative("unique_human_contributors active_days active_months push_events push_commit_count pull_requests_opened pull_requests_closed merged_pull_requests reviews_submitted issues_opened issue_comments releases weighted_activity_score"))),
    "check_share_bounds": ("repo_share_bounds", _count("bad_repos", "automation_event_share NOT BETWEEN 0 AND 1 OR single_actor_event_share NOT BETWEEN 0 AND 1")),
    "check_merged_within_closed": ("merged_within_closed", _count("bad_repos", "merged_pull_requests > pull_requests_closed")),
    "check_meaningful_events": ("meaningful_events_consistency", _count("bad_repos", "meaningful_events <> push_events + pull_requests_opened + pull_requests_closed + reviews_submitted + issues_opened + issue_comments + releases")),
    "check_status_reason": ("status_reason_consistency", _count("bad_repos", "(discovery_status = 'accepted') <> (exclusion_reason IS NULL)")),
    "check_contributor_non_negative": ("contributor_non_negative_counts", _count("bad_contributors", _negative(" ".join(quality.CONTRIBUTOR_COUNTS)))),
    "check_contributor_membership": ("contributor_repo_membership", _count("bad_contributors", "repo_name NOT IN (SELECT repo_name FROM bad_repos WHERE discovery_status = 'accepted')")),
    "check_grid_duplicate_keys": ("grid_duplicate_keys", _duplicates("month, repo_name, actor_login", "bad_grid")), "check_repo_duplicate_keys": ("repo_duplicate_keys", _duplicates("repo_name", "bad_repos")),
    "check_contributor_duplicate_keys": ("contributor_duplicate_keys", _duplicates("actor_login, repo_name", "bad_contributors")),
}
_repos, _people, _grid = lambda s: P.repos(s.discovered), lambda s: P.contributors(s.contributors), lambda s: P.grid(s.grid)
_own_check = {
    "check_contributor_non_negative": lambda s: quality.check_contributor_non_negative(_people(s)), "check_contributor_membership": lambda s: quality.check_contributor_membership(_people(s), _repos(s)),
    "check_grid_duplicate_keys": lambda s: quality.check_keys(_grid(s), "grid"), "check_repo_duplicate_keys": lambda s: quality.check_keys(_repos(s), "repo"), "check_contributor_duplicate_keys": lambda s: quality.check_keys(_people(s), "contributor"),
}
for _name, (_check, _body) in CHECKS.items():
    _make = _own_check.get(_name) or (lambda s, check=_check: quality.check_rows(_repos(s), {check: quality.repo_tests(*A.WINDOW)[check]}))
    add(_name, lambda s, make=_make: make(s).select(*_shown), _row(_check, _body))
_every = " UNION ALL ".join(_row(*x) for x in CHECKS.values())
add("quality_checks", lambda s: quality.quality_checks(_repos(s), _grid(s), _people(s), *A.WINDOW).select(*_shown), _every)


def _gated(s: Stages) -> DataFrame:
    """Good tables are written; then tables with bad rows are stopped at their write. Each check with the rows that the tables still have."""
    path = fresh(s, "gated")
    quality.quality_gate(s.discovered, s.grid, s.contributors, *A.WINDOW, path)
    checks, _ = quality.quality_gate(_repos(s), _grid(s), _people(s), *A.WINDOW, path)
    left = {n: T.read_stage_parquet(s.spark, f"{path}/{n}").count() for n in ("grid", "repositories", "contributors")}
    kind = F.when(F.col("check_name").startswith("grid"), "grid").when(F.col("check_name").startswith("contributor"), "contributors").otherwise("repositories")
    kept = F.element_at(F.create_map(*(F.lit(x) for pair in left.items() for x in pair)), kind)
    return checks.select(*_shown, kept.cast("long").alias("rows_kept"))


add("quality_gate", _gated, f"""SELECT *, CASE WHEN starts_with(check_name, 'grid') THEN (SELECT count(*) FROM grid) WHEN starts_with(check_name, 'contributor') THEN (SELECT count(*) FROM contributor) ELSE (SELECT count(*) FROM discovery) END AS rows_kept FROM ({_every})""")

_rankings = lambda s: P.rankings(s.rankings)
_tiers = "(recommendation_tier = 'priority' AND (opportunity_score < 75 OR confidence_score < 70)) OR (recommendation_tier = 'promising' AND (opportunity_score < 60 OR confidence_score < 60)) OR (recommendation_tier <> 'insufficient_data' AND confidence_score < 45)"
for _name, _check, _test in (
    ("check_country_code", "country_code", "country_code IS NULL"), ("check_geo_ids", "geo_ids", "CASE WHEN geo_level = 'country' THEN geo_id <> country_code ELSE geo_id <> country_code || '-' || replace(lower(city), ' ', '-') END"),
    ("check_tier_threshold", "tier_threshold", _tiers), ("check_min_samples", "min_samples", f"recommendation_tier <> 'insufficient_data' AND qualified_repo_count < CASE WHEN geo_level = 'country' THEN {A.SAMPLES['country'][1]} ELSE {A.SAMPLES['city'][1]} END"),
):
    add(_name, lambda s, check=_check: quality.check_rankings(_rankings(s), A.SAMPLES).where(F.col("check_name") == check).select(*_shown), _row(_check, _count("bad_rankings", _test)))
add("check_rank_order", lambda s: quality.check_rank_order(_rankings(s)).select(*_shown),
    " UNION ALL ".join(_row(name, f"SELECT count(*) FILTER ({test}) AS n FROM (SELECT *, lag(rank) OVER w AS above, lag(opportunity_score) OVER w AS higher FROM bad_rankings WINDOW w AS (PARTITION BY domain_id, geo_level ORDER BY rank))") for name, test in (("rank_dense", "rank - coalesce(above, 0) <> 1"), ("rank_order", "recommendation_tier <> 'insufficient_data' AND opportunity_score > higher"))))
add("check_evidence_present", lambda s: quality.check_evidence_present(P.classified(s.classified)).select(*_shown), _row("evidence_present", _count("bad_classified", "classification_status = 'accepted' AND n_evidence = 0")))
add("check_event_ids", lambda s: quality.check_event_ids(P.events(table(s, "events")), "event_id").select(*_shown), _row("event_ids", _duplicates("event_id", "bad_events")))
add("check_rankings", lambda s: quality.check_rankings(_rankings(s), A.SAMPLES).unionByName(quality.check_rank_order(_rankings(s))).unionByName(quality.check_evidence_present(P.classified(s.classified))).unionByName(quality.check_event_ids(P.events(table(s, "events")), "event_id")).select(*_shown))
ORACLES["check_rankings"] = " UNION ALL ".join(f"SELECT * FROM ({ORACLES[n]})" for n in ("check_country_code", "check_geo_ids", "check_tier_threshold", "check_min_samples", "check_rank_order", "check_evidence_present", "check_event_ids"))
_bounded = (("bad_repo_scores", C.REPOSITORY, "repository_quality_score"), ("bad_rankings", C.OPPORTUNITY, "opportunity_score"))
add("check_score_bounds", lambda s: quality.check_score_bounds(P.repo_scores(s.repo_scores), C.REPOSITORY, "repository_quality_score").unionByName(quality.check_score_bounds(_rankings(s), C.OPPORTUNITY, "opportunity_score")).select(*_shown),
    " UNION ALL ".join(_row(f"{final}_{check}", _count(source, test)) for source, parts, final in _bounded
        for check, test in (("components", " OR ".join(f"{n}_score < 0 OR {n}_score > 100" for n in parts)), ("weighted_sum", f"abs({' + '.join(f'{w} * {n}_score' for n, w in parts.items())} - {final}) > 1e-6"))))


def _contract_tables(s: Stages) -> dict[str, DataFrame]:
    """The eight stage tables with all their columns, bad rows planted."""
    none, when = (lambda t: F.lit(None).cast(t)), F.lit("2026-08-01").cast("timestamp")
    size = F.col("release_count")
    metadata = s.metadata.withColumns({
        "stargazer_count": size * 3, "fork_count": F.when(size % 8 == 1, -size).otherwise(size), "issue_count": size, "pull_request_count": size, "pushed_at": when, "updated_at": none("timestamp"),
        "has_readme": F.when(size % 2 == 0, True), "graphql_fetched_at": F.when(size % 8 > 2, when), "is_disabled": F.when(size % 8 != 3, F.col("is_disabled")),
    })
    profiles = T.flatten_user_nodes(table(s, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("actor_login"), when.alias("fetched_at"), F.to_json(F.struct(
        F.lit("User").alias("__typename"), F.struct((F.col("c_nationkey").cast("long") - 2).alias("totalCount")).alias("followers"))).alias("node")))
    profiles = profiles.withColumns({"account_type": F.lower("account_type"), "fetch_status": F.when(F.length("actor_login") == 3, "lost").otherwise(F.col("fetch_status"))})
    located = s.locations.select(
        "actor_login", none("string").alias("raw_location"), "normalized_country_code", none("string").alias("normalized_country_name"), "normalized_city", (F.length("actor_login") * F.lit(40.0) - 60).alias("latitude"),
        none("double").alias("longitude"), F.when(F.col("location_level") == "unresolved", "nowhere").otherwise(F.col("location_level")).alias("location_level"), "location_confidence",
        F.lit("unresolved").alias("normalization_method"), none("string").alias("ambiguity_reason"),
    )
    return {
        "repository_activity": P.repos(s.discovered).select(*C.CONTRACTS["repository_activity"]), "repository_metadata": metadata,
        "repository_classification": s.classified.withColumns({"manual_label": none("string"), "manual_notes": none("string"), "classification_score": F.col("classification_score") * 3}),
        "contributor_activity": T.with_subdomains(P.contributors(s.contributors)).select(*C.CONTRACTS["contributor_activity"]), "user_profile": profiles, "normalized_location": located,
        "contributor_score": s.contributor_scores.select(*C.CONTRACTS["contributor_score"]).drop("city"), "geographic_ranking": _rankings(s).drop("org_concentration_share"),
    }


#: Columns that fail, and how often.
_broken = {
    "repository_activity": {"issues_opened": _count("bad_repos", "issues_opened < 0"), "automation_event_share": _count("bad_repos", "automation_event_share > 1")},
    "repository_metadata": {"fork_count": _count("repo_meta", "release_count % 8 = 1 AND release_count > 0"), "graphql_fetched_at": _count("repo_meta", "release_count % 8 <= 2"), "is_disabled": _count("repo_meta", "release_count % 8 = 3")},
    "repository_classification": {"classification_score": _count("classified", "classification_score * 3 > 100")}, "contributor_activity": {"reviews_submitted": _count("bad_contributors", "reviews_submitted < 0")},
    "user_profile": {"followers_count": _count("customer", "c_nationkey < 2"), "fetch_status": _count("customer", "length('c' || c_custkey) = 3")},
    "normalized_location": {"latitude": _count("actor_geo", "length(actor_login) * 40 - 60 > 90"), "location_level": _count("actor_geo", "location_level = 'unresolved'")}, "contributor_score": {"city": "SELECT count(*) AS n FROM contributor_scores"},
    "geographic_ranking": {"country_code": _count("bad_rankings", "country_code IS NULL"), "expert_supply_score": _count("bad_rankings", "expert_supply_score < 0"), "opportunity_score": _count("bad_rankings", "opportunity_score > 100"), "org_concentration_flag": "SELECT count(*) AS n FROM bad_rankings"},
}
_contract_row = lambda t, c, body: f"SELECT '{t}' AS table_name, '{c}' AS column_name, n AS failing_rows, CASE WHEN n = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({body})"
add("check_schema_contract", lambda s: quality.check_contracts(_contract_tables(s)),
    " UNION ALL ".join(_contract_row(t, c, _broken[t].get(c, "SELECT CAST(0 AS BIGINT) AS n")) for t, contract in C.CONTRACTS.items() for c in [*contract, *(x for x in _broken[t] if x not in contract)]))

# 2.1 and 2.11 published files


def _pages(s: Stages) -> DataFrame:
    """(geo_level, file, payload) of all countries and cities."""
    countries = publish.country_detail(s.rankings, s.countries, publish.subdomain_mix(K.counts(s)), discovery.geo_monthly_trend(s.grid, A.actor_country(s.spark, s.sf_dir)))
    pages = {"country": countries, "city": publish.city_detail(s.rankings, s.countries)}
    country, city = (df.select(F.lit(level).alias("geo_level"), "file", "payload") for level, df in pages.items())
    return country.unionByName(city)


_fields = "name string, rank long, opportunityScore double, confidenceScore double, recommendationTier string, qualifiedRepoCount long"
_page_sql = f"""SELECT geo_level, replace(replace(lower(geo_id), '/', '-'), ' ', '-') AS file, {K._named} AS name, rank, opportunity_score AS "opportunityScore", confidence_score AS "confidenceScore", recommendation_tier AS "recommendationTier", qualified_repo_count AS "qualifiedRepoCount"
  FROM rankings LEFT JOIN country_names USING (country_code)"""
_parsed = lambda files: files.select("geo_level", "file", F.from_json("text", _fields).alias("x")).select("geo_level", "file", "x.*")
add("publish_json", lambda s: _parsed(T.publish_json(_pages(s), fresh(s, "site"), quality.privacy_scan)), _page_sql, '"opportunityScore" "confidenceScore"')


def _stopped(s: Stages) -> DataFrame:
    """The files that are still published after a set with an address in every city's page was stopped, and the lines that stopped it."""
    path = fresh(s, "site")
    T.publish_json(_pages(s), path, quality.privacy_scan)
    bad = _pages(s).withColumn("payload", F.when(F.col("geo_level") == "city", F.replace("payload", F.lit('"name":"'), F.lit('"name":"ask me@example.org '))).otherwise(F.col("payload")))
    try:
        T.publish_json(bad, path, quality.privacy_scan)
        blocked = 0
    except snapshots.PrivateData as found:
        blocked = found.violations
    return _parsed(snapshots.read_files(s.spark, path)).select("geo_level", "file", "name", "rank", F.lit(blocked).cast("long").alias("blocked"))


add("privacy_gate", _stopped, f"SELECT geo_level, file, name, rank, (SELECT count(*) FROM rankings WHERE geo_level = 'city') AS blocked FROM ({_page_sql})")
