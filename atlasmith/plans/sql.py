"""The queries' twins in DuckDB SQL: views as common table expressions, and expression builders."""

from __future__ import annotations

import re

from atlasmith import settings as C
from atlasmith.functions.expressions import terms_pattern
from atlasmith.plans import adapters as A

START, END = (f"DATE '{d}'" for d in A.WINDOW)


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def bot_case(login: str) -> str:
    x = f"lower({login})"
    tests = {"suffix": lambda p: f"ends_with({x}, {quoted(p)})", "exact": lambda p: f"{x} = {quoted(p)}", "substring": lambda p: f"contains({x}, {quoted(p)})", "regex": lambda p: f"regexp_matches({x}, {quoted(p)})"}
    return "CASE " + " ".join(f"WHEN {tests[kind](p)} THEN {quoted(f'{kind}:{p}')}" for kind, p in C.BOT_PATTERNS) + " END"


def scale_count(x: str, part: str = "") -> str:
    over, top = f"OVER ({part})", f"quantile_cont(CAST({x} AS DOUBLE), {C.WINSOR}) OVER ({part})"
    lo, hi = f"ln(1 + least(CAST(min({x}) {over} AS DOUBLE), {top}))", f"ln(1 + least(CAST(max({x}) {over} AS DOUBLE), {top}))"
    return f"(CASE WHEN {hi} = {lo} THEN 50.0 ELSE (ln(1 + least(CAST({x} AS DOUBLE), {top})) - {lo}) / ({hi} - {lo}) * 100 END)"


def scale_rank(x: str, part: str = "") -> str:
    return f"((rank() OVER ({part} ORDER BY {x}) + (count(*) OVER ({f'{part},' if part else 'PARTITION BY'} {x}) - 1) / 2.0 - 0.5) / count(*) OVER ({part}) * 100)"


def blend(parts: dict[str, str], weights: dict[str, float]) -> str:
    return "greatest(0.0, least(100.0, " + " + ".join(f"{c} * CAST({weights[n]} AS DOUBLE)" for n, c in parts.items()) + "))"


def weighted(columns: dict[str, str]) -> str:
    return " + ".join(f"CAST({c} AS DOUBLE) * {C.EVENT_WEIGHTS[n]}" for n, c in columns.items())


COUNTERS = ("push_events", "push_commit_count", "prs_opened", "prs_closed", "prs_merged", "reviews_submitted", "issues_opened", "issue_comments", "releases")
COUNTED = "push_events + prs_opened + prs_closed + reviews_submitted + issues_opened + issue_comments + releases"
MATCH = f"regexp_matches(lower(repo_name), {quoted(terms_pattern(A.TERMS))})"
_failed = "nullif(concat_ws(';', " + ", ".join(f"CASE WHEN {n} < {v} THEN '{n}<{v}' END" for n, v in A.MINIMUMS.items()) + "), '')"
_points = weighted({"merged_pull_requests": "merged_pull_requests_authored", "reviews_submitted": "reviews_submitted", "pull_requests_opened": "pull_requests_opened", "push_events": f"least(push_events, {C.PUSH_CAP})", "issues_opened": "issues_opened", "issue_comments": "issue_comments"})
_R, _K, _G = C.REPOSITORY_SIGNALS, C.CONTRIBUTOR_SIGNALS, C.GEO_SIGNALS
_D = "PARTITION BY domain_id"
_P = "PARTITION BY domain_id, geo_level"
_GEO = "domain_id, geo_level, country_code, city"
_same = lambda a, b: " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in _GEO.split(", "))
_min = lambda i: f"CASE WHEN geo_level = 'country' THEN {A.SAMPLES['country'][i]} ELSE {A.SAMPLES['city'][i]} END"
_people = "CASE WHEN geo_level = 'country' THEN observable_expert_count ELSE high_confidence_count END"
_counts = (_people, "qualified_repo_count", "organization_count")
#: Human rows of one repository, when summed per actor.
_human = lambda c: f"coalesce(sum({c}) FILTER (NOT is_bot), 0)"

VIEWS = {
    "act_events": """SELECT 'NATION_' || s_nationkey || '/' || s_name AS repo_name,
  CASE WHEN o_custkey % 37 = 0 THEN 'c' || o_custkey || '[bot]' WHEN o_custkey % 41 = 0 THEN 'build-bot-' || o_custkey ELSE 'c' || o_custkey END AS actor_login,
  CASE l_returnflag || l_linestatus WHEN 'NO' THEN 'PushEvent' WHEN 'RO' THEN 'PullRequestEvent' WHEN 'RF' THEN 'PullRequestReviewEvent' WHEN 'NF' THEN 'IssuesEvent' WHEN 'AF' THEN 'IssueCommentEvent' WHEN 'AO' THEN 'ReleaseEvent' END AS type,
  l_shipdate AS created_at, CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'O' THEN 'opened' ELSE 'merged' END AS action, CAST(l_quantity AS INTEGER) AS size, l_linenumber % 2 = 0 AS flag, l_linenumber % 3 = 0 AS is_old
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey""",
    "grid": f"""SELECT *, bot_pattern IS NOT NULL AS is_bot FROM (SELECT CAST(year(created_at) * 100 + month(created_at) AS INTEGER) AS month, repo_name, actor_login,
  count(*) FILTER (type = 'PushEvent') AS push_events, CAST(coalesce(sum(size) FILTER (type = 'PushEvent'), 0) AS BIGINT) AS push_commit_count,
  count(*) FILTER (type = 'PullRequestEvent' AND action = 'opened') AS prs_opened, count(*) FILTER (type = 'PullRequestEvent' AND action IN ('closed', 'merged')) AS prs_closed,
  count(*) FILTER (type = 'PullRequestEvent' AND (action = 'merged' OR (action = 'closed' AND flag))) AS prs_merged, count(*) FILTER (type = 'PullRequestReviewEvent') AS reviews_submitted,
  count(*) FILTER (type = 'IssuesEvent' AND action = 'opened') AS issues_opened, count(*) FILTER (type = 'IssueCommentEvent') AS issue_comments, count(*) FILTER (type = 'ReleaseEvent') AS releases,
  bit_or(CAST(1 AS BIGINT) << CAST(day(created_at) - 1 AS INTEGER)) AS active_day_mask, min(CAST(created_at AS DATE)) AS first_seen, max(CAST(created_at AS DATE)) AS last_seen,
  count(DISTINCT CAST(created_at AS DATE)) AS active_days, {bot_case('actor_login')} AS bot_pattern
  FROM act_events WHERE type IS NOT NULL GROUP BY 1, 2, 3)""",
    "per_actor": f"SELECT repo_name, actor_login, bool_or(is_bot) AS is_bot, {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in COUNTERS)}, CAST(sum({COUNTED}) AS BIGINT) AS counted_events, min(first_seen) AS first_seen, max(last_seen) AS last_seen FROM grid GROUP BY 1, 2",
    "masks": "SELECT repo_name, month, bit_or(active_day_mask) AS mask FROM grid WHERE NOT is_bot GROUP BY 1, 2",
    "repo_days": "SELECT repo_name, CAST(sum(bit_count(mask)) AS BIGINT) AS active_days, count(*) AS active_months FROM masks GROUP BY 1",
    "repo_activity": f"""SELECT *, {MATCH} AS is_taxonomy_candidate, coalesce(split_part(repo_name, '/', 1), '') AS owner_login, coalesce(split_part(repo_name, '/', 2), '') AS repo_short_name,
  {weighted({n: n for n in C.EVENT_WEIGHTS})} AS weighted_activity_score,
  coalesce(bots / nullif(bots + meaningful_events, 0), 0) AS automation_event_share, coalesce(top_actor / nullif(meaningful_events, 0), 0) AS single_actor_event_share FROM (
  SELECT p.repo_name, count(*) FILTER (NOT is_bot AND counted_events > 0) AS unique_human_contributors, any_value(coalesce(d.active_days, 0)) AS active_days, any_value(coalesce(d.active_months, 0)) AS active_months,
  {', '.join(f"CAST({_human('p.' + c)} AS BIGINT) AS {n}" for c, n in {'push_events': 'push_events', 'push_commit_count': 'push_commit_count', 'prs_opened': 'pull_requests_opened', 'prs_closed': 'pull_requests_closed', 'prs_merged': 'merged_pull_requests', 'reviews_submitted': 'reviews_submitted', 'issues_opened': 'issues_opened', 'issue_comments': 'issue_comments', 'releases': 'releases', 'counted_events': 'meaningful_events'}.items())},
  coalesce(sum(counted_events) FILTER (is_bot), 0) AS bots, max(counted_events) FILTER (NOT is_bot) AS top_actor, min(first_seen) FILTER (NOT is_bot) AS first_seen, max(last_seen) FILTER (NOT is_bot) AS last_seen
  FROM per_actor p LEFT JOIN repo_days d USING (repo_name) GROUP BY 1)
  WHERE unique_human_contributors >= {C.SUMMARY_MIN_HUMANS} OR ({MATCH} AND unique_human_contributors >= {C.CANDIDATE_MIN_HUMANS})""",
    "discovery": f"""SELECT *, CASE WHEN failed IS NULL THEN 'accepted' WHEN NOT is_taxonomy_candidate THEN 'not_candidate' WHEN NOT is_floor THEN 'below_floor' ELSE 'excluded' END AS discovery_status,
  CASE WHEN failed IS NULL THEN NULL WHEN NOT is_taxonomy_candidate THEN 'no_taxonomy_name_match' WHEN NOT is_floor THEN 'below_candidate_activity_floor' ELSE failed END AS exclusion_reason FROM (
  SELECT *, {_failed} AS failed, is_taxonomy_candidate AND unique_human_contributors >= 1 AND meaningful_events >= 1 AS is_floor FROM (SELECT *, pull_requests_opened + reviews_submitted AS pull_requests_or_reviews FROM repo_activity))""",
    "contributor": f"""SELECT actor_login, repo_name, '{A.DOMAIN}' AS domain_id, push_events, pull_requests_opened, merged_pull_requests_authored, reviews_submitted, issues_opened, issue_comments, active_days, active_months, first_seen, last_seen,
  {weighted({n: 'merged_pull_requests_authored' if n == 'merged_pull_requests' else n for n in C.EVENT_WEIGHTS})} AS raw_contribution_points FROM (
  SELECT actor_login, repo_name, CAST(sum(push_events) AS BIGINT) AS push_events, CAST(sum(prs_opened) AS BIGINT) AS pull_requests_opened, CAST(sum(prs_merged) AS BIGINT) AS merged_pull_requests_authored,
  CAST(sum(reviews_submitted) AS BIGINT) AS reviews_submitted, CAST(sum(issues_opened) AS BIGINT) AS issues_opened, CAST(sum(issue_comments) AS BIGINT) AS issue_comments, CAST(sum(active_days) AS BIGINT) AS active_days,
  count(DISTINCT month) AS active_months, min(first_seen) AS first_seen, max(last_seen) AS last_seen, sum(releases) AS releases, sum({COUNTED}) AS counted
  FROM grid WHERE NOT is_bot AND repo_name IN (SELECT repo_name FROM discovery WHERE discovery_status = 'accepted') GROUP BY 1, 2) WHERE counted > 0""",
    "repo_meta": """SELECT 'NATION_' || s_nationkey || '/' || s_name AS repo_name, p_name AS description, p_size % 17 = 0 AS is_fork, p_size % 19 = 0 AS is_archived, p_brand AS primary_language, lower(p_type) AS topic,
  CAST(p_size AS BIGINT) AS release_count, CASE p_size % 3 WHEN 0 THEN 'MIT' WHEN 1 THEN 'Apache-2.0' END AS license_spdx_id, CASE WHEN p_size % 5 > 0 THEN p_size % 2 = 0 END AS has_ci, p_size % 4 = 0 AS has_tests_signal,
  CASE WHEN p_size % 7 > 0 THEN p_size % 3 = 0 END AS has_contributing FROM supplier JOIN part ON s_suppkey = p_partkey""",
    "classified": f"""SELECT 'NATION_' || s_nationkey || '/' || s_name AS repo_name, '{A.DOMAIN}' AS domain_id, list_sort([lower(p_type), string_split(p_name, ' ')[2]]) AS subdomains, CAST(p_size AS DOUBLE) AS classification_score,
  CASE WHEN p_size % 6 > 0 THEN 'accepted' ELSE 'rejected' END AS classification_status, 1 + CASE WHEN p_size % 2 = 0 THEN len(string_split(p_name, ' ')) ELSE 0 END AS n_evidence, CASE WHEN p_size % 4 = 0 THEN 1 ELSE 0 END AS n_negative
  FROM supplier JOIN part ON s_suppkey = p_partkey""",
    "taxonomy": "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(map(quoted, row)) + ")" for row in A.TAXONOMY) + ") t(domain_id, subdomain_id, kind, item)",
    "actor_geo": """SELECT 'c' || c_custkey AS actor_login, CASE WHEN c_custkey % 4 < 3 THEN 'N' || c_nationkey END AS normalized_country_code, CASE WHEN c_custkey % 4 < 2 THEN c_mktsegment END AS normalized_city,
  CASE WHEN c_custkey % 4 < 2 THEN 'city' WHEN c_custkey % 4 = 2 THEN 'country' ELSE 'unresolved' END AS location_level, CASE WHEN c_custkey % 4 < 2 THEN 'high' WHEN c_custkey % 4 = 2 THEN 'medium' ELSE 'unusable' END AS location_confidence FROM customer""",
    "actor_country": "SELECT actor_login, normalized_country_code AS country_code FROM actor_geo WHERE normalized_country_code IS NOT NULL",
    "country_names": "SELECT 'N' || n_nationkey AS country_code, n_name AS country_name FROM nation",
    "text_lines": "SELECT 'documents/' || doc_id AS file, text FROM documents UNION ALL SELECT 'pages/' || page_id, html FROM pages",
    # scores
    "repo_scores": "SELECT repo_name, recent_activity_score, contributor_diversity_score, collaboration_quality_score, technical_relevance_score, repository_maturity_score, "
    + blend({n: f"{n}_score" for n in C.REPOSITORY}, C.REPOSITORY)
    + " AS repository_quality_score FROM (SELECT repo_name, "
    + ", ".join(
        f"{c} AS {n}_score"
        for n, c in {
            "recent_activity": blend({"active_months": scale_count("active_months"), "active_days": scale_count("active_days"), "recency": scale_rank("last_seen"), "releases": scale_count("releases"), "weighted_activity": scale_count("weighted_activity_score")}, _R["recent_activity"]),
            "contributor_diversity": blend({"unique_contributors": scale_count("unique_human_contributors"), "low_concentration": "(1 - single_actor_event_share) * 100", "recurring_activity": f"(CASE WHEN active_months >= {C.RECURRING_MONTHS} THEN 100.0 ELSE 0.0 END)"}, _R["contributor_diversity"]),
            "collaboration_quality": blend({"merged_pull_requests": scale_count("merged_pull_requests"), "reviews": scale_count("reviews_submitted"), "review_to_pr_ratio": "least(CAST(reviews_submitted AS DOUBLE) / greatest(CAST(pull_requests_opened AS DOUBLE), 1.0), 1.0) * 100", "issue_participation": scale_count("issue_comments")}, _R["collaboration_quality"]),
            "technical_relevance": blend({"classification_score": scale_rank("classification_score"), "evidence_breadth": scale_count("n_evidence"), "negative_evidence_absence": "(1 - least(n_negative / 3.0, 1.0)) * 100"}, _R["technical_relevance"]),
            "repository_maturity": blend({"recognized_license": "(CASE WHEN license_spdx_id IS NOT NULL THEN 100.0 ELSE 0.0 END)", "releases": scale_count("release_count"), "ci_signal": "(CASE WHEN has_ci THEN 100.0 ELSE 0.0 END)", "tests_signal": "(CASE WHEN has_tests_signal THEN 100.0 ELSE 0.0 END)", "governance_docs": "(CASE WHEN has_contributing THEN 100.0 ELSE 0.0 END)"}, _R["repository_maturity"]),
        }.items()
    )
    + " FROM classified JOIN repo_activity USING (repo_name) JOIN repo_meta USING (repo_name) WHERE classification_status = 'accepted')",
    "capped": f"SELECT *, CASE WHEN total > 0 THEN least(points, {C.REPO_SHARE_CAP} * total) ELSE points END AS capped FROM (SELECT *, sum(points) OVER (PARTITION BY domain_id, actor_login) AS total FROM (SELECT *, {_points} AS points FROM contributor WHERE repo_name IN (SELECT repo_name FROM classified WHERE classification_status = 'accepted')))",
    "subdomain_rows": "SELECT repo_name, unnest(subdomains) AS s FROM classified",
    "evidence": f"""SELECT * FROM (SELECT domain_id, actor_login, count(*) AS qualified_repo_count, sum(capped) AS weighted_event_points, CAST(sum(push_events + pull_requests_opened + merged_pull_requests_authored + reviews_submitted + issues_opened + issue_comments) AS BIGINT) AS raw_event_count,
  sum(reviews_submitted) AS reviews_total, sum(pull_requests_opened + merged_pull_requests_authored) AS pr_participation, count(DISTINCT split_part(repo_name, '/', 1)) AS org_count, max(last_seen) AS latest, max(last_seen) - min(first_seen) AS span_days,
  CASE WHEN sum(capped) > 0 THEN sum(capped * repository_quality_score) / sum(capped) ELSE avg(repository_quality_score) END AS exposure,
  greatest(max(active_days), any_value(dates)) AS days, greatest(max(active_months), any_value(date_months)) AS months, any_value(n_subdomains) AS subdomain_count
  FROM capped JOIN repo_scores USING (repo_name)
  JOIN (SELECT domain_id, actor_login, count(DISTINCT d) AS dates, count(DISTINCT date_trunc('month', d)) AS date_months FROM (SELECT domain_id, actor_login, first_seen AS d FROM capped UNION ALL SELECT domain_id, actor_login, last_seen FROM capped) GROUP BY 1, 2) USING (domain_id, actor_login)
  JOIN (SELECT domain_id, actor_login, count(DISTINCT s) AS n_subdomains FROM capped JOIN subdomain_rows USING (repo_name) GROUP BY 1, 2) USING (domain_id, actor_login) GROUP BY 1, 2) WHERE days >= {C.MIN_ACTIVE_DAYS}""",
    "contributor_scores": "SELECT *, " + blend({n: f"{n}_score" for n in C.CONTRIBUTOR}, C.CONTRIBUTOR) + " AS expert_score FROM (SELECT actor_login, domain_id, qualified_repo_count, months AS active_months, raw_event_count, weighted_event_points, "
    + blend({"event_points": scale_count("weighted_event_points", _D), "qualified_repo_count": scale_count("qualified_repo_count", _D), "subdomain_breadth": scale_count("subdomain_count", _D)}, _K["domain_activity"]) + " AS domain_activity_score, "
    + scale_count("weighted_event_points", _D) + " AS contribution_quality_score, exposure AS repository_quality_exposure_score, "
    + blend({"active_months": scale_count("months", _D), "recency": scale_rank("latest", _D), "activity_span": scale_count("span_days", _D)}, _K["continuity"]) + " AS continuity_score, "
    + blend({"reviews": scale_count("reviews_total", _D), "pull_request_participation": scale_count("pr_participation", _D), "repo_org_breadth": scale_count("(qualified_repo_count + org_count)", _D)}, _K["collaboration"]) + " AS collaboration_score FROM evidence)",
    "members": """SELECT s.domain_id, s.actor_login, s.expert_score, s.qualified_repo_count, s.active_months, 'country' AS geo_level, normalized_country_code AS country_code, NULL AS city, location_confidence FROM contributor_scores s JOIN actor_geo USING (actor_login)
  WHERE location_confidence IN ('high', 'medium') AND normalized_country_code IS NOT NULL
  UNION ALL SELECT s.domain_id, s.actor_login, s.expert_score, s.qualified_repo_count, s.active_months, 'city', normalized_country_code, normalized_city, location_confidence FROM contributor_scores s JOIN actor_geo USING (actor_login)
  WHERE location_level = 'city' AND location_confidence = 'high' AND normalized_country_code IS NOT NULL AND normalized_city IS NOT NULL""",
    "supplied": f"""SELECT {', '.join('m.' + c for c in _GEO.split(', '))}, m.actor_login, c.repo_name, c.capped, least(m.expert_score, 85.0) / 100 * c.capped / nullif(sum(c.capped) OVER (PARTITION BY m.domain_id, m.geo_level, m.actor_login), 0) AS given FROM members m JOIN capped c USING (domain_id, actor_login)""",
    "geo_repos": f"SELECT {_GEO}, repo_name, sum(capped) AS points, sum(given) AS given FROM supplied GROUP BY ALL",
    "geo_top": f"SELECT *, row_number() OVER (PARTITION BY {_GEO} ORDER BY p DESC, s) AS r FROM (SELECT {_GEO}, s, sum(points) AS p FROM geo_repos JOIN subdomain_rows USING (repo_name) GROUP BY ALL)",
    "geo_owners": f"SELECT {_GEO}, split_part(repo_name, '/', 1) AS owner, sum(points) AS points FROM geo_repos GROUP BY ALL",
    "geo_members": f"""SELECT {_GEO}, count(*) AS observable_expert_count, count(*) FILTER (location_confidence = 'high') AS high_confidence_count, avg(CASE WHEN qualified_repo_count >= 2 THEN 1.0 ELSE 0.0 END) * 100 AS multi_repo_share,
  avg(CASE WHEN reviews > 0 THEN 1.0 ELSE 0.0 END) * 100 AS review_participation, avg(CASE WHEN active_months >= 2 THEN 1.0 ELSE 0.0 END) * 100 AS recurring_share, count(*) FILTER (is_now) AS latest_active, count(*) FILTER (is_before) AS previous_active,
  sum(least(expert_score, 85.0) / 100) AS weighted_expert_count, avg(CASE WHEN expert_score >= lim THEN 1.0 ELSE 0.0 END) * 100 AS top_quartile_share
  FROM (SELECT *, quantile_cont(expert_score, {C.TOP_QUARTILE}) OVER ({_P}) AS lim FROM members) LEFT JOIN (SELECT domain_id, actor_login, sum(reviews_submitted) AS reviews, bool_or(first_seen <= last_day({END}) AND last_seen >= date_trunc('month', {END})) AS is_now,
  bool_or(first_seen <= last_day({END} - INTERVAL 1 MONTH) AND last_seen >= date_trunc('month', {END} - INTERVAL 1 MONTH)) AS is_before FROM capped GROUP BY 1, 2) USING (domain_id, actor_login) GROUP BY ALL""",
    "geo_median": f"""SELECT {_GEO}, min(expert_score) FILTER (upto * 2 >= total) AS weighted_median FROM (SELECT *, sum(w) OVER (PARTITION BY {_GEO} ORDER BY expert_score) AS upto, sum(w) OVER (PARTITION BY {_GEO}) AS total
  FROM (SELECT {_GEO}, expert_score, sum(CAST(least(expert_score, 85.0) / 100 AS DECIMAL(38,12))) AS w FROM members GROUP BY ALL)) GROUP BY ALL""",
    "geo_evidence": f"""SELECT g.*, w.weighted_median, r.max_repo_share, r.qualified_repo_count, o.max_org_share, o.organization_count, r.n_subdomains AS subdomain_count, g.weighted_expert_count - coalesce(r.given, 0) + coalesce(r.kept, 0) AS capped_supply,
  (SELECT avg(CASE WHEN location_confidence IN ('high', 'medium') AND normalized_country_code IS NOT NULL THEN 1.0 ELSE 0.0 END) FROM contributor_scores LEFT JOIN actor_geo USING (actor_login)) AS coverage
  FROM geo_members g JOIN geo_median w ON {_same('g', 'w')}
  JOIN (SELECT x.domain_id, x.geo_level, x.country_code, x.city, CASE WHEN sum(points) > 0 THEN max(points) / sum(points) ELSE 0 END AS max_repo_share, count(*) AS qualified_repo_count, sum(x.given) AS given, sum(CASE WHEN x.given IS NOT NULL THEN least(x.given, {C.SUPPLY_REPO_CAP} * m.weighted_expert_count) END) AS kept, any_value(s.n) AS n_subdomains
    FROM geo_repos x JOIN geo_members m ON {_same('x', 'm')} JOIN (SELECT {_GEO}, count(DISTINCT s) AS n FROM geo_repos JOIN subdomain_rows USING (repo_name) GROUP BY ALL) s ON {_same('x', 's')} GROUP BY 1, 2, 3, 4) r ON {_same('g', 'r')}
  JOIN (SELECT {_GEO}, CASE WHEN sum(points) > 0 THEN max(points) / sum(points) ELSE 0 END AS max_org_share, count(*) AS organization_count FROM geo_owners GROUP BY ALL) o ON {_same('g', 'o')}""",
    "geo_scaled": "SELECT *, coverage AS located_profile_coverage, " + scale_count("capped_supply", _P) + " AS expert_supply_score, "
    + blend({"weighted_median": "weighted_median", "top_quartile_share": "top_quartile_share"}, _G["expert_quality"]) + " AS expert_quality_score, " + blend({n: n for n in _G["collaboration_depth"]}, _G["collaboration_depth"]) + " AS collaboration_depth_score, "
    + "CAST(CASE WHEN latest_active > previous_active THEN 75 WHEN latest_active < previous_active THEN 25 ELSE 50 END AS DOUBLE) AS momentum_score, "
    + blend({"qualified_repos": scale_count("qualified_repo_count", _P), "organizations": scale_count("organization_count", _P), "subdomain_breadth": scale_count("subdomain_count", _P), "low_concentration": "(1 - max_org_share) * 100"}, _G["ecosystem_breadth"]) + " AS ecosystem_breadth_score, "
    + " AND ".join(f"{c} >= {_min(i)}" for i, c in enumerate(_counts)) + " AS samples_ok, "
    + blend({"located_profile_coverage": "coverage * 100", "location_certainty": "high_confidence_count / observable_expert_count * 100", "sample_size_adequacy": "(" + " + ".join(f"least(({c}) / (({_min(i)}) * {C.SATURATION}), 1.0)" for i, c in enumerate(_counts)) + ") / 3 * 100", "repository_diversity": "(1 - max_repo_share) * 100", "organization_diversity": "(1 - max_org_share) * 100"}, C.CONFIDENCE) + " AS confidence_score FROM geo_evidence",
    "geo_tiered": "SELECT *, CASE WHEN NOT samples_ok OR confidence_score < 45 THEN 'insufficient_data' WHEN opportunity_score >= 75 AND confidence_score >= 70 THEN 'priority' WHEN opportunity_score >= 60 AND confidence_score >= 60 THEN 'promising' ELSE 'monitor' END AS recommendation_tier, CASE WHEN geo_level = 'country' THEN country_code ELSE country_code || '-' || replace(lower(city), ' ', '-') END AS geo_id FROM (SELECT *, " + blend({n: f"{n}_score" for n in C.OPPORTUNITY}, C.OPPORTUNITY) + " AS opportunity_score FROM geo_scaled)",
    "rankings": f"SELECT *, row_number() OVER ({_P} ORDER BY recommendation_tier = 'insufficient_data', opportunity_score DESC, confidence_score DESC, geo_id) AS rank FROM geo_tiered",
    "trend": f"SELECT country_code, month, CAST(sum({COUNTED}) AS BIGINT) AS events, count(DISTINCT actor_login) AS active_contributors FROM grid JOIN actor_country USING (actor_login) WHERE NOT is_bot GROUP BY 1, 2",
    "subdomain_counts": "SELECT s AS subdomain, country_code, count(DISTINCT actor_login) AS experts FROM (SELECT DISTINCT actor_login, repo_name FROM contributor) JOIN (SELECT repo_name, unnest(subdomains) AS s FROM classified WHERE classification_status = 'accepted') USING (repo_name) JOIN (SELECT DISTINCT actor_login, normalized_country_code AS country_code FROM contributor_scores JOIN actor_geo USING (actor_login) WHERE normalized_country_code IS NOT NULL) USING (actor_login) GROUP BY 1, 2",
}


def _scenario(suffix: str, changed: dict[str, str]) -> None:
    """Views of a scenario: those that are changed, and those that read them, under names with the suffix."""
    chain = ["capped", "supplied", "geo_repos", "geo_owners", "geo_members", "geo_evidence", "geo_scaled", "geo_tiered", "rankings"]
    chain = chain[chain.index(next(iter(changed))) :]
    for name in chain:
        VIEWS[f"{name}{suffix}"] = re.sub(rf"\b(FROM|JOIN) ({'|'.join(chain)})\b", rf"\1 \2{suffix}", changed.get(name, VIEWS[name]))


def _weighted(change: float) -> str:
    raised = {k: v * (1 + change) if k == "expert_supply" else v for k, v in C.OPPORTUNITY.items()}
    parts, total = {n: f"{n}_score" for n in C.OPPORTUNITY}, sum(raised.values())
    return VIEWS["geo_tiered"].replace(blend(parts, C.OPPORTUNITY), blend(parts, {k: v / total for k, v in raised.items()}))


#: Scenarios of the sensitivity report and the suffix of their views.
SCENARIOS = {"baseline": "", "supply_plus_20": "_plus", "supply_minus_20": "_minus", "top_1pct_repos_removed": "_top", "largest_org_removed": "_org"}
_scenario("_plus", {"geo_tiered": _weighted(0.2)})
_scenario("_minus", {"geo_tiered": _weighted(-0.2)})
_scenario("_top", {"capped": VIEWS["capped"].replace("FROM contributor WHERE", "FROM contributor WHERE repo_name NOT IN (SELECT repo_name FROM repo_scores WHERE repository_quality_score >= (SELECT quantile_cont(repository_quality_score, 0.99) FROM repo_scores)) AND")})
_scenario("_org", {"capped": VIEWS["capped"].replace("FROM contributor WHERE", "FROM contributor WHERE split_part(repo_name, '/', 1) <> (SELECT split_part(repo_name, '/', 1) AS owner FROM contributor GROUP BY 1 ORDER BY count(*) DESC, owner LIMIT 1) AND")})


#: The last three and the last twelve months of the window, by the suffix of their views.
_all = [y * 100 + m for y in range(A.WINDOW[0].year, A.WINDOW[1].year + 1) for m in range(1, 13) if y * 100 + m <= A.WINDOW[1].year * 100 + A.WINDOW[1].month]
WINDOWS = {"_w3": _all[-3:], "_w12": _all[-12:]}
_rolled = ["per_actor", "masks", "repo_days", "repo_activity", "contributor", "repo_scores", "capped", "evidence", "contributor_scores", "members", "supplied", "geo_repos", "geo_owners", "geo_members", "geo_median", "geo_evidence", "geo_scaled", "geo_tiered", "rankings"]
for _suffix, _months in WINDOWS.items():
    VIEWS[f"grid{_suffix}"] = f"SELECT * FROM grid WHERE month IN ({', '.join(map(str, _months))})"
    for _name in _rolled:
        VIEWS[f"{_name}{_suffix}"] = re.sub(rf"\b(FROM|JOIN) ({'|'.join(['grid', *_rolled])})\b", rf"\1 \2{_suffix}", VIEWS[_name])


def query(select: str) -> str:
    """A select over the views that it needs."""
    needed: set[str] = set()

    def add(text: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                add(VIEWS[name])

    add(select)
    ctes = ",\n".join(f"{name} AS ({body})" for name, body in VIEWS.items() if name in needed)
    if not ctes:
        return select
    return f"WITH {ctes},\n{select.lstrip()[5:]}" if select.lstrip().startswith("WITH ") else f"WITH {ctes}\n{select}"
