"""All numbers and word lists of the analytics part (fixed values), checked on import."""

from __future__ import annotations

EVENT_TYPES = ("PushEvent", "PullRequestEvent", "PullRequestReviewEvent", "IssuesEvent", "IssueCommentEvent", "ReleaseEvent")

EVENT_WEIGHTS = {
    "merged_pull_requests": 5, "reviews_submitted": 4, "pull_requests_opened": 3, "releases": 3,
    "push_events": 2, "issues_opened": 1, "issue_comments": 1,
}

#: (kind, pattern) in order of precedence; the first match labels a login.
BOT_PATTERNS = (
    ("suffix", "[bot]"),
    *(("exact", x) for x in (
        "dependabot", "dependabot-preview", "renovate", "renovate-bot", "github-actions", "codecov", "codecov-io", "snyk-bot",
        "greenkeeper", "semantic-release-bot", "release-please", "mergify", "imgbot", "allcontributors", "pre-commit-ci",
        "sonarcloud", "netlify", "vercel-bot", "stale", "web-flow", "copilot",
    )),
    *(("substring", x) for x in (
        "dependabot", "renovate", "github-actions", "-automation", "automation-", "release-bot", "ci-bot", "build-bot",
        "deploy-bot", "jenkins-x", "travis-ci", "circleci-", "azure-pipelines", "buildkite-agent",
    )),
    *(("regex", x) for x in (r".*\[bot\]$", r"^(?:.*[-_])?bot(?:[-_].*)?$", r"^(?:svc|service)[-_].*$", r"^.*[-_](?:releaser|publisher|deployer)$")),
)

MINIMUMS = {"unique_human_contributors": 5, "meaningful_events": 20, "pull_requests_or_reviews": 3, "active_months": 2}
SUMMARY_MIN_HUMANS, CANDIDATE_MIN_HUMANS, CANDIDATE_MIN_EVENTS = 2, 1, 1

EXCLUSION_FLAGS = frozenset({"fork", "archived", "disabled", "license", "single_actor", "awesome_list", "tutorial", "interview_prep", "dotfiles", "student_assignment", "documentation_only"})
DOMINANCE = 0.90

#: Licences that count as recognised, by SPDX id.
LICENSES = (
    "0BSD", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause",
    "BSD-3-Clause-Clear", "BSL-1.0", "CC0-1.0", "EPL-1.0", "EPL-2.0", "EUPL-1.2", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later",
    "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0",
    "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0", "MulanPSL-2.0", "PostgreSQL", "Unlicense", "Zlib",
)

#: Patterns that exclude a repository by its lower-cased short name, in order.
NAME_EXCLUSIONS = (
    ("awesome_list", r"^awesome([-_].+)?$|[-_]awesome$"),
    ("tutorial", r"(^|[-_])tutorials?($|[-_])|^learn(ing)?[-_]"),
    ("interview_prep", r"interview|leetcode"),
    ("dotfiles", r"(^|[-_.])dotfiles?($|[-_])"),
    ("student_assignment", r"^(?!(?:cve|rfc|iso|ieee|ecma|es|sha|aes|utf)[-_]?\d)[a-z]{2,5}[-_]?\d{3,4}(?:$|[-_](?!\d))"),
    ("documentation_only", r"^(docs?|documentation|handbook|wiki)$"),
)
#: The same by the lower-cased description.
DESCRIPTION_EXCLUSIONS = (
    ("awesome_list", r"\b(awesome list|curated list)\b"),
    ("tutorial", r"\b(tutorials?|for beginners|step[ -]by[ -]step guide|crash course)\b"),
    ("interview_prep", r"\binterview (questions?|prep(aration)?)\b|\bleetcode\b"),
    ("dotfiles", r"\bdotfiles\b"),
    ("student_assignment", r"\b(homework|assignments?|coursework|course (project|work|assignment)|university (course|project|assignment)|school project|capstone project|semester)\b"),
    ("documentation_only", r"\b(documentation only|docs only)\b"),
)

CLASSIFICATION = {"topic": 3.0, "term": 1.0, "name": 1.5, "file": 1.0, "language": 1.0, "negative": 2.0, "accept": 4.0, "borderline": 2.0, "kinds": 2}

WINSOR = 0.99
REPOSITORY = {"recent_activity": 0.30, "contributor_diversity": 0.25, "collaboration_quality": 0.20, "technical_relevance": 0.15, "repository_maturity": 0.10}
REPOSITORY_SIGNALS = {
    "recent_activity": {"active_months": 0.25, "active_days": 0.20, "recency": 0.20, "releases": 0.10, "weighted_activity": 0.25},
    "contributor_diversity": {"unique_contributors": 0.50, "low_concentration": 0.30, "recurring_activity": 0.20},
    "collaboration_quality": {"merged_pull_requests": 0.35, "reviews": 0.30, "review_to_pr_ratio": 0.20, "issue_participation": 0.15},
    "technical_relevance": {"classification_score": 0.60, "evidence_breadth": 0.25, "negative_evidence_absence": 0.15},
    "repository_maturity": {"recognized_license": 0.30, "releases": 0.25, "ci_signal": 0.15, "tests_signal": 0.15, "governance_docs": 0.15},
}
RECURRING_MONTHS, REVIEW_RATIO_FULL, NEGATIVE_FULL = 2, 1.0, 3

CONTRIBUTOR = {"domain_activity": 0.35, "contribution_quality": 0.25, "repository_quality_exposure": 0.20, "continuity": 0.10, "collaboration": 0.10}
CONTRIBUTOR_SIGNALS = {
    "domain_activity": {"event_points": 0.50, "qualified_repo_count": 0.25, "subdomain_breadth": 0.25},
    "continuity": {"active_months": 0.40, "recency": 0.30, "activity_span": 0.30},
    "collaboration": {"reviews": 0.40, "pull_request_participation": 0.30, "repo_org_breadth": 0.30},
}
REPO_SHARE_CAP, PUSH_CAP, MIN_ACTIVE_DAYS = 0.40, 100, 2

OPPORTUNITY = {"expert_supply": 0.35, "expert_quality": 0.30, "collaboration_depth": 0.15, "momentum": 0.10, "ecosystem_breadth": 0.10}
CONFIDENCE = {"located_profile_coverage": 0.35, "location_certainty": 0.25, "sample_size_adequacy": 0.20, "repository_diversity": 0.10, "organization_diversity": 0.10}
GEO_SIGNALS = {
    "expert_quality": {"weighted_median": 0.70, "top_quartile_share": 0.30},
    "collaboration_depth": {"multi_repo_share": 0.40, "review_participation": 0.30, "recurring_share": 0.30},
    "ecosystem_breadth": {"qualified_repos": 0.30, "organizations": 0.25, "subdomain_breadth": 0.20, "low_concentration": 0.25},
}
SUPPLY_SCORE_CAP, SUPPLY_REPO_CAP, TOP_QUARTILE, SATURATION, TOP_SUBDOMAINS = 85.0, 0.40, 0.75, 2.0, 5
MOMENTUM = {"up": 75.0, "flat": 50.0, "down": 25.0}
MIN_SAMPLES = {"country": (30, 10, 5), "city": (25, 8, 4)}
TIERS = {"priority": (75, 70), "promising": (60, 60), "insufficient_below": 45}
ORG_SHARE_FLAG = 0.20

#: Text that names no place (compared after cleaning, case-folded).
PLACEHOLDERS = (
    "earth", "planet earth", "mother earth", "internet", "the internet", "online", "remote", "worldwide", "world", "global", "everywhere",
    "somewhere", "nowhere", "localhost", "127.0.0.1", "the cloud", "cloud", "cyberspace", "metaverse", "the moon", "moon", "mars", "milky way",
    "universe", "the universe", "home", "my house", "behind you", "unknown", "n/a", "none", "null", "undefined",
)
#: Why a location is unsure or unusable.
REASONS = {
    "same_name": "%d same-name cities in %s; largest chosen", "also_state": "country name is also a US state name", "no_city_in_country": "city segment not in gazetteer", "no_city_in_state": "state recognized; city not in gazetteer",
    "no_city_in_region": "region recognized; city not in gazetteer", "region_only": "broad region only", "ambiguous": "ambiguous city (%d candidates); largest chosen", "symbols": "emoji or symbols only", "joke": "virtual or joke location",
    "conflict": "multiple conflicting locations", "unresolved": "unresolved text",
}
DOMINANT_POPULATION, DOMINANT_RATIO = 100_000, 5

#: What published text must not hold.
PRIVACY = (
    ("actor_login field", r"\bactor_login\b"),
    ("user_login field", r"\buser_login\b"),
    ("raw_location field", r"\braw_location\b"),
    ("github profile URL", r"https?://(?:www\.)?github\.com/[A-Za-z0-9](?:[A-Za-z0-9-]*)/?(?![\w/-])"),
    ("email address", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"),
    ("API token", r"\b(?:gh[pousr]_[A-Za-z0-9]{20,}|github_pat_[A-Za-z0-9_]{20,})\b"),
)
EXCERPT = 120

#: Kinds of columns in contracts: types, bounds and values.
KINDS = {
    "text": {"types": ("string",)}, "texts": {"types": ("array<string>",)}, "flag": {"types": ("boolean",)}, "date": {"types": ("date",)}, "time": {"types": ("timestamp", "timestamp_ntz")},
    "count": {"types": ("int", "bigint"), "min": 0}, "share": {"types": ("double",), "min": 0, "max": 1}, "score": {"types": ("double",), "min": 0, "max": 100}, "points": {"types": ("double",), "min": 0},
    "latitude": {"types": ("double",), "min": -90, "max": 90}, "longitude": {"types": ("double",), "min": -180, "max": 180},
    "classification": {"types": ("string",), "values": ("accepted", "rejected", "borderline")}, "account": {"types": ("string",), "values": ("user", "bot", "organization", "unknown")},
    "fetched": {"types": ("string",), "values": ("success", "not_found", "rate_limited", "error")}, "place": {"types": ("string",), "values": ("city", "country", "region", "unknown")},
    "certainty": {"types": ("string",), "values": ("high", "medium", "low", "unusable")}, "geo": {"types": ("string",), "values": ("country", "city")},
    "method": {"types": ("string",), "values": ("exact_alias", "parsed_country", "unique_city", "city_country_pair", "manual_override", "unresolved")},
    "tier": {"types": ("string",), "values": ("priority", "promising", "monitor", "insufficient_data")},
}


def _contract(**columns: str) -> dict[str, str]:
    """{column: kind} of {kind: columns}; may_be_ starts kinds that may be null."""
    return {c: kind.removeprefix("may_be_") + "?" * kind.startswith("may_be_") for kind, names in columns.items() for c in names.split()}


#: Columns and kinds of the eight stage tables.
CONTRACTS = {
    "repository_activity": _contract(
        text="repo_name owner_login repo_short_name discovery_status", may_be_text="exclusion_reason", points="weighted_activity_score", date="first_seen last_seen", share="automation_event_share single_actor_event_share",
        count="unique_human_contributors active_days active_months push_events push_commit_count pull_requests_opened pull_requests_closed merged_pull_requests reviews_submitted issues_opened issue_comments releases",
    ),
    "repository_metadata": _contract(
        text="repo_name", may_be_text="description primary_language license_spdx_id", flag="is_fork is_archived is_disabled", texts="topics", count="stargazer_count fork_count release_count issue_count pull_request_count",
        may_be_time="pushed_at updated_at", may_be_flag="has_readme has_contributing has_code_of_conduct has_ci has_tests_signal", time="graphql_fetched_at",
    ),
    "repository_classification": _contract(
        text="repo_name domain_id", texts="subdomains evidence_topics evidence_terms evidence_files negative_evidence", score="classification_score", classification="classification_status", may_be_text="manual_label manual_notes",
    ),
    "contributor_activity": _contract(
        text="actor_login repo_name domain_id", texts="subdomains", date="first_seen last_seen", points="raw_contribution_points",
        count="push_events pull_requests_opened merged_pull_requests_authored reviews_submitted issues_opened issue_comments active_days active_months",
    ),
    "user_profile": _contract(text="actor_login", account="account_type", may_be_text="public_location_raw", may_be_time="created_at", may_be_count="followers_count", time="profile_fetched_at", fetched="fetch_status"),
    "normalized_location": _contract(
        text="actor_login", may_be_text="raw_location normalized_country_code normalized_country_name normalized_city ambiguity_reason", may_be_latitude="latitude", may_be_longitude="longitude", place="location_level",
        certainty="location_confidence", method="normalization_method",
    ),
    "contributor_score": _contract(
        text="actor_login domain_id location_confidence", score="expert_score domain_activity_score contribution_quality_score repository_quality_exposure_score continuity_score collaboration_score",
        count="qualified_repo_count active_months", may_be_text="country_code city",
    ),
    "geographic_ranking": _contract(
        geo="geo_level", text="geo_id country_code domain_id", may_be_text="city", points="weighted_expert_count", texts="top_subdomains", tier="recommendation_tier",
        score="opportunity_score confidence_score expert_supply_score expert_quality_score collaboration_depth_score momentum_score ecosystem_breadth_score",
        count="observable_expert_count qualified_repo_count organization_count rank", share="multi_repo_expert_share located_profile_coverage high_confidence_location_share",
    ),
}

for _weights in (REPOSITORY, *REPOSITORY_SIGNALS.values(), CONTRIBUTOR, *CONTRIBUTOR_SIGNALS.values(), OPPORTUNITY, CONFIDENCE, *GEO_SIGNALS.values()):
    if abs(sum(_weights.values()) - 1) > 1e-9:
        raise ValueError(f"weights don't sum to 1: {_weights}")
