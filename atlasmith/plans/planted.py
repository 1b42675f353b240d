"""Stage tables with bad rows planted in them, so that every check has something to find; and the same as DuckDB views.

Which rows are bad follows from numbers in the rows' own keys, so their count grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasmith.plans import adapters as A
from atlasmith.plans import sql as Q


def _number(column: str, modulus: int) -> Column:
    """The first number in a name, modulo another."""
    return F.regexp_extract(column, r"([0-9]+)$", 1).cast("long") % modulus if column == "repo_name" else F.regexp_extract(column, "([0-9]+)", 1).cast("long") % modulus


def _when(k: Column, values: dict[str, tuple[int, Column]]) -> dict[str, Column]:
    return {c: F.when(k == i, bad).otherwise(F.col(c)) for c, (i, bad) in values.items()}


def repos(discovered: DataFrame) -> DataFrame:
    k = _number("repo_name", 11)
    bad = discovered.withColumns(_when(k, {
        "first_seen": (1, F.date_sub(F.lit(A.WINDOW[0]), 1)), "issues_opened": (2, F.lit(-1)), "automation_event_share": (3, F.lit(1.5)), "merged_pull_requests": (4, F.col("pull_requests_closed") + 1),
        "meaningful_events": (5, F.col("meaningful_events") + 1), "exclusion_reason": (6, F.when(F.col("discovery_status") == "accepted", "planted")),
    }))
    return bad.unionByName(bad.where(k == 7))


def contributors(activity: DataFrame) -> DataFrame:
    k = _number("actor_login", 53)
    bad = activity.withColumns(_when(k, {"reviews_submitted": (1, F.lit(-1)), "repo_name": (2, F.concat(F.lit("nowhere/"), "repo_name"))}))
    return bad.unionByName(bad.where(k == 3))


def grid(rows: DataFrame) -> DataFrame:
    return rows.unionByName(rows.where(_number("actor_login", 97) == 5))


def repo_scores(scores: DataFrame) -> DataFrame:
    return scores.withColumns(_when(_number("repo_name", 11), {"recent_activity_score": (1, F.lit(101.0)), "repository_quality_score": (2, F.col("repository_quality_score") + 1)}))


def rankings(ranked: DataFrame) -> DataFrame:
    k = F.col("rank") % 7
    return ranked.withColumns({
        "country_code": F.when(k == 1, None).otherwise(F.col("country_code")), "geo_id": F.when(k == 2, F.concat(F.lit("x"), "geo_id")).otherwise(F.col("geo_id")),
        "recommendation_tier": F.when(k == 3, "priority").when(k == 4, "monitor").otherwise(F.col("recommendation_tier")), "qualified_repo_count": F.when(k == 4, 0).otherwise(F.col("qualified_repo_count")),
        "opportunity_score": F.when(k == 3, 10.0).when(k == 6, 101.0).otherwise(F.col("opportunity_score")), "expert_supply_score": F.when(k == 5, -1.0).otherwise(F.col("expert_supply_score")),
        "rank": F.when(k == 0, F.col("rank") + 100_000).otherwise(F.col("rank")),
    })


def classified(classification: DataFrame) -> DataFrame:
    none = F.array().cast("array<string>")
    k = _number("repo_name", 9)
    return classification.withColumns(_when(k, {c: (1, none) for c in ("evidence_topics", "evidence_terms", "evidence_files")}))


def events(rows: DataFrame) -> DataFrame:
    return rows.unionByName(rows.where("event_id % 50 = 3"))


_repo, _actor = r"CAST(regexp_extract(repo_name, '([0-9]+)$', 1) AS BIGINT)", "CAST(regexp_extract(actor_login, '([0-9]+)', 1) AS BIGINT)"
_case = lambda column, *pairs: "CASE " + " ".join(f"WHEN k = {i} THEN {bad}" for i, bad in pairs) + f" ELSE {column} END AS {column}"
_twice = lambda view, k: f"SELECT * FROM {view} UNION ALL SELECT * FROM {view} WHERE k = {k}"
Q.VIEWS |= {
    "bad_repos_once": f"""SELECT * REPLACE ({', '.join((_case('first_seen', (1, f'{Q.START} - 1')), _case('issues_opened', (2, '-1')), _case('automation_event_share', (3, '1.5')), _case('merged_pull_requests', (4, 'pull_requests_closed + 1')),
      _case('meaningful_events', (5, 'meaningful_events + 1')), _case('exclusion_reason', (6, "CASE WHEN discovery_status = 'accepted' THEN 'planted' END"))))}) FROM (SELECT *, {_repo} % 11 AS k FROM discovery)""",
    "bad_repos": _twice("bad_repos_once", 7),
    "bad_contributors_once": f"SELECT * REPLACE ({_case('reviews_submitted', (1, '-1'))}, {_case('repo_name', (2, chr(39) + 'nowhere/' + chr(39) + ' || repo_name'))}) FROM (SELECT *, {_actor} % 53 AS k FROM contributor)",
    "bad_contributors": _twice("bad_contributors_once", 3),
    "bad_grid_once": f"SELECT *, {_actor} % 97 AS k FROM grid",
    "bad_grid": _twice("bad_grid_once", 5),
    "bad_repo_scores": f"SELECT * REPLACE ({_case('recent_activity_score', (1, '101'))}, {_case('repository_quality_score', (2, 'repository_quality_score + 1'))}) FROM (SELECT *, {_repo} % 11 AS k FROM repo_scores)",
    "bad_rankings": f"""SELECT * REPLACE ({', '.join((_case('country_code', (1, 'NULL')), _case('geo_id', (2, "'x' || geo_id")), _case('recommendation_tier', (3, "'priority'"), (4, "'monitor'")), _case('qualified_repo_count', (4, '0')),
      _case('opportunity_score', (3, '10'), (6, '101')), _case('expert_supply_score', (5, '-1')), _case('rank', (0, 'rank + 100000'))))}) FROM (SELECT *, rank % 7 AS k FROM rankings)""",
    "bad_classified": f"SELECT * REPLACE ({_case('n_evidence', (1, '0'))}) FROM (SELECT *, {_repo} % 9 AS k FROM classified)",
    "bad_events": "SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 50 = 3",
}
