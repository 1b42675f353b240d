"""From events to the month grid, the activity funnel and contributor rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasmith import settings as C
from atlasmith.functions import expressions as X

COUNTERS = ("push_events", "push_commit_count", "prs_opened", "prs_closed", "prs_merged", "reviews_submitted", "issues_opened", "issue_comments", "releases")
COUNTED = ("push_events", "prs_opened", "prs_closed", "reviews_submitted", "issues_opened", "issue_comments", "releases")


def counted_events() -> Column:
    return reduce(lambda a, b: a + b, map(F.col, COUNTED))


def event_grid(events: DataFrame) -> DataFrame:
    """Monthly (repository, actor) rows with counters, exact days and a bot label. Partial sums absorb hot keys."""
    of = lambda kind: F.col("type") == kind
    opened = lambda kind: of(kind) & (F.col("action") == "opened")
    day = F.to_date("created_at")
    # Distinct days of one month are the bits of its day mask: no distinct aggregation is needed.
    mask = F.bit_or(F.expr("shiftleft(1L, day(created_at) - 1)"))
    return (
        X.payload_extract(events).withColumn("month", X.month_of("created_at")).groupBy("month", "repo_name", "actor_login").agg(
            F.count_if(of("PushEvent")).alias("push_events"), F.sum(X.push_commits()).alias("push_commit_count"),
            F.count_if(opened("PullRequestEvent")).alias("prs_opened"), F.count_if(X.pr_closed()).alias("prs_closed"), F.count_if(X.pr_merged()).alias("prs_merged"),
            F.count_if(of("PullRequestReviewEvent")).alias("reviews_submitted"), F.count_if(opened("IssuesEvent")).alias("issues_opened"),
            F.count_if(of("IssueCommentEvent")).alias("issue_comments"), F.count_if(of("ReleaseEvent")).alias("releases"),
            mask.alias("active_day_mask"), F.min(day).alias("first_seen"), F.max(day).alias("last_seen"),
        )
        .withColumn("active_days", F.bit_count("active_day_mask").cast("long"))
        .withColumn("bot_pattern", X.bot_label("actor_login")).withColumn("is_bot", X.is_bot("bot_pattern"))
    )


def bot_audit(grid: DataFrame) -> DataFrame:
    return (
        grid.groupBy(F.when(F.col("is_bot"), "bot").otherwise("human").alias("actor_class"), "bot_pattern")
        .agg(F.count_distinct("actor_login").alias("distinct_actors"), F.count_distinct("repo_name").alias("distinct_repos"),
             F.count("*").alias("grid_rows"), F.sum(counted_events()).alias("total_counted_events"))
    )


def per_actor_rollup(grid: DataFrame) -> DataFrame:
    return grid.groupBy("repo_name", "actor_login").agg(
        F.bool_or("is_bot").alias("is_bot"), *(F.sum(c).alias(c) for c in COUNTERS), F.sum(counted_events()).alias("counted_events"),
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
    )


def month_day_mask(grid: DataFrame) -> DataFrame:
    return grid.where(~F.col("is_bot")).groupBy("repo_name", "month").agg(F.bit_or("active_day_mask").alias("mask"))


def active_days_exact(masks: DataFrame) -> DataFrame:
    return masks.groupBy("repo_name").agg(F.sum(F.bit_count("mask")).cast("long").alias("active_days"), F.count("*").alias("active_months"))


def per_repo_rollup(actors: DataFrame) -> DataFrame:
    human = ~F.col("is_bot")
    return actors.groupBy("repo_name").agg(
        F.count_if(human & (F.col("counted_events") > 0)).alias("unique_human_contributors"),
        *(F.sum(F.when(human, F.col(c)).otherwise(0)).alias(c) for c in COUNTERS),
        F.sum(F.when(human, F.col("counted_events")).otherwise(0)).alias("human_counted_events"),
        F.sum(F.when(~human, F.col("counted_events")).otherwise(0)).alias("bot_counted_events"),
        F.max(F.when(human, F.col("counted_events"))).alias("top_human_actor_events"),
        F.min(F.when(human, F.col("first_seen"))).alias("first_seen"), F.max(F.when(human, F.col("last_seen"))).alias("last_seen"),
    )


def join_repo_days(repos: DataFrame, days: DataFrame) -> DataFrame:
    return repos.join(days, "repo_name", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("active_days", "active_months")})


def repo_activity(grid: DataFrame, terms: list[str]) -> DataFrame:
    """One row per repository within the summary bound."""
    return activity_of(join_repo_days(per_repo_rollup(per_actor_rollup(grid)), active_days_exact(month_day_mask(grid))), terms)


def activity_of(repos: DataFrame, terms: list[str]) -> DataFrame:
    """Sums per repository as the activity table."""
    names = {"prs_merged": "merged_pull_requests", "prs_opened": "pull_requests_opened", "prs_closed": "pull_requests_closed", "human_counted_events": "meaningful_events"}
    whole = F.col("bot_counted_events") + F.col("meaningful_events")
    out = (
        repos.withColumnsRenamed(names)
        .withColumns({
            "owner_login": X.owner_of("repo_name"), "repo_short_name": X.short_name_of("repo_name"),
            "weighted_activity_score": X.weighted_activity({c: c for c in C.EVENT_WEIGHTS}),
            "automation_event_share": X.safe_share("bot_counted_events", whole),
            "single_actor_event_share": X.safe_share("top_human_actor_events", "meaningful_events"),
            "is_taxonomy_candidate": X.taxonomy_name_match("repo_name", terms),
        })
        .drop("bot_counted_events", "top_human_actor_events")
    )
    return out.where(summary_bound())


def summary_bound() -> Column:
    humans = F.col("unique_human_contributors")
    return (humans >= C.SUMMARY_MIN_HUMANS) | (F.col("is_taxonomy_candidate") & (humans >= C.CANDIDATE_MIN_HUMANS))


def repo_discovery(activity: DataFrame, minimums: dict[str, int] = C.MINIMUMS) -> DataFrame:
    """The funnel: status and reason of each repository."""
    judged = activity.withColumn("pull_requests_or_reviews", X.prs_or_reviews()).withColumn("failed_minimums", X.failed_minimums(minimums))
    parts = F.col("failed_minimums"), F.col("is_taxonomy_candidate"), X.candidate_floor()
    return judged.withColumn("discovery_status", X.discovery_status(*parts)).withColumn("exclusion_reason", X.exclusion_reason(*parts)).drop("failed_minimums")


def join_accepted_events(grid: DataFrame, discovery: DataFrame) -> DataFrame:
    return grid.join(discovery.where("discovery_status = 'accepted'").select("repo_name"), "repo_name", "left_semi")


def contributor_rollup(grid: DataFrame, discovery: DataFrame, domain: str) -> DataFrame:
    """One row per human actor and accepted repository with counted events."""
    return contributors_of(grid.where(~F.col("is_bot")), discovery, domain)


def contributors_of(rows: DataFrame, discovery: DataFrame, domain: str) -> DataFrame:
    """Contributor rows from monthly rows of human actors."""
    sums = F.sum
    return (
        join_accepted_events(rows, discovery).groupBy("actor_login", "repo_name").agg(
            sums("push_events").alias("push_events"), sums("prs_opened").alias("pull_requests_opened"), sums("prs_merged").alias("merged_pull_requests_authored"),
            sums("reviews_submitted").alias("reviews_submitted"), sums("issues_opened").alias("issues_opened"), sums("issue_comments").alias("issue_comments"),
            sums("active_days").alias("active_days"), F.count_distinct("month").alias("active_months"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
            sums("releases").alias("releases"), sums(counted_events()).alias("counted"),
        )
        .where("counted > 0").withColumn("domain_id", F.lit(domain))
        .withColumn("raw_contribution_points", X.weighted_activity({c: "merged_pull_requests_authored" if c == "merged_pull_requests" else c for c in C.EVENT_WEIGHTS}))
        .drop("releases", "counted")
    )


# Monthly states: what any set of months is rolled up from, without reading events or the grid again


def monthly_states(grid: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Partial sums that merge over months: human actors per month and repository, and repositories per month."""
    human = ~F.col("is_bot")
    own = lambda c: F.when(human, c)
    actors = grid.where(human).select("month", "repo_name", "actor_login", *COUNTERS, "active_days", "first_seen", "last_seen")
    repos = grid.groupBy("month", "repo_name").agg(
        *(F.sum(own(F.col(c)).otherwise(0)).alias(c) for c in COUNTERS), F.sum(own(counted_events()).otherwise(0)).alias("human_counted_events"), F.sum(F.when(~human, counted_events()).otherwise(0)).alias("bot_counted_events"),
        F.bit_or(own(F.col("active_day_mask"))).alias("mask"), F.min(own(F.col("first_seen"))).alias("first_seen"), F.max(own(F.col("last_seen"))).alias("last_seen"),
    )
    return actors, repos


def roll_activity(actors: DataFrame, repos: DataFrame, months: list[int], terms: list[str]) -> DataFrame:
    """repo_activity() of these months, from states."""
    inside = F.col("month").isin(*months)
    per_actor = actors.where(inside).groupBy("repo_name", "actor_login").agg(F.sum(counted_events()).alias("n"))
    people = per_actor.groupBy("repo_name").agg(F.count_if(F.col("n") > 0).alias("unique_human_contributors"), F.max("n").alias("top_human_actor_events"))
    sums = repos.where(inside).groupBy("repo_name").agg(
        *(F.sum(c).alias(c) for c in (*COUNTERS, "human_counted_events", "bot_counted_events")), F.coalesce(F.sum(F.bit_count("mask")).cast("long"), F.lit(0)).alias("active_days"), F.count("mask").alias("active_months"),
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
    )
    return activity_of(sums.join(people, "repo_name", "left").withColumn("unique_human_contributors", F.coalesce("unique_human_contributors", F.lit(0))), terms)


def roll_contributors(actors: DataFrame, months: list[int], discovery: DataFrame, domain: str) -> DataFrame:
    """contributor_rollup() of these months, from states."""
    return contributors_of(actors.where(F.col("month").isin(*months)), discovery, domain)


def dup_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def repo_worklist(discovery: DataFrame) -> DataFrame:
    return discovery.where("discovery_status = 'accepted'").select("repo_name").distinct().orderBy("repo_name")


def user_worklist(activity: DataFrame, classification: DataFrame | None = None) -> DataFrame:
    if classification is not None:
        activity = activity.join(classification.where("classification_status = 'accepted'").select("repo_name"), "repo_name", "left_semi")
    return activity.select("actor_login").distinct()


def taxonomy_terms(taxonomy: DataFrame) -> DataFrame:
    """Lower-cased positive topics and terms, spaces as dashes and removed, of three letters or more."""
    item = F.lower("item")
    forms = F.array(F.replace(item, F.lit(" "), F.lit("-")), F.replace(item, F.lit(" "), F.lit("")))
    return taxonomy.where(F.col("kind").isin("topic", "term")).select(F.explode(forms).alias("term")).where(F.length("term") >= 3).distinct()


def anti_membership(contributors: DataFrame, discovery: DataFrame) -> DataFrame:
    return contributors.join(discovery.where("discovery_status = 'accepted'").select("repo_name"), "repo_name", "left_anti")


def geo_monthly_trend(grid: DataFrame, actor_country: DataFrame) -> DataFrame:
    """(country, month): events and active contributors. actor_country: (actor_login, country_code), one row per actor."""
    return (
        grid.where(~F.col("is_bot")).join(actor_country, "actor_login").groupBy("country_code", "month")
        .agg(F.sum(counted_events()).alias("events"), F.count_distinct("actor_login").alias("active_contributors"))
    )


def expanded_momentum(grid: DataFrame, actor_country: DataFrame, months: list[int]) -> DataFrame:
    """Per country the direction of active contributors, last half of months against the first, and new actors and repositories."""
    half = len(months) // 2
    before, after = sorted(months)[:half], sorted(months)[-half:]
    human = grid.where(~F.col("is_bot") & F.col("month").isin(*before, *after)).join(actor_country, "actor_login")
    late = F.col("month").isin(*after)
    firsts = lambda key: human.groupBy("country_code", key).agg(F.min("month").alias("m")).groupBy("country_code").agg(F.count_if(F.col("m").isin(*after)).alias(f"new_{key}s"))
    active = human.groupBy("country_code").agg(F.count_distinct(F.when(late, F.col("actor_login"))).alias("recent"), F.count_distinct(F.when(~late, F.col("actor_login"))).alias("earlier"))
    direction = F.when(F.col("recent") > F.col("earlier"), "up").when(F.col("recent") < F.col("earlier"), "down").otherwise("flat")
    return active.withColumn("direction", direction).join(firsts("actor_login"), "country_code").join(firsts("repo_name"), "country_code")
