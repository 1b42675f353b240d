"""Repository, contributor and geography scores."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atlasmith import settings as C
from atlasmith.functions import expressions as X
from atlasmith.functions import stats as S
from atlasmith.operators import locations as L
from atlasmith.sources import tables as T


# Repositories: one population


def join_score_inputs(classification: DataFrame, activity: DataFrame, metadata: DataFrame) -> DataFrame:
    return classification.where("classification_status = 'accepted'").join(activity, "repo_name").join(metadata, "repo_name")


def repo_signals(inputs: DataFrame, window_end: datetime.date) -> DataFrame:
    """inputs with every signal of the five components, 0-100."""
    df = inputs.withColumns({"s_age": -X.days_since(F.lit(window_end), "last_seen").cast("double"), "s_evidence": X.evidence_count("evidence_topics", "evidence_terms", "evidence_files")})
    return S.scaled(df, [], {
        "x_months": "active_months", "x_days": "active_days", "x_releases": "releases", "x_activity": "weighted_activity_score", "x_humans": "unique_human_contributors",
        "x_merged": "merged_pull_requests", "x_reviews": "reviews_submitted", "x_comments": "issue_comments", "x_evidence": "s_evidence", "x_release_count": "release_count",
    }, {"x_recency": "s_age", "x_class": "classification_score"})


def repo_recent_activity() -> Column:
    return X.weighted_blend({"active_months": "x_months", "active_days": "x_days", "recency": "x_recency", "releases": "x_releases", "weighted_activity": "x_activity"}, C.REPOSITORY_SIGNALS["recent_activity"])


def repo_diversity() -> Column:
    low = (1 - F.col("single_actor_event_share")) * 100
    recurring = F.when(F.col("active_months") >= C.RECURRING_MONTHS, 100.0).otherwise(0.0)
    return X.weighted_blend({"unique_contributors": "x_humans", "low_concentration": low, "recurring_activity": recurring}, C.REPOSITORY_SIGNALS["contributor_diversity"])


def repo_collaboration() -> Column:
    ratio = X.review_ratio("reviews_submitted", "pull_requests_opened")
    return X.weighted_blend({"merged_pull_requests": "x_merged", "reviews": "x_reviews", "review_to_pr_ratio": ratio, "issue_participation": "x_comments"}, C.REPOSITORY_SIGNALS["collaboration_quality"])


def repo_relevance() -> Column:
    absent = (1 - F.least(F.size("negative_evidence") / C.NEGATIVE_FULL, F.lit(1.0))) * 100
    return X.weighted_blend({"classification_score": "x_class", "evidence_breadth": "x_evidence", "negative_evidence_absence": absent}, C.REPOSITORY_SIGNALS["technical_relevance"])


def repo_maturity() -> Column:
    licensed = F.when(F.col("license_spdx_id").isNotNull(), 100.0).otherwise(0.0)
    governed = F.greatest(X.null_or_positive("has_contributing"), X.null_or_positive("has_code_of_conduct"))
    parts = {"recognized_license": licensed, "releases": "x_release_count", "ci_signal": X.null_or_positive("has_ci"), "tests_signal": X.null_or_positive("has_tests_signal"), "governance_docs": governed}
    return X.weighted_blend(parts, C.REPOSITORY_SIGNALS["repository_maturity"])


def score_repositories(activity: DataFrame, metadata: DataFrame, classification: DataFrame, window_end: datetime.date) -> DataFrame:
    return finish_repositories(repo_signals(join_score_inputs(classification, activity, metadata), window_end))


def finish_repositories(signals: DataFrame) -> DataFrame:
    """Signals (staged, in long plans) to the table of scores."""
    parts = {
        "recent_activity": repo_recent_activity(), "contributor_diversity": repo_diversity(), "collaboration_quality": repo_collaboration(),
        "technical_relevance": repo_relevance(), "repository_maturity": repo_maturity(),
    }
    scored = signals.select("repo_name", *(c.alias(f"{n}_score") for n, c in parts.items()))
    return scored.withColumn("repository_quality_score", X.weighted_blend({n: f"{n}_score" for n in parts}, C.REPOSITORY))


# Contributors: a population per domain


def event_points(cap: int = C.PUSH_CAP) -> Column:
    """Weighted points of a contributor row; pushes are capped, releases aren't counted."""
    columns = {"merged_pull_requests": "merged_pull_requests_authored", "reviews_submitted": "reviews_submitted", "pull_requests_opened": "pull_requests_opened",
               "push_events": F.least("push_events", F.lit(cap)), "issues_opened": "issues_opened", "issue_comments": "issue_comments"}
    return X.weighted_activity(columns)


def capped_points(activity: DataFrame, share: float = C.REPO_SHARE_CAP) -> DataFrame:
    """activity with points and capped: a repository counts for a share of the actor's uncapped total at most."""
    total = F.sum("points").over(Window.partitionBy("domain_id", "actor_login"))
    return activity.withColumn("points", event_points()).withColumn("capped", F.when(total > 0, F.least("points", share * total)).otherwise(F.col("points")))


def semi_accepted_activity(activity: DataFrame, classification: DataFrame) -> DataFrame:
    return activity.join(classification.where("classification_status = 'accepted'").select("repo_name"), "repo_name", "left_semi")


def semi_qualified_activity(activity: DataFrame, classification: DataFrame, scores: DataFrame) -> DataFrame:
    return semi_accepted_activity(activity, classification).join(scores.select("repo_name"), "repo_name", "left_semi")


def join_quality(activity: DataFrame, scores: DataFrame) -> DataFrame:
    return activity.join(scores.select("repo_name", F.col("repository_quality_score").alias("quality")), "repo_name")


CONTRIBUTOR_KEY = ["domain_id", "actor_login"]


def evidence_rows(activity: DataFrame, classification: DataFrame, scores: DataFrame) -> DataFrame:
    """Rows of qualified repositories with points, capped points and the repository's quality."""
    return capped_points(join_quality(semi_qualified_activity(activity, classification, scores), scores))


def active_time_bounds(rows: DataFrame) -> DataFrame:
    """Lower bounds of an actor's active days and months: the most in one repository, or the dates known from all."""
    seen = F.explode(F.array("first_seen", "last_seen"))
    dates = rows.select(*CONTRIBUTOR_KEY, seen.alias("d")).groupBy(*CONTRIBUTOR_KEY).agg(F.count_distinct("d").alias("dates"), F.count_distinct(F.trunc("d", "MM")).alias("date_months"))
    most = rows.groupBy(*CONTRIBUTOR_KEY).agg(F.max("active_days").alias("max_days"), F.max("active_months").alias("max_months"))
    return most.join(dates, CONTRIBUTOR_KEY).select(*CONTRIBUTOR_KEY, F.greatest("max_days", "dates").alias("days"), F.greatest("max_months", "date_months").alias("months"))


def quality_exposure() -> Column:
    """An aggregate of evidence rows: their quality by capped points."""
    return F.when(F.sum("capped") > 0, F.try_divide(F.sum(F.col("capped") * F.col("quality")), F.sum("capped"))).otherwise(F.avg("quality"))


def contributor_evidence(activity: DataFrame, classification: DataFrame, scores: DataFrame) -> DataFrame:
    """One row per (domain, actor) with enough active days."""
    rows, key = T.stage(evidence_rows(activity, classification, scores), "evidence-rows"), CONTRIBUTOR_KEY
    subdomains = rows.select(*key, "repo_name").join(classification.select("repo_name", F.explode("subdomains").alias("s")), "repo_name").groupBy(*key).agg(F.count_distinct("s").alias("subdomain_count"))
    raw = sum((F.col(c) for c in ("pull_requests_opened", "merged_pull_requests_authored", "reviews_submitted", "issues_opened", "issue_comments")), F.col("push_events"))
    folded = rows.groupBy(*key).agg(
        F.count("*").alias("qualified_repo_count"), F.sum("capped").alias("weighted_event_points"), F.sum(raw).alias("raw_event_count"),
        F.sum("reviews_submitted").alias("reviews_total"), F.sum(F.col("pull_requests_opened") + F.col("merged_pull_requests_authored")).alias("pr_participation"),
        F.count_distinct(X.owner_of("repo_name")).alias("org_count"),
        F.max("last_seen").alias("latest"), F.datediff(F.max("last_seen"), F.min("first_seen")).alias("span_days"), quality_exposure().alias("exposure"),
    )
    whole = folded.join(active_time_bounds(rows), key).join(subdomains, key, "left").withColumn("subdomain_count", F.coalesce("subdomain_count", F.lit(0)))
    return whole.where(F.col("days") >= C.MIN_ACTIVE_DAYS)


def join_location_default(contributors: DataFrame, locations: DataFrame) -> DataFrame:
    cols = locations.select("actor_login", F.col("normalized_country_code").alias("country_code"), F.col("normalized_city").alias("city"), "location_confidence")
    return contributors.join(cols, "actor_login", "left").withColumn("location_confidence", F.coalesce("location_confidence", F.lit("unusable")))


def contributor_signals(evidence: DataFrame, window_end: datetime.date) -> DataFrame:
    """evidence with every signal of the five components, 0-100, in its domain."""
    by = ["domain_id"]
    df = evidence.withColumns({"breadth": F.col("qualified_repo_count") + F.col("org_count"), "s_age": -X.days_since(F.lit(window_end), "latest").cast("double")})
    return S.scaled(df, by, {"x_points": "weighted_event_points", "x_repos": "qualified_repo_count", "x_subdomains": "subdomain_count", "x_months": "months", "x_span": "span_days", "x_reviews": "reviews_total", "x_pr": "pr_participation", "x_breadth": "breadth"}, {"x_recency": "s_age"})


def contrib_domain_activity() -> Column:
    return X.weighted_blend({"event_points": "x_points", "qualified_repo_count": "x_repos", "subdomain_breadth": "x_subdomains"}, C.CONTRIBUTOR_SIGNALS["domain_activity"])


def contrib_quality() -> Column:
    return F.col("x_points")


def contrib_exposure() -> Column:
    return F.col("exposure")


def contrib_continuity() -> Column:
    return X.weighted_blend({"active_months": "x_months", "recency": "x_recency", "activity_span": "x_span"}, C.CONTRIBUTOR_SIGNALS["continuity"])


def contrib_collaboration() -> Column:
    return X.weighted_blend({"reviews": "x_reviews", "pull_request_participation": "x_pr", "repo_org_breadth": "x_breadth"}, C.CONTRIBUTOR_SIGNALS["collaboration"])


def contributor_components(signals: DataFrame) -> DataFrame:
    df = signals.withColumns({
        "domain_activity_score": contrib_domain_activity(), "contribution_quality_score": contrib_quality(), "repository_quality_exposure_score": contrib_exposure(),
        "continuity_score": contrib_continuity(), "collaboration_score": contrib_collaboration(),
    })
    return df.withColumn("expert_score", X.weighted_blend({n: f"{n}_score" for n in C.CONTRIBUTOR}, C.CONTRIBUTOR))


def score_contributors(activity: DataFrame, classification: DataFrame, scores: DataFrame, locations: DataFrame, window_end: datetime.date) -> DataFrame:
    return finish_contributors(contributor_signals(contributor_evidence(activity, classification, scores), window_end), locations)


def finish_contributors(signals: DataFrame, locations: DataFrame) -> DataFrame:
    """Signals (staged, in long plans) to the table of scores."""
    df = join_location_default(contributor_components(signals), locations)
    return df.select(
        "actor_login", "domain_id", "expert_score", "domain_activity_score", "contribution_quality_score", "repository_quality_exposure_score", "continuity_score", "collaboration_score",
        "qualified_repo_count", F.col("months").alias("active_months"), "country_code", "city", "location_confidence", (F.col("qualified_repo_count") == 1).alias("one_repo"), "raw_event_count", "weighted_event_points",
    )


# Geographies: a population per domain and level

GEO = ["domain_id", "geo_level", "country_code", "city"]
POPULATION = ["domain_id", "geo_level"]


def geo_membership(scores: DataFrame, locations: DataFrame) -> DataFrame:
    """Actors with their score as members of a country and, if sure, of a city."""
    loc = locations.select("actor_login", F.col("normalized_country_code").alias("country_code"), F.col("normalized_city").alias("city"), "location_level", "location_confidence")
    members = scores.select("domain_id", "actor_login", "expert_score", "qualified_repo_count", "active_months").join(loc, "actor_login")
    country = members.where(L.eligible_country() & F.col("country_code").isNotNull()).withColumn("geo_level", F.lit("country")).withColumn("city", F.lit(None).cast("string"))
    city = members.where(L.eligible_city() & F.col("country_code").isNotNull() & F.col("city").isNotNull()).withColumn("geo_level", F.lit("city"))
    return country.unionByName(city)


def located_coverage(scores: DataFrame, locations: DataFrame) -> DataFrame:
    found = locations.where(L.eligible_country() & F.col("normalized_country_code").isNotNull()).select("actor_login", F.lit(1).alias("located"))
    return scores.join(found, "actor_login", "left").groupBy("domain_id").agg((F.count("located") / F.count("*")).alias("coverage"))


def join_scored_actors(activity: DataFrame, scores: DataFrame) -> DataFrame:
    return activity.join(scores.select("domain_id", "actor_login"), ["domain_id", "actor_login"])


def _eq(df: DataFrame, other: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    renamed = other.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return df.join(renamed, on, how).drop(*(f"__{k}" for k in keys))


def weighted_supply(cap: float = C.SUPPLY_SCORE_CAP) -> Column:
    return F.least("expert_score", F.lit(cap)) / 100


def geo_repo_points(members: DataFrame, activity: DataFrame) -> DataFrame:
    """(geo, actor, repo): capped points and the share of the actor's supply that goes to the repository."""
    rows = capped_points(activity).select("domain_id", "actor_login", "repo_name", "capped")
    joined = members.select(*GEO, "actor_login", weighted_supply().alias("supply")).join(rows, ["domain_id", "actor_login"])
    total = F.sum("capped").over(Window.partitionBy("domain_id", "geo_level", "actor_login"))
    return joined.withColumn("supplied", F.when(total > 0, F.col("supply") * F.col("capped") / total))


def repo_org_activity(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    repos = points.groupBy(*GEO, "repo_name").agg(F.sum("capped").alias("points"), F.sum("supplied").alias("supplied"))
    return repos, owner_activity(repos)


def owner_activity(repos: DataFrame) -> DataFrame:
    return repos.groupBy(*GEO, X.owner_of("repo_name").alias("owner")).agg(F.sum("points").alias("points"))


def max_share(totals: DataFrame, name: str, count: str) -> DataFrame:
    share = F.when(F.sum("points") > 0, F.max("points") / F.sum("points")).otherwise(0.0)
    return totals.groupBy(*GEO).agg(share.alias(name), F.count("*").alias(count))


def capped_supply(members: DataFrame, repos: DataFrame, share: float = C.SUPPLY_REPO_CAP) -> DataFrame:
    totals = members.groupBy(*GEO).agg(F.sum(weighted_supply()).alias("total"))
    by_repo = _eq(repos.where("supplied is not null"), totals, GEO).groupBy(*GEO).agg(F.sum("supplied").alias("given"), F.sum(F.least("supplied", share * F.col("total"))).alias("kept"))
    return _eq(totals, by_repo, GEO).select(*GEO, F.col("total").alias("weighted_expert_count"), (F.col("total") - F.coalesce("given", F.lit(0.0)) + F.coalesce("kept", F.lit(0.0))).alias("capped_supply"))


def top_quartile_share(members: DataFrame, p: float = C.TOP_QUARTILE) -> DataFrame:
    limits = S.percentile_value(members, POPULATION, "expert_score", p, "limit")
    return members.join(limits, POPULATION).groupBy(*GEO).agg((F.avg((F.col("expert_score") >= F.col("limit")).cast("double")) * 100).alias("top_quartile_share"))


def actor_activity(members: DataFrame, activity: DataFrame, window_end: datetime.date) -> DataFrame:
    """Per member: whether it reviewed, and was active in the window's last month and the one before."""
    end = F.lit(window_end)
    (s1, e1), s0 = X.month_bounds(end), X.previous_month(end)
    per = activity.groupBy("domain_id", "actor_login").agg(
        F.sum("reviews_submitted").alias("reviews"), F.bool_or(X.interval_overlap("first_seen", "last_seen", s1, e1)).alias("now"),
        F.bool_or(X.interval_overlap("first_seen", "last_seen", s0, F.last_day(s0))).alias("before"),
    )
    return members.join(per, ["domain_id", "actor_login"], "left")


def share_signals(active: DataFrame) -> DataFrame:
    share = lambda c: F.avg(F.coalesce(c, F.lit(False)).cast("double")) * 100
    return active.groupBy(*GEO).agg(
        F.count("*").alias("observable_expert_count"), F.count_if(F.col("location_confidence") == "high").alias("high_confidence_count"),
        share(F.col("qualified_repo_count") >= 2).alias("multi_repo_share"), share(F.col("reviews") > 0).alias("review_participation"), share(F.col("active_months") >= C.RECURRING_MONTHS).alias("recurring_share"),
        F.count_if("now").alias("latest_active"), F.count_if("before").alias("previous_active"),
    )


def momentum_direction(latest: str = "latest_active", previous: str = "previous_active") -> Column:
    return F.when(F.col(latest) > F.col(previous), C.MOMENTUM["up"]).when(F.col(latest) < F.col(previous), C.MOMENTUM["down"]).otherwise(C.MOMENTUM["flat"])


def top_subdomains(repos: DataFrame, classification: DataFrame, n: int = C.TOP_SUBDOMAINS) -> DataFrame:
    points = repos.join(classification.select("repo_name", F.explode("subdomains").alias("s")), "repo_name").groupBy(*GEO, "s").agg(F.sum("points").alias("points"))
    rank = F.row_number().over(Window.partitionBy(*GEO).orderBy(F.desc("points"), "s"))
    best = F.sort_array(F.collect_list(F.when(F.col("r") <= n, F.struct("r", "s"))))
    return points.withColumn("r", rank).groupBy(*GEO).agg(F.count("*").alias("subdomain_count"), F.transform(best, lambda x: x["s"]).alias("top_subdomains"))


def _by_level(index: int, minimums: dict) -> Column:
    return F.when(F.col("geo_level") == "country", minimums["country"][index]).otherwise(minimums["city"][index])


def _sampled(minimums: dict) -> list[tuple[Column, Column]]:
    people = F.when(F.col("geo_level") == "country", F.col("observable_expert_count")).otherwise(F.col("high_confidence_count"))
    return [(c, _by_level(i, minimums)) for i, c in enumerate((people, F.col("qualified_repo_count"), F.col("organization_count")))]


def sample_gate(minimums: dict = C.MIN_SAMPLES) -> Column:
    (a, x), (b, y), (c, z) = _sampled(minimums)
    return (a >= x) & (b >= y) & (c >= z)


def sample_adequacy(minimums: dict = C.MIN_SAMPLES) -> Column:
    return sum((F.least(c / (m * C.SATURATION), F.lit(1.0)) for c, m in _sampled(minimums)), F.lit(0.0)) / 3


def geo_rank(scored: DataFrame) -> DataFrame:
    order = [F.col("recommendation_tier") == "insufficient_data", F.desc("opportunity_score"), F.desc("confidence_score"), "geo_id"]
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy(*POPULATION).orderBy(*order)))


def geo_evidence(scores: DataFrame, activity: DataFrame, classification: DataFrame, locations: DataFrame, window_end: datetime.date) -> DataFrame:
    """One row per geography before scaling."""
    members = T.stage(geo_membership(scores, locations), "members")
    known = T.stage(join_scored_actors(semi_accepted_activity(activity, classification), scores), "known")
    repos = T.stage(repo_org_activity(geo_repo_points(members, known))[0], "geo-repositories")
    owners = owner_activity(repos)
    # Seven aggregates meet here: each reads the stage tables, none the others.
    out = share_signals(actor_activity(members, known, window_end))
    weighted = members.withColumn("w", weighted_supply()).where("w > 0")
    for part in (
        capped_supply(members, repos), max_share(repos, "max_repo_share", "qualified_repo_count"), max_share(owners, "max_org_share", "organization_count"),
        S.weighted_median(weighted, GEO, "expert_score", "w"), top_quartile_share(members), top_subdomains(repos, classification),
    ):
        out = _eq(out, part, GEO)
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("qualified_repo_count", "organization_count", "subdomain_count", "max_repo_share", "max_org_share")}
    return out.withColumns(zero).withColumn("top_subdomains", F.coalesce("top_subdomains", F.array().cast("array<string>"))).join(located_coverage(scores, locations), "domain_id")


def geo_signals(evidence: DataFrame) -> DataFrame:
    """evidence with its counts scaled among the geographies of a domain and level."""
    df = S.scale_counts(evidence, POPULATION, {"x_supply": "capped_supply", "x_repos": "qualified_repo_count", "x_orgs": "organization_count", "x_subs": "subdomain_count"})
    return df.withColumn("high_confidence_location_share", F.col("high_confidence_count") / F.col("observable_expert_count"))


def geo_supply() -> Column:
    return F.col("x_supply")


def geo_quality() -> Column:
    return X.weighted_blend({"weighted_median": F.coalesce("weighted_median", F.lit(0.0)), "top_quartile_share": "top_quartile_share"}, C.GEO_SIGNALS["expert_quality"])


def geo_collaboration() -> Column:
    return X.weighted_blend({n: n for n in C.GEO_SIGNALS["collaboration_depth"]}, C.GEO_SIGNALS["collaboration_depth"])


def geo_breadth() -> Column:
    parts = {"qualified_repos": "x_repos", "organizations": "x_orgs", "subdomain_breadth": "x_subs", "low_concentration": (1 - F.col("max_org_share")) * 100}
    return X.weighted_blend(parts, C.GEO_SIGNALS["ecosystem_breadth"])


def geo_confidence(minimums: dict = C.MIN_SAMPLES) -> Column:
    return X.weighted_blend({
        "located_profile_coverage": F.col("coverage") * 100, "location_certainty": F.col("high_confidence_location_share") * 100, "sample_size_adequacy": sample_adequacy(minimums) * 100,
        "repository_diversity": (1 - F.col("max_repo_share")) * 100, "organization_diversity": (1 - F.col("max_org_share")) * 100,
    }, C.CONFIDENCE)


def geo_opportunity(weights: dict[str, float] = C.OPPORTUNITY) -> Column:
    """From the five components."""
    return X.weighted_blend({n: f"{n}_score" for n in C.OPPORTUNITY}, weights)


def org_concentration_flag() -> Column:
    return F.col("max_org_share") > C.ORG_SHARE_FLAG


def geo_components(signals: DataFrame, minimums: dict = C.MIN_SAMPLES) -> DataFrame:
    return signals.withColumns({
        "expert_supply_score": geo_supply(), "expert_quality_score": geo_quality(), "collaboration_depth_score": geo_collaboration(), "momentum_score": momentum_direction(),
        "ecosystem_breadth_score": geo_breadth(), "samples_ok": sample_gate(minimums), "confidence_score": geo_confidence(minimums),
    })


def geo_id() -> Column:
    return F.when(F.col("geo_level") == "country", F.col("country_code")).otherwise(X.city_geo_id("country_code", "city"))


def score_geographies(evidence: DataFrame, opportunity: dict[str, float] = C.OPPORTUNITY, minimums: dict = C.MIN_SAMPLES) -> DataFrame:
    """Evidence scaled among the geographies of a domain and level, tiered and ranked."""
    return rank_signals(geo_signals(evidence), opportunity, minimums)


def rank_signals(signals: DataFrame, opportunity: dict[str, float] = C.OPPORTUNITY, minimums: dict = C.MIN_SAMPLES) -> DataFrame:
    df = geo_components(signals, minimums).withColumn("opportunity_score", geo_opportunity(opportunity))
    df = df.withColumn("geo_id", geo_id())
    df = df.withColumn("recommendation_tier", X.assign_tier("opportunity_score", "confidence_score", "samples_ok"))
    return geo_rank(df).select(
        "geo_level", "geo_id", "country_code", "city", "domain_id", "opportunity_score", "confidence_score", "expert_supply_score", "expert_quality_score", "collaboration_depth_score", "momentum_score",
        "ecosystem_breadth_score", "observable_expert_count", "weighted_expert_count", "qualified_repo_count", "organization_count", (F.col("multi_repo_share") / 100).alias("multi_repo_expert_share"),
        F.col("coverage").alias("located_profile_coverage"), "high_confidence_location_share", "top_subdomains", "rank", "recommendation_tier",
        F.col("max_org_share").alias("org_concentration_share"), org_concentration_flag().alias("org_concentration_flag"),
    )


def rank_geographies(scores: DataFrame, activity: DataFrame, classification: DataFrame, locations: DataFrame, window_end: datetime.date, opportunity: dict[str, float] = C.OPPORTUNITY, minimums: dict = C.MIN_SAMPLES) -> DataFrame:
    """Both levels, all domains."""
    return score_geographies(geo_evidence(scores, activity, classification, locations, window_end), opportunity, minimums)
