"""Checks, privacy scan, sensitivity, bias and samples."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from atlasmith import settings as C
from atlasmith.functions import expressions as X
from atlasmith.functions import stats as S
from atlasmith.operators import discovery as D
from atlasmith.operators import scores as G
from atlasmith.sources import snapshots
from atlasmith.sources import tables as T


def check_rows(df: DataFrame, tests: dict[str, tuple[Column, str]]) -> DataFrame:
    """A row per test from one pass: name, failing rows, pass, requirement."""
    counted = df.agg(*(F.count_if(test).alias(name) for name, (test, _) in tests.items()))
    rows = F.explode(F.array(*(F.struct(F.lit(n).alias("check_name"), F.col(n).alias("failing_rows"), F.lit(why).alias("requirement")) for n, (_, why) in tests.items())))
    return counted.select(rows.alias("c")).select("c.check_name", "c.failing_rows", F.when(F.col("c.failing_rows") == 0, "pass").otherwise("fail").alias("status"), "c.requirement")


def _any(columns: list[str], test) -> Column:  # noqa: ANN001
    out = F.lit(False)
    for c in columns:
        out = out | F.coalesce(test(F.col(c)), F.lit(False))
    return out


def check_duplicates(df: DataFrame, keys: list[str], name: str, why: str) -> DataFrame:
    return check_rows(D.dup_keys(df, keys), {name: (F.lit(True), why)})


def repo_tests(start: datetime.date, end: datetime.date) -> dict[str, tuple[Column, str]]:
    """Tests on the rows of repositories, by the check's name."""
    counts = ["unique_human_contributors", "active_days", "active_months", "push_events", "push_commit_count", "pull_requests_opened", "pull_requests_closed", "merged_pull_requests",
              "reviews_submitted", "issues_opened", "issue_comments", "releases", "weighted_activity_score"]
    total = sum((F.col(c) for c in ("pull_requests_opened", "pull_requests_closed", "reviews_submitted", "issues_opened", "issue_comments", "releases")), F.col("push_events"))
    accepted = F.col("discovery_status") == "accepted"
    return {
        "repo_date_bounds": ((F.col("first_seen") < F.lit(start)) | (F.col("last_seen") > F.lit(end)) | (F.col("first_seen") > F.col("last_seen")), "first_seen and last_seen within the window and ordered"),
        "repo_non_negative_counts": (_any(counts, lambda c: c < 0), "every repository counter and score non-negative"),
        "repo_share_bounds": (_any(["automation_event_share", "single_actor_event_share"], lambda c: (c < 0) | (c > 1)), "shares within [0, 1]"),
        "merged_within_closed": (F.col("merged_pull_requests") > F.col("pull_requests_closed"), "merged pull requests never exceed closed ones"),
        "meaningful_events_consistency": (F.col("meaningful_events") != total, "meaningful_events equals the sum of counted human events"),
        "status_reason_consistency": (accepted == F.col("exclusion_reason").isNotNull(), "accepted rows carry no reason, all others one"),
    }


CONTRIBUTOR_COUNTS = ["push_events", "pull_requests_opened", "merged_pull_requests_authored", "reviews_submitted", "issues_opened", "issue_comments", "active_days", "active_months", "raw_contribution_points"]


def contributor_tests() -> dict[str, tuple[Column, str]]:
    return {"contributor_non_negative_counts": (_any(CONTRIBUTOR_COUNTS, lambda c: c < 0), "every contributor counter and score non-negative")}


def check_contributor_non_negative(contributors: DataFrame) -> DataFrame:
    return check_rows(contributors, contributor_tests())


def check_contributor_membership(contributors: DataFrame, repos: DataFrame) -> DataFrame:
    return check_rows(D.anti_membership(contributors, repos), {"contributor_repo_membership": (F.lit(True), "every contributor row belongs to an accepted repository")})


#: Keys that are unique in the grid, and in rows of repositories and contributors.
KEYS = {"grid": ["month", "repo_name", "actor_login"], "repo": ["repo_name"], "contributor": ["actor_login", "repo_name"]}


def check_keys(df: DataFrame, name: str) -> DataFrame:
    return check_duplicates(df, KEYS[name], f"{name}_duplicate_keys", f"{', '.join(KEYS[name])} unique")


def quality_checks(repos: DataFrame, grid: DataFrame, contributors: DataFrame, start: datetime.date, end: datetime.date) -> DataFrame:
    """The eleven discovery checks."""
    out = check_rows(repos, repo_tests(start, end)).unionByName(check_contributor_non_negative(contributors)).unionByName(check_contributor_membership(contributors, repos))
    for name, df in (("grid", grid), ("repo", repos), ("contributor", contributors)):
        out = out.unionByName(check_keys(df, name))
    return out


class ChecksFailed(Exception):
    """A table was not replaced, as rows fail its checks. failing: rows by check; quarantine: the folder of failing rows."""

    def __init__(self, failing: dict[str, int], quarantine: str):
        super().__init__("checks failed: " + ", ".join(f"{n} ({k} rows)" for n, k in sorted(failing.items()) if k))
        self.failing, self.quarantine = failing, quarantine


def key_test(keys: list[str]) -> Column:
    """Whether a row repeats a key for the first time; one such row per key that comes more than once."""
    return F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0))) == 2


def write_checked(df: DataFrame, tests: dict[str, tuple[Column, str]], path: str) -> tuple[DataFrame, dict[str, int]]:
    """Replace a table if all its rows pass; the table, and failing rows by check. Otherwise ChecksFailed, and the table stays.

    One pass: failing rows are counted by metrics that are observed while rows are written, those that
    pass to one folder and the others, with the names of the checks that they fail, to a quarantine beside it.
    """
    marks = {f"__{n}": F.coalesce(test, F.lit(False)) for n, (test, _) in tests.items()}
    failed = F.array_compact(F.array(*(F.when(F.col(f"__{n}"), F.lit(n)) for n in tests)))
    marked = df.withColumns(marks)
    watch = Observation()
    rows = marked.observe(watch, *(F.count_if(F.col(f"__{n}")).alias(n) for n in tests)).withColumn("failed_checks", failed).drop(*marks)
    failing: dict[str, int] = {}

    def gate(quarantine: str) -> None:
        failing.update((n, int(k)) for n, k in watch.get.items())
        if any(failing.values()):
            raise ChecksFailed(failing, quarantine)

    return snapshots.replace_split(rows, F.size("failed_checks") == 0, path, df.columns, gate), failing


def check_table(failing: dict[str, int], tests: dict[str, tuple[Column, str]], like: DataFrame) -> DataFrame:
    """Counts of write_checked() as rows of checks."""
    rows = [(n, failing[n], "fail" if failing[n] else "pass", why) for n, (_, why) in tests.items()]
    return like.sparkSession.createDataFrame(rows, "check_name string, failing_rows long, status string, requirement string")


def repo_write_tests(start: datetime.date, end: datetime.date) -> dict[str, tuple[Column, str]]:
    return repo_tests(start, end) | {"repo_duplicate_keys": (key_test(KEYS["repo"]), "repo_name unique")}


def contributor_write_tests() -> dict[str, tuple[Column, str]]:
    """Of contributor rows with is_member: whether the repository is accepted."""
    return contributor_tests() | {"contributor_repo_membership": (~F.col("is_member"), "every contributor row belongs to an accepted repository"), "contributor_duplicate_keys": (key_test(KEYS["contributor"]), "actor_login, repo_name unique")}


def with_membership(contributors: DataFrame, repos: DataFrame) -> DataFrame:
    accepted = repos.where("discovery_status = 'accepted'").select("repo_name").distinct().withColumn("__in", F.lit(True))
    return contributors.join(accepted, "repo_name", "left").withColumn("is_member", F.coalesce("__in", F.lit(False))).drop("__in")


def quality_gate(repos: DataFrame, grid: DataFrame, contributors: DataFrame, start: datetime.date, end: datetime.date, path: str) -> tuple[DataFrame, list[str]]:
    """Write the three discovery tables under path, each checked at its write: all checks as rows, and the tables that were stopped."""
    plan = {
        "grid": (grid, {"grid_duplicate_keys": (key_test(KEYS["grid"]), "month, repo_name, actor_login unique")}), "repositories": (repos, repo_write_tests(start, end)),
        "contributors": (with_membership(contributors, repos), contributor_write_tests()),
    }
    out, stopped = None, []
    for name, (df, tests) in plan.items():
        try:
            _, failing = write_checked(df, tests, f"{path}/{name}")
        except ChecksFailed as error:
            failing = error.failing
            stopped.append(name)
        checks = check_table(failing, tests, df)
        out = checks if out is None else out.unionByName(checks)
    return out, stopped


def check_score_bounds(scores: DataFrame, parts: dict[str, float], final: str) -> DataFrame:
    columns = [f"{n}_score" for n in parts]
    total = sum((F.col(f"{n}_score") * w for n, w in parts.items()), F.lit(0.0))
    return check_rows(scores, {
        f"{final}_components": (_any(columns, lambda c: (c < 0) | (c > 100)), "components within [0, 100]"),
        f"{final}_weighted_sum": (F.abs(total - F.col(final)) > 1e-9, "weighted sum of components equals the score"),
    })


def check_schema_contract(df: DataFrame, contract: dict[str, str]) -> DataFrame:
    """Failing rows by column, from one aggregate over the table. contract: {column: kind}; settings.KINDS has the kinds.

    A kind has the types that a column may have, whether it may be null ("?" at its end), bounds or values. A column that
    is missing, of another type, or not in the contract fails in every row.
    """
    kinds, tests = dict(df.dtypes), {}
    for c, kind in contract.items():
        rule = C.KINDS[kind.rstrip("?")]
        if kinds.get(c) not in rule["types"]:
            tests[c] = (F.lit(True), f"{c} has type {' or '.join(rule['types'])}")
            continue
        bad = F.lit(False) if kind.endswith("?") else F.col(c).isNull()
        if "values" in rule:
            bad = bad | ~F.coalesce(F.col(c).isin(*rule["values"]), F.lit(True))
        for key, test in (("min", lambda x, v: x < v), ("max", lambda x, v: x > v)):
            if key in rule:
                bad = bad | F.coalesce(test(F.col(c), rule[key]), F.lit(False))
        tests[c] = (bad, f"{c} within its contract")
    return check_rows(df, tests | {c: (F.lit(True), f"{c} is not in the contract") for c in df.columns if c not in contract})


def check_contracts(tables: dict[str, DataFrame], contracts: dict[str, dict[str, str]] = C.CONTRACTS) -> DataFrame:
    """check_schema_contract of every table, with its name."""
    out = None
    for name, contract in contracts.items():
        found = check_schema_contract(tables[name], contract).select(F.lit(name).alias("table_name"), F.col("check_name").alias("column_name"), "failing_rows", "status")
        out = found if out is None else out.unionByName(found)
    return out


def check_rankings(rankings: DataFrame, minimums: dict = C.MIN_SAMPLES) -> DataFrame:
    """Country codes, geo ids, tier thresholds and minimum samples of published rankings."""
    tier, o, c = F.col("recommendation_tier"), F.col("opportunity_score"), F.col("confidence_score")
    low = F.when(F.col("geo_level") == "country", minimums["country"][1]).otherwise(minimums["city"][1])
    return check_rows(rankings, {
        "country_code": (F.col("country_code").isNull(), "every geography has a country"),
        "geo_ids": (F.when(F.col("geo_level") == "country", F.col("geo_id") != F.col("country_code")).otherwise(F.col("geo_id") != X.city_geo_id("country_code", "city")), "geo_id follows from country and city"),
        "tier_threshold": (((tier == "priority") & ((o < 75) | (c < 70))) | ((tier == "promising") & ((o < 60) | (c < 60))) | ((tier != "insufficient_data") & (c < 45)), "tiers keep their thresholds"),
        "min_samples": ((tier != "insufficient_data") & (F.col("qualified_repo_count") < low), "sufficient geographies meet the minimum samples"),
    })


def check_rank_order(rankings: DataFrame) -> DataFrame:
    """Ranks are 1..n per level and follow opportunity among sufficient geographies."""
    by = Window.partitionBy("domain_id", "geo_level").orderBy("rank")
    above = F.lag("opportunity_score").over(by)
    marked = rankings.withColumn("gap", F.col("rank") - F.coalesce(F.lag("rank").over(by), F.lit(0))).withColumn("rises", (F.col("recommendation_tier") != "insufficient_data") & (F.col("opportunity_score") > above))
    return check_rows(marked, {"rank_dense": (F.col("gap") != 1, "ranks are 1..n"), "rank_order": (F.coalesce("rises", F.lit(False)), "opportunity falls with rank")})


def check_evidence_present(classification: DataFrame) -> DataFrame:
    none = X.evidence_count("evidence_topics", "evidence_terms", "evidence_files") == 0
    return check_rows(classification, {"evidence_present": ((F.col("classification_status") == "accepted") & none, "accepted repositories have evidence")})


def check_event_ids(events: DataFrame, key: str) -> DataFrame:
    return check_duplicates(events, [key], "event_ids", f"{key} unique")


def privacy_scan(lines: DataFrame) -> DataFrame:
    """(file, pattern, excerpt) for each line and pattern that it holds. lines: (file, text with line breaks)."""
    each = lines.select("file", F.explode(F.split("text", r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]")).alias("line"))
    names = F.array_compact(F.array(*(F.when(F.col("line").rlike(p), F.lit(name)) for name, p in C.PRIVACY)))
    text = F.btrim("line", F.lit(" \t\n\x0b\x0c\r"))
    excerpt = F.when(F.char_length(text) <= C.EXCERPT, text).otherwise(F.concat(F.substring(text, 1, C.EXCERPT), F.lit("…")))
    return each.select("file", F.explode(names).alias("pattern"), excerpt.alias("excerpt"))


def privacy_gate(violations: DataFrame) -> DataFrame:
    """One row with the number of violations, or an error when it is read, if there is any."""
    n = F.count("*")
    return violations.agg(n.alias("violations")).withColumn("violations", F.when(F.col("violations") > 0, F.raise_error(F.lit("published text holds private data")).cast("long")).otherwise(F.col("violations")))


def precision_metrics(predictions: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Of predicted rows with a label: precision and false-inclusion rate. predictions: (key, predicted); labels: (key, label)."""
    both = predictions.join(labels, key).where("predicted")
    return both.agg(F.count("*").alias("reviewed"), F.avg(F.col("label").cast("double")).alias("precision"), F.avg((~F.col("label")).cast("double")).alias("false_inclusion_rate"))


def coverage_bias(rows: DataFrame, dimensions: list[str]) -> DataFrame:
    """Located share per bucket of each dimension. rows: dimensions and a boolean located."""
    long = F.explode(F.array(*(F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("bucket")) for d in dimensions)))
    return rows.select("located", long.alias("x")).groupBy("x.dimension", "x.bucket").agg(F.count("*").alias("n"), F.avg(F.col("located").cast("double")).alias("located_share"))


def main_repository(activity: DataFrame) -> DataFrame:
    """(actor_login, repo_name): where an actor has the most contribution points."""
    order = F.struct("raw_contribution_points", F.col("repo_name"))
    return activity.groupBy("domain_id", "actor_login").agg(F.max(order).alias("x")).select("domain_id", "actor_login", F.col("x.repo_name").alias("repo_name"))


def organization_size(activity: DataFrame) -> DataFrame:
    """(owner, organization_size): owners by how many actors contribute to their repositories."""
    n = F.count_distinct("actor_login")
    return activity.groupBy(X.owner_of("repo_name").alias("owner")).agg(F.when(n <= 5, "1-5").when(n <= 50, "6-50").when(n <= 500, "51-500").otherwise("501+").alias("organization_size"))


def bias_rows(scores: DataFrame, activity: DataFrame, metadata: DataFrame) -> DataFrame:
    """Scored actors with the dimensions of coverage_bias(): activity decile, language and organization of their main repository."""
    main = main_repository(activity).join(metadata.select("repo_name", F.col("primary_language").alias("language")), "repo_name", "left").withColumn("owner", X.owner_of("repo_name"))
    known = main.join(organization_size(activity), "owner", "left").select("domain_id", "actor_login", "language", "organization_size")
    return activity_decile(scores, "raw_event_count").join(known, ["domain_id", "actor_login"], "left").withColumn("located", F.col("country_code").isNotNull())


def activity_decile(df: DataFrame, value: str, name: str = "activity_decile") -> DataFrame:
    """1 to 10 by exact cut points from counts per distinct value, without sorting all rows."""
    cuts = S.percentiles(df, [], value, {f"__d{i}": i / 10 for i in range(1, 10)})
    above = sum((F.coalesce((F.col(value) > F.col(c)).cast("int"), F.lit(0)) for c in cuts.columns), F.lit(1))
    return df.crossJoin(F.broadcast(cuts)).withColumn(name, above).drop(*cuts.columns)


def scenario_weights(weights: dict[str, float], name: str, change: float) -> dict[str, float]:
    raised = {k: v * (1 + change) if k == name else v for k, v in weights.items()}
    return {k: v / sum(raised.values()) for k, v in raised.items()}


def scenario_shift(ranks: DataFrame, baseline: str = "baseline") -> DataFrame:
    """(scenario, geo_level, geo_id, rank, baseline_rank, shift)."""
    base = ranks.where(F.col("scenario") == baseline).select("domain_id", "geo_level", "geo_id", F.col("rank").alias("baseline_rank"))
    return ranks.join(base, ["domain_id", "geo_level", "geo_id"]).withColumn("shift", F.col("rank") - F.col("baseline_rank"))


def sensitivity(scores: DataFrame, activity: DataFrame, classification: DataFrame, locations: DataFrame, repo_scores: DataFrame, window_end: datetime.date, minimums: dict = C.MIN_SAMPLES) -> DataFrame:
    """Ranks under other supply weights, without the top 1 % of repositories, and without the largest owner; with shifts."""
    limit = S.percentile_value(repo_scores, [], "repository_quality_score", 0.99, "limit")
    top = repo_scores.crossJoin(limit).where("repository_quality_score >= limit").select("repo_name")
    owners = activity.groupBy(X.owner_of("repo_name").alias("owner")).agg(F.count("*").alias("n"))
    largest = owners.orderBy(F.desc("n"), "owner").limit(1)
    without = activity.withColumn("owner", X.owner_of("repo_name")).join(largest.select("owner"), "owner", "left_anti").drop("owner")
    # Scenarios that differ in weights only share their evidence.
    runs = [
        (activity, {"baseline": C.OPPORTUNITY, "supply_plus_20": scenario_weights(C.OPPORTUNITY, "expert_supply", 0.2), "supply_minus_20": scenario_weights(C.OPPORTUNITY, "expert_supply", -0.2)}),
        (activity.join(top, "repo_name", "left_anti"), {"top_1pct_repos_removed": C.OPPORTUNITY}), (without, {"largest_org_removed": C.OPPORTUNITY}),
    ]
    out = None
    for rows, scenarios in runs:
        signals = T.stage(G.geo_signals(G.geo_evidence(scores, rows, classification, locations, window_end)), "scenario")
        for name, weights in scenarios.items():
            ranks = G.rank_signals(signals, weights, minimums).select(F.lit(name).alias("scenario"), "domain_id", "geo_level", "geo_id", "rank")
            out = ranks if out is None else out.unionByName(ranks)
    return scenario_shift(T.stage(out, "scenarios"))


def raw_vs_weighted(rankings: DataFrame) -> DataFrame:
    by = Window.partitionBy("domain_id", "geo_level")
    order = lambda c: F.row_number().over(by.orderBy(F.desc(c), "geo_id"))
    return rankings.select("domain_id", "geo_level", "geo_id", order("observable_expert_count").alias("raw_rank"), order("weighted_expert_count").alias("weighted_rank")).withColumn("difference", F.col("raw_rank") - F.col("weighted_rank"))


def window_ranks(states: tuple[DataFrame, DataFrame], months: list[int], discovery: DataFrame, classification: DataFrame, metadata: DataFrame, locations: DataFrame, terms: list[str], domain: str, window_end: datetime.date, minimums: dict) -> DataFrame:
    """All scores and the ranking of geographies over these months, rolled up from monthly states."""
    actors, repos = states
    activity = D.roll_activity(actors, repos, months, terms)
    repo_scores = T.stage(G.finish_repositories(T.stage(G.repo_signals(T.stage(G.join_score_inputs(classification, activity, metadata), "window-repositories"), window_end), "window-signals")), "window-qualities")
    contributors = T.stage(D.roll_contributors(actors, months, discovery, domain), "window-contributors")
    evidence = T.stage(G.contributor_evidence(contributors, classification, repo_scores), "window-evidence")
    scores = T.stage(G.finish_contributors(T.stage(G.contributor_signals(evidence, window_end), "window-signals"), locations), "window-scores")
    return G.score_geographies(T.stage(G.geo_evidence(scores, contributors, classification, locations, window_end), "window-geographies"), minimums=minimums)


def window_comparison(short: DataFrame, long: DataFrame) -> DataFrame:
    """Ranks of geographies over two windows side by side; null where a window has no such geography."""
    key = ["domain_id", "geo_level", "geo_id"]
    both = short.select(*key, F.col("rank").alias("short_rank")).join(long.select(*key, F.col("rank").alias("long_rank")), key, "full")
    return both.withColumn("shift", F.col("short_rank") - F.col("long_rank"))


def sample_rows(df: DataFrame, strata: str, key: str, n: int, seed: int) -> DataFrame:
    """n rows of each stratum in the order of a seeded hash of the key. The ranking is cut before the shuffle."""
    order = F.md5(F.encode(F.concat_ws(":", F.lit(seed), F.col(key)), "UTF-8"))
    return df.withColumn("__order", order).withColumn("__rank", F.row_number().over(Window.partitionBy(strata).orderBy("__order", key))).where(F.col("__rank") <= n).drop("__order", "__rank")
