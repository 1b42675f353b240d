"""Published datasets: rows per page, built for all geographies at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atlasmith.functions import expressions as X
from atlasmith.functions import stats
from atlasmith.sources import tables as T

COMPONENTS = ("expert_supply", "expert_quality", "collaboration_depth", "ecosystem_breadth")
ALL_COMPONENTS = ("expert_supply", "expert_quality", "collaboration_depth", "momentum", "ecosystem_breadth")


def distinct_pairs(activity: DataFrame) -> DataFrame:
    return activity.select("actor_login", "repo_name").dropDuplicates()


def explode_subdomain_join(classification: DataFrame, activity: DataFrame, scores: DataFrame) -> DataFrame:
    """(subdomain, country_code, experts): distinct located actors."""
    repos = classification.where("classification_status = 'accepted'").select("repo_name", F.explode("subdomains").alias("subdomain"))
    actors = scores.where("country_code is not null").select("actor_login", "country_code").distinct()
    return distinct_pairs(activity).join(repos, "repo_name").join(actors, "actor_login").groupBy("subdomain", "country_code").agg(F.count_distinct("actor_login").alias("experts"))


def subdomain_hubs(counts: DataFrame) -> DataFrame:
    first = F.row_number().over(Window.partitionBy("subdomain").orderBy(F.desc("experts"), "country_code"))
    return counts.withColumn("r", first).where("r = 1").drop("r")


def subdomain_mix(counts: DataFrame) -> DataFrame:
    total = F.greatest(F.sum("experts").over(Window.partitionBy("country_code")), F.lit(1))
    return counts.withColumn("share", F.col("experts") / total)


def kpis(classification: DataFrame, scores: DataFrame, locations: DataFrame, rankings: DataFrame) -> DataFrame:
    located = F.count_if(F.col("normalized_country_code").isNotNull())
    parts = [
        classification.agg(F.count_if(F.col("classification_status") == "accepted").alias("qualified_repos")), scores.agg(F.count_distinct("actor_login").alias("experts")),
        locations.agg(F.coalesce(F.try_divide(located, F.count("*")), F.lit(0.0)).alias("located_coverage")),
        rankings.agg(F.count_if((F.col("geo_level") == "country") & (F.col("recommendation_tier") != "insufficient_data")).alias("sufficient_countries")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(p)  # one row each
    return out


def coverage_by_country(locations: DataFrame, n: int = 40) -> DataFrame:
    found = locations.where("normalized_country_code is not null").groupBy(F.col("normalized_country_code").alias("country_code")).agg(F.count("*").alias("located"))
    total = found.agg(F.sum("located").alias("total"))
    return found.crossJoin(total).withColumn("share", F.col("located") / F.col("total")).drop("total").orderBy(F.desc("located"), "country_code").limit(n)


def confidence_distribution(locations: DataFrame) -> DataFrame:
    return locations.groupBy("location_confidence").agg(F.count("*").alias("n"))


def score_summary(scores: DataFrame, column: str) -> DataFrame:
    ends = scores.agg(F.count("*").alias("n_rows"), F.min(column).alias("lowest"), F.max(column).alias("highest"))
    return ends.crossJoin(stats.percentile_value(scores, [], column, 0.5, "middle"))  # one row each


def funnel(stages: dict[str, DataFrame]) -> DataFrame:
    out = None
    for i, (name, df) in enumerate(stages.items()):
        row = df.agg(F.lit(i).alias("position"), F.lit(name).alias("stage"), F.count("*").alias("n"))
        out = row if out is None else out.unionByName(row)
    return out


def top_priority(rankings: DataFrame, n: int = 5) -> DataFrame:
    return rankings.where("geo_level = 'country' and recommendation_tier <> 'insufficient_data'").orderBy("rank", "geo_id").limit(n)


def recommendation_topk(rankings: DataFrame, n: int = 3) -> DataFrame:
    tier = F.when(F.col("recommendation_tier") == "priority", 0).when(F.col("recommendation_tier") == "promising", 1).when(F.col("recommendation_tier") == "monitor", 2).otherwise(3)
    return rankings.where("geo_level = 'country' and recommendation_tier <> 'insufficient_data'").withColumn("tier_rank", tier).orderBy("tier_rank", "rank", "geo_id").limit(n)


def table_sort(df: DataFrame, column: str, then: str | None = None, ascending: bool = True) -> DataFrame:
    """Rows by a column; equal ones by another, ascending."""
    first = F.col(column).asc() if ascending else F.col(column).desc()
    return df.orderBy(first, *([then] if then else []))


def explorer_filter(rankings: DataFrame, subdomain: str | None = None, tier: str | None = None, min_confidence: float | None = None, text: str | None = None) -> DataFrame:
    df = rankings
    if subdomain:
        df = df.where(F.array_contains("top_subdomains", subdomain))
    if tier:
        df = df.where(F.col("recommendation_tier") == tier)
    if min_confidence is not None:
        df = df.where(F.col("confidence_score") >= min_confidence)
    if text:
        df = df.where(F.lower(F.concat_ws(" ", "city", "country_code")).contains(text.lower()))
    return df


def with_names(rankings: DataFrame, countries: DataFrame) -> DataFrame:
    """rankings with name. countries: (country_code, country_name)."""
    return rankings.join(countries, "country_code", "left").withColumn("name", X.display_name("country_code", "country_name", "city")).drop("country_name")


def rankings_payload(rankings: DataFrame, countries: DataFrame) -> DataFrame:
    named = with_names(rankings, countries).withColumn("momentum_provisional", F.lit(True)).drop("org_concentration_share", "org_concentration_flag")
    return named.select("geo_level", "geo_id", T.json_row(named).alias("payload"))


def caveats() -> Column:
    return F.array_compact(F.array(
        F.when(F.col("located_profile_coverage") < 0.4, F.format_string("Only %.0f%% of scored profiles could be located.", F.col("located_profile_coverage") * 100)),
        F.when(F.col("org_concentration_flag"), F.format_string("One organization accounts for %.0f%% of activity.", F.col("org_concentration_share") * 100)),
        F.lit("Momentum compares two months only and is provisional."),
    ))


def strongest(parts: tuple[str, ...] = COMPONENTS) -> Column:
    """Name of the highest component, the first of equals."""
    return F.array_max(F.array(*(F.struct(F.col(f"{p}_score").alias("s"), F.lit(-i).alias("o"), F.lit(p).alias("n")) for i, p in enumerate(parts))))["n"]


def weakest(parts: tuple[str, ...] = COMPONENTS) -> Column:
    return F.array_min(F.array(*(F.struct(F.col(f"{p}_score").alias("s"), F.lit(i).alias("o"), F.lit(p).alias("n")) for i, p in enumerate(parts))))["n"]


def recommendations(rankings: DataFrame, countries: DataFrame, n: int = 3) -> DataFrame:
    top = with_names(recommendation_topk(rankings, n), countries).withColumns({"strongest": strongest(), "weakest": weakest()})
    words = lambda c: F.replace(F.col(c), F.lit("_"), F.lit(" "))
    text = F.format_string("%s ranks %d with an opportunity score of %.1f: strongest in %s, weakest in %s.", "name", "rank", "opportunity_score", words("strongest"), words("weakest"))
    return top.select("geo_id", "name", "rank", "recommendation_tier", "strongest", "weakest", text.alias("text"))


def why_statements(rankings: DataFrame, countries: DataFrame) -> DataFrame:
    named = with_names(rankings, countries).withColumns({"strongest": strongest(ALL_COMPONENTS), "weakest": weakest(ALL_COMPONENTS)})
    say = lambda form, c: F.format_string(form, "name", F.replace(F.col(c), F.lit("_"), F.lit(" ")))
    return named.select("geo_level", "geo_id", F.array(say("%s does best in %s.", "strongest"), say("%s does worst in %s.", "weakest")).alias("statements"))


def comparison_summary(rankings: DataFrame, countries: DataFrame, geo_ids: list[str], metrics: tuple[str, ...] = ("opportunity_score", "confidence_score", "observable_expert_count")) -> DataFrame:
    """Per metric the leaders among two to four geographies, ties named together."""
    if not 2 <= len(geo_ids) <= 4:
        raise ValueError("compare two to four geographies")
    rows = with_names(rankings.where(F.col("geo_id").isin(*geo_ids)), countries)
    long = rows.select("name", F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics))).alias("x")).select("name", "x.*")
    best = long.withColumn("best", F.max("value").over(Window.partitionBy("metric"))).where("value = best").groupBy("metric", "best").agg(F.array_join(F.array_sort(F.collect_list("name")), " and ").alias("leaders"))
    return best.withColumn("text", F.format_string("%s: %s leads with %.1f.", F.replace("metric", F.lit("_"), F.lit(" ")), "leaders", "best"))


def subdomain_options(rankings: DataFrame) -> DataFrame:
    return rankings.select(F.explode("top_subdomains").alias("subdomain")).distinct().orderBy("subdomain")


def compare_payload(rankings: DataFrame, countries: DataFrame) -> DataFrame:
    return rankings_payload(rankings.where("geo_level = 'country'"), countries).unionByName(rankings_payload(rankings.where("geo_level = 'city'"), countries))


def country_detail(rankings: DataFrame, countries: DataFrame, mix: DataFrame, trend: DataFrame) -> DataFrame:
    """One JSON row per country, all countries in one job."""
    of = lambda df, name, *cols: df.groupBy("country_code").agg(F.array_sort(F.collect_list(F.struct(*cols))).alias(name))
    rows = with_names(rankings.where("geo_level = 'country'"), countries).withColumn("caveats", caveats())
    rows = rows.join(of(mix, "subdomain_mix", "subdomain", "experts", "share"), "country_code", "left").join(of(trend, "trend", "month", "events", "active_contributors"), "country_code", "left")
    return rows.select("geo_id", X.city_slug("geo_id").alias("file"), T.json_row(rows).alias("payload"))


def city_detail(rankings: DataFrame, countries: DataFrame) -> DataFrame:
    note = F.array(F.lit("City samples count high-confidence locations only."))
    rows = with_names(rankings.where("geo_level = 'city'"), countries).withColumn("caveats", note)
    return rows.select("geo_id", X.city_slug("geo_id").alias("file"), T.json_row(rows).alias("payload"))


def coverage_payload(locations: DataFrame) -> DataFrame:
    pack = lambda df, name, cols: df.agg(F.to_json(F.array_sort(F.collect_list(F.struct(*cols)))).alias(name))  # noqa: E731  bounded: 40 countries, a few levels
    return pack(coverage_by_country(locations), "coverage_by_country", ["country_code", "located", "share"]).crossJoin(pack(confidence_distribution(locations), "confidence_distribution", ["location_confidence", "n"]))


def summary_payload(measures: DataFrame, rankings: DataFrame, hubs: DataFrame) -> DataFrame:
    top = top_priority(rankings).agg(F.to_json(F.array_sort(F.collect_list(F.struct("rank", "geo_id", "opportunity_score")))).alias("top"))
    hub = hubs.agg(F.to_json(F.array_sort(F.collect_list(F.struct("subdomain", "country_code", "experts")))).alias("hubs"))
    return measures.crossJoin(top).crossJoin(hub)
