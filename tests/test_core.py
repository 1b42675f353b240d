"""Known cases of the analytics part, and all queries against DuckDB on the smallest tables."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from atlasmith import catalog, writes
from atlasmith.functions import expressions as X
from atlasmith.functions import stats
from atlasmith.operators import classify, locations, quality
from atlasmith.plans import gazetteer
from atlasmith.sources import tables as T

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


# Free text, country, city, level, confidence.
EXAMPLES = [
    ("Germany", "DE", None, "country", "high"), ("FR", "FR", None, "country", "high"), ("DE", "DE", None, "country", "low"), ("Deutschland", "DE", None, "country", "high"), ("United States of America", "US", None, "country", "high"),
    ("Berlin, Germany", "DE", "Berlin", "city", "high"), ("Toronto, Canada", "CA", "Toronto", "city", "high"), ("São Paulo, Brazil", "BR", "São Paulo", "city", "high"), ("Kyiv, Ukraine", "UA", "Kyiv", "city", "high"),
    ("Shenzhen, China", "CN", "Shenzhen", "city", "high"), ("Munich, DE", "DE", "Munich", "city", "high"), ("Bangalore, IN", "IN", "Bengaluru", "city", "high"), ("Tbilisi, Georgia", "GE", "Tbilisi", "city", "high"),
    ("Austin, TX", "US", "Austin", "city", "medium"), ("Cambridge, MA", "US", "Cambridge", "city", "medium"), ("San Francisco, CA", "US", "San Francisco", "city", "medium"), ("Atlanta, Georgia", "US", "Atlanta", "city", "medium"),
    ("Denver, CO", "US", "Denver", "city", "medium"), ("Ontario, Canada", "CA", None, "region", "medium"), ("Reykjavik", "IS", "Reykjavík", "city", "medium"), ("Amsterdam", "NL", "Amsterdam", "city", "medium"), ("東京", "JP", "Tokyo", "city", "medium"),
    ("Springfield", "US", "Springfield", "city", "low"), ("Georgia", "GE", None, "country", "low"), ("California", "US", None, "region", "low"), ("Scotland", "GB", None, "region", "low"), ("Virginia", "US", None, "region", "low"),
    ("Maryland, USA", "US", None, "region", "medium"), ("London / Paris", None, None, "unresolved", "unusable"), ("Berlin / Munich", "DE", "Berlin", "city", "medium"), ("Nowhereville, Germany", "DE", None, "country", "high"), ("Springfield, US", "US", "Springfield", "city", "medium"),
    ("Paris 🌍", "FR", "Paris", "city", "medium"), ("", None, None, "unresolved", "unusable"), ("  ", None, None, "unresolved", "unusable"), ("Earth", None, None, "unresolved", "unusable"), ("the internet", None, None, "unresolved", "unusable"),
    ("127.0.0.1", None, None, "unresolved", "unusable"), ("🌍", None, None, "unresolved", "unusable"), ("Milky Way", None, None, "unresolved", "unusable"), ("Xyzzy", None, None, "unresolved", "unusable"), (None, None, None, "unresolved", "unusable"),
]


def plain(x):
    if isinstance(x, float):
        return round(x, 3) + 0.0
    return x.isoformat()[:10] if hasattr(x, "isoformat") else x


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", ["event_grid", "repo_activity", "discovery_status", "normalize_run", "privacy_scan", "weighted_median", "scale_count", "percentile_rank", "taxonomy_matches", "retry_worklist", "upsert_latest"])
def test_query_equals_sql(spark, duck, name):
    df, want = catalog.QUERIES[name](spark, SF), duck.sql(catalog.ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    assert sorted(repr([plain(r[c]) for c in columns]) for r in df.collect()) == sorted(repr([plain(r[i]) for i in at]) for r in want.fetchall())


@pytest.mark.parametrize("name", ["normalization_summary", "stage_us_state_pair", "stage_multi", "read_dim_csv", "materialize_months", "pr_era_logic", "failed_minimums", "join_location_default", "semi_qualified_activity", "capped_supply", "momentum_direction", "top_quartile_share", "scenario_shift", "normalize_key", "clean_text", "match_name_terms", "stage_override", "dominant_city", "country_key_dim", "repo_maturity", "quality_gate", "check_rank_order", "merge_evidence", "check_rankings", "check_schema_contract", "comparison_summary", "country_detail", "summary_payload", "compare_payload", "coverage_payload", "subdomain_options", "geo_opportunity", "quality_exposure"])
def test_step_equals_sql(spark, duck, name):
    test_query_equals_sql(spark, duck, name)


def test_every_query_is_registered_with_a_twin_or_not():
    assert set(catalog.ORACLES) <= set(writes.QUERIES) and len(writes.QUERIES) > 220


@pytest.mark.parametrize(("opportunity", "confidence", "ok", "tier"), [(80, 75, True, "priority"), (75, 70, True, "priority"), (74.9, 90, True, "promising"), (90, 60, True, "promising"), (59, 90, True, "monitor"), (90, 44.9, True, "insufficient_data"), (90, 90, False, "insufficient_data"), (10, 45, True, "monitor")])
def test_tiers(spark, opportunity, confidence, ok, tier):
    df = spark.createDataFrame([(float(opportunity), float(confidence), ok)], "o double, c double, ok boolean")
    assert df.select(X.assign_tier("o", "c", "ok")).first()[0] == tier


def test_locations_answer_the_examples(spark):
    rows = [(str(i), "success", x[0]) for i, x in enumerate(EXAMPLES)]
    got = locations.normalize_run(spark.createDataFrame(rows, "actor_login string, fetch_status string, public_location_raw string"), gazetteer.dims(spark)).collect()
    found = {int(r["actor_login"]): (r["normalized_country_code"], r["normalized_city"], r["location_level"], r["location_confidence"]) for r in got}
    assert found == {i: x[1:] for i, x in enumerate(EXAMPLES)}


def test_statistics_edge_cases(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 1.0), ("b", 1.0), ("c", 1.0), ("c", 2.0), ("c", 2.0), ("c", 9.0)], "g string, v double")
    ranks = {(r["g"], r["v"]): r["pr"] for r in stats.percentile_rank(df, ["g"], "v", "pr").collect()}
    assert ranks == {("a", 5.0): 0.5, ("b", 1.0): 0.5, ("c", 1.0): 0.125, ("c", 2.0): 0.5, ("c", 9.0): 0.875}
    assert {r["g"]: r["m"] for r in stats.weighted_median(df.withColumn("w", F.lit(1.0)), ["g"], "v", "w", "m").collect()} == {"a": 5.0, "b": 1.0, "c": 2.0}
    assert {r["s"] for r in stats.minmax_to_100(df.where("g = 'b'"), ["g"], "v", "s").collect()} == {50.0}
    assert stats.percentile_rank(df.limit(0), ["g"], "v", "pr").count() == 0


def test_states_of_all_months_give_the_whole_rollups(spark):
    from atlasmith.operators import discovery
    from atlasmith.plans import adapters as A
    from atlasmith.plans.stages import stages

    s = stages(spark, SF)
    actors, repos = discovery.monthly_states(s.grid)
    months = [r["month"] for r in s.grid.select("month").distinct().collect()]
    columns = sorted(s.activity.columns)
    shown = lambda df, columns: sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    assert shown(discovery.roll_activity(actors, repos, months, A.TERMS), columns) == shown(s.activity, columns)
    columns = sorted(s.contributors.columns)
    assert shown(discovery.roll_contributors(actors, months, s.discovered, A.DOMAIN), columns) == shown(s.contributors, columns)
    assert discovery.roll_activity(actors, repos, [190001], A.TERMS).count() == 0


def test_statistics_reject_what_has_no_answer(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 2.0, 0.0), ("b", 3.0, 0.0)], "g string, v double, w double")
    assert stats.weighted_median(df.where("g = 'a'"), ["g"], "v", "w", "m").first()["m"] == 1.0
    with pytest.raises(Exception, match="must not all be zero"):
        stats.weighted_median(df, ["g"], "v", "w", "m").collect()
    with pytest.raises(Exception, match="must not be negative"):
        stats.weighted_median(df.withColumn("w", F.col("w") - 0.5), ["g"], "v", "w", "m").collect()
    with pytest.raises(ValueError, match="within"):
        stats.percentiles(df, ["g"], "v", {"p": 1.5})
    with pytest.raises(Exception, match="negative"):
        stats.scale_counts(df.withColumn("v", -F.col("v")), ["g"], {"s": "v"}).collect()
    blend = lambda high: df.select(X.weighted_blend({"a": F.col("v") * high, "b": F.lit(50.0)}, {"a": 0.5, "b": 0.5}).alias("x"))
    assert [r["x"] for r in blend(10).collect()] == [30.0, 35.0, 40.0]
    for factor in (50, -1):
        with pytest.raises(Exception, match="within 0 and 100"):
            blend(factor).collect()
    with pytest.raises(ValueError, match="positive"):
        X.saturating_ratio("v", 0)
    with pytest.raises(Exception, match="must not be negative"):
        df.select(X.saturating_ratio(-F.col("v"), 2)).collect()


def test_weighted_blend_query_cuts_no_part_off(spark):
    """Each size counts in full, the largest too: what the blend adds for one more is the same all over the table."""
    found = catalog.QUERIES["weighted_blend"](spark, SF).join(spark.read.parquet(f"{SF}/part.parquet"), "p_partkey").select("p_size", "x").collect()
    assert max(r["p_size"] for r in found) > 100 / 3
    assert all(abs(r["x"] - 1.6 * r["p_size"]) < 1e-9 for r in found)


def test_weighted_blend_takes_parts_up_to_the_bound_and_rejects_those_beyond(spark):
    """The query's second part goes as far as the reference lets one; three times the size is out of its bounds."""
    part = spark.read.parquet(f"{SF}/part.parquet")
    blend = lambda factor: part.select(X.weighted_blend({"a": F.col("p_size").cast("double"), "b": F.col("p_size") * factor}, {"a": 0.4, "b": 0.6}).alias("x"))
    assert part.agg(F.max("p_size")).first()[0] * 2 == 100 and max(r["x"] for r in blend(2.0).collect()) == 80.0
    with pytest.raises(Exception, match="within 0 and 100"):
        blend(3.0).collect()


def test_statistics_in_ranges_equal_brute_force(spark):
    """A group with nearly all rows, more distinct values than buckets, ties, nulls, a group of nulls and one of one value."""
    rng = np.random.default_rng(5)
    rows = [("hot", float(x)) for x in np.exp(rng.normal(0, 4, 3000))] + [("hot", 1.5)] * 400 + [("hot", None)] * 7 + [("one", -2.0)] * 3 + [("none", None)] * 2
    df = spark.createDataFrame(rows, "g string, v double").withColumn("w", F.when(F.col("g") == "one", 1).otherwise(F.coalesce(F.abs(F.hash("v")) % 7, F.lit(1))).cast("double") / 8)
    for groups in (["g"], []):
        found = {tuple(r[g] for g in groups): r for r in stats.percentiles(df, groups, "v", {"a": 0, "m": 0.5, "p": 0.973, "z": 1}).collect()}
        ranks = stats.percentile_rank(df, groups, "v", "pr").collect()
        medians = {tuple(r[g] for g in groups): r["m"] for r in stats.weighted_median(df.where("v is not null"), groups, "v", "w", "m").collect()}
        weights = df.where("v is not null").collect()
        for key in found:
            mine = [r for r in ranks if tuple(r[g] for g in groups) == key]
            values = np.array([r["v"] for r in mine if r["v"] is not None])
            assert np.allclose([found[key][n] for n in "ampz"], np.quantile(values, [0, 0.5, 0.973, 1]), rtol=1e-12)
            plain_values = np.array([-np.inf if r["v"] is None else r["v"] for r in mine])
            want = [((plain_values < x).sum() + (plain_values == x).sum() / 2) / len(mine) for x in plain_values]
            assert np.allclose([r["pr"] for r in mine], want, rtol=1e-12)
            pairs = sorted((r["v"], r["w"]) for r in weights if tuple(r[g] for g in groups) == key)
            upto = np.cumsum([w for _, w in pairs])
            assert medians[key] == next(v for (v, _), u in zip(pairs, upto, strict=True) if u * 2 >= upto[-1])
    assert stats.percentiles(df.limit(0), ["g"], "v", {"m": 0.5}).count() == 0
    assert stats.percentiles(df.limit(0), [], "v", {"m": 0.5}).first()["m"] is None


PHRASES = [
    ("red bolt", "a Red-Bolt", True), ("red bolt", "red  . bolt!", True), ("red bolt", "redbolt", False), ("red bolt", "red big bolt", False), ("red bolt", "bolt red", False), ("red bolt", "xred bolt", False), ("red bolt", "red bolts", False),
    ("red bolt", "red red bolt", True), ("c++", "in C++.", True), ("c++", "c++11", False), ("c++", "objective-c++", True), ("c++", "c+ +", False), (".net", "the .NET core", True), ("#tag", "a#tag", False), ("#tag", "+#tag", True),
    ("機器學習", "我愛機器學習", True), ("機器學習", "機器 學習", False), ("學習 2", "學習_2", True), ("é", "café", False), ("é", "é e", True), ("naïve bayes", "Naïve\u00a0Bayes", True), ("...", "a ... b", False), ("a a", "a a a", True), ("x", None, False),
]


def test_phrases_equal_the_bounded_pattern(spark):
    """Terms of any script, separators, symbols and bounds; the expected answer is that of the pattern with lookarounds."""
    import re

    for term, text, expected in PHRASES:
        words = [re.escape(w) for w in re.split(r"[\s\-_./]+", term.lower()) if w]
        found = bool(words) and text is not None and re.search(r"(?<![a-z0-9])" + r"[\s\-_./]+".join(words) + r"(?![a-z0-9])", text.lower()) is not None
        assert found is expected, (term, text)
    meta = spark.createDataFrame([(f"o/r{i}", text) for i, (_, text, _) in enumerate(PHRASES)], "repo_name string, description string")
    terms = spark.createDataFrame([("d", f"s{i}", "term", term) for i, (term, _, _) in enumerate(PHRASES)], "domain_id string, subdomain_id string, kind string, item string")
    got = {(r["repo_name"][3:], r["subdomain_id"][1:]) for r in classify.match_description_terms(meta, terms).collect()}
    assert [(str(i), str(i)) in got for i in range(len(PHRASES))] == [e for *_, e in PHRASES]
    assert not any("rlike" in x.lower() for x in classify.match_description_terms(meta, terms)._jdf.queryExecution().optimizedPlan().toString().splitlines())


def test_phrases_need_word_bounds(spark):
    meta = spark.createDataFrame([("o/a", "a maniac of basalt", []), ("o/b", "IaC with salt", []), ("o/c", None, None)], "repo_name string, description string, topics array<string>")
    terms = spark.createDataFrame([("d", "s", "term", "iac"), ("d", "s", "term", "salt")], "domain_id string, subdomain_id string, kind string, item string")
    assert sorted((r["repo_name"], r["item"]) for r in classify.match_description_terms(meta, terms).collect()) == [("o/b", "iac"), ("o/b", "salt")]


@pytest.mark.parametrize(("name", "about", "reason"), [("awesome-x", "", "awesome_list"), ("cse110-lab", "", "student_assignment"), ("cve-2021-44228", "", None), ("terraform-docs", "", None), ("docs", "", "documentation_only"), ("x", "My dotfiles", "dotfiles"), ("x", "A crash course", "tutorial")])
def test_hard_exclusions(spark, name, about, reason):
    df = spark.createDataFrame([(f"o/{name}", about, "MIT", None)], "repo_name string, description string, license_spdx_id string, single_actor_event_share double")
    df = df.withColumns({c: F.lit(False) for c in ("is_fork", "is_archived", "is_disabled")})
    assert df.select(classify.hard_exclusions()).first()[0] == ([reason] if reason else [])


def test_privacy_patterns(spark):
    lines = ["a@b.org", "https://github.com/someone", "https://github.com/someone/repo", "actor_login: x", "ghp_" + "a" * 24, "clean"]
    df = spark.createDataFrame([("f", "\n".join(lines))], "file string, text string")
    assert sorted(r["pattern"] for r in quality.privacy_scan(df).collect()) == ["API token", "actor_login field", "email address", "github profile URL"]


def test_privacy_query_reports_profile_urls(spark, tmp_path):
    texts = [(1, "see https://github.com/octocat\nand https://github.com/octo/repo"), (2, "http://www.github.com/some-one/ wrote"), (3, "nothing")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, "<a href='https://github.com/octocat'>")], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = catalog.QUERIES["privacy_scan"](spark, str(tmp_path)).where("pattern = 'github profile URL'")
    assert sorted((r["file"], r["n"]) for r in got.collect()) == [("documents/1", 1), ("documents/2", 1), ("pages/7", 1)]
