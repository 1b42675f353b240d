"""Repositories against a keyword taxonomy, as joins.

taxonomy: (domain_id, subdomain_id, kind, item); kinds topic, term, negative, signal, language.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasmith import settings as C
from atlasmith.functions import expressions as X

SIGNALS = ("has_readme", "has_contributing", "has_code_of_conduct", "has_ci", "has_tests_signal")


def _found(df: DataFrame, kind: str, item: str | Column = "item") -> DataFrame:
    return df.select("repo_name", "domain_id", "subdomain_id", F.lit(kind).alias("kind"), (F.col(item) if isinstance(item, str) else item).alias("item")).distinct()


def match_topics(metadata: DataFrame, taxonomy: DataFrame) -> DataFrame:
    topics = metadata.select("repo_name", F.explode("topics").alias("topic")).select("repo_name", X.normalize_token("topic").alias("token"))
    return _found(topics.join(taxonomy.where("kind = 'topic'").withColumn("token", X.normalize_token("item")), "token"), "topic")


def tokens(text: str | Column) -> Column:
    """The tokens of a text in order: runs of a-z and 0-9, and every other character that separates no words as one of its own.

    (token, glued, word_before, word_after): whether it follows the token before it directly, and whether a letter
    or digit stands right before or after it.
    """
    clean = F.regexp_replace(F.lower(F.col(text) if isinstance(text, str) else text), r"(?U)[\s\-_./]+", " ")
    pieces = F.regexp_extract_all(clean, F.lit("[a-z0-9]+|[^a-z0-9]"), F.lit(0))
    is_word = lambda x: F.coalesce(((x >= "0") & (x < ":")) | ((x >= "a") & (x < "{")), F.lit(False))
    beside = lambda i, step: F.when(i + step >= 0, F.get(pieces, i + step))
    placed = lambda x, i: F.struct(x.alias("token"), F.coalesce(beside(i, -1) != " ", F.lit(False)).alias("glued"), is_word(beside(i, -1)).alias("word_before"), is_word(beside(i, 1)).alias("word_after"))
    return F.filter(F.transform(pieces, placed), lambda t: t["token"] != " ")


def _phrases(texts: DataFrame, terms: DataFrame, kind: str) -> DataFrame:
    """Terms that stand in (repo_name, text), by a join over the places of tokens.

    A term's tokens meet the same tokens of texts; where all of them start at one place, and are glued or apart as in
    the term, the term stands. Letters and digits right before or after it rule it out. A term of separators alone stands nowhere.
    """
    items = terms.select("item").distinct().withColumn("w", tokens("item"))
    wanted = items.select("item", F.size("w").alias("n"), F.posexplode("w").alias("i", "w")).select("item", "n", "i", F.col("w.token").alias("token"), F.col("w.glued").alias("glue"))
    there = texts.where("text is not null").select("repo_name", F.posexplode(tokens("text")).alias("pos", "t")).select("repo_name", "pos", "t.*")
    fits = F.when(F.col("i") == 0, ~F.col("word_before")).otherwise(F.col("glued") == F.col("glue")) & ((F.col("i") < F.col("n") - 1) | ~F.col("word_after"))
    met = there.join(wanted, "token").where(fits).groupBy("repo_name", "item", "n", (F.col("pos") - F.col("i")).alias("start")).agg(F.count("*").alias("met"))
    return _found(met.where("met = n").select("repo_name", "item").distinct().join(terms, "item"), kind)


def match_description_terms(metadata: DataFrame, taxonomy: DataFrame) -> DataFrame:
    return _phrases(metadata.select("repo_name", F.col("description").alias("text")), taxonomy.where("kind = 'term'"), "term")


def match_name_terms(metadata: DataFrame, taxonomy: DataFrame) -> DataFrame:
    return _phrases(metadata.select("repo_name", X.repo_short_name("repo_name").alias("text")), taxonomy.where("kind = 'term'"), "name")


def negative_terms(metadata: DataFrame, taxonomy: DataFrame) -> DataFrame:
    text = F.concat_ws(" ", X.repo_short_name("repo_name"), "description", F.concat_ws(" ", "topics"))
    return _phrases(metadata.select("repo_name", text.alias("text")), taxonomy.where("kind = 'negative'"), "negative")


def content_signals(metadata: DataFrame, taxonomy: DataFrame) -> DataFrame:
    there = [c for c in SIGNALS if c in metadata.columns]
    long = metadata.select("repo_name", F.explode(F.array(*(F.struct(F.lit(c).alias("item"), F.col(c).alias("on")) for c in there))).alias("s")).where("s.on").select("repo_name", "s.item")
    return _found(long.join(taxonomy.where("kind = 'signal'"), "item"), "file")


def language_hint(metadata: DataFrame, taxonomy: DataFrame) -> DataFrame:
    lang = metadata.select("repo_name", X.normalize_token("primary_language").alias("token"))
    return _found(lang.join(taxonomy.where("kind = 'language'").withColumn("token", X.normalize_token("item")), "token"), "language")


def all_matches(metadata: DataFrame, taxonomy: DataFrame) -> DataFrame:
    parts = [f(metadata, taxonomy) for f in (match_topics, match_description_terms, match_name_terms, negative_terms, content_signals, language_hint)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def subdomain_score(matches: DataFrame, weights: dict = C.CLASSIFICATION) -> DataFrame:
    """Score and number of kinds of positive evidence per repository and subdomain."""
    kinds = ("topic", "term", "name", "file", "language")
    n = {k: F.count_if(F.col("kind") == k) for k in (*kinds, "negative")}
    score = sum((n[k] * weights[k] for k in kinds), F.lit(0.0)) - n["negative"] * weights["negative"]
    return matches.groupBy("repo_name", "domain_id", "subdomain_id").agg(score.alias("score"), F.count_distinct(F.when(F.col("kind") != "negative", F.col("kind"))).alias("kinds"))


def license_recognized(spdx: str | Column) -> Column:
    c = F.col(spdx) if isinstance(spdx, str) else spdx
    return F.coalesce(F.upper(c).isin(*(x.upper() for x in C.LICENSES)), F.lit(False))


def hard_exclusions(share: str = "single_actor_event_share", flags: frozenset[str] = C.EXCLUSION_FLAGS) -> Column:
    """Reasons in order, each once; only those whose flag is on. A null share can't dominate."""
    name, about = F.lower(X.repo_short_name("repo_name")), F.lower(F.coalesce("description", F.lit("")))
    tests = [
        ("fork", F.col("is_fork")), ("archived", F.col("is_archived")), ("disabled", F.col("is_disabled")),
        ("license", ~license_recognized("license_spdx_id")), ("single_actor", F.coalesce(F.col(share) > C.DOMINANCE, F.lit(False))),
        *((tag, name.rlike(p)) for tag, p in C.NAME_EXCLUSIONS), *((tag, about.rlike(p)) for tag, p in C.DESCRIPTION_EXCLUSIONS),
    ]
    return F.array_distinct(F.array_compact(F.array(*(F.when(test, F.lit(tag)) for tag, test in tests if tag in flags))))


def join_single_actor_share(metadata: DataFrame, activity: DataFrame) -> DataFrame:
    return metadata.join(activity.select("repo_name", "single_actor_event_share"), "repo_name", "left")


def subdomain_grade(weights: dict = C.CLASSIFICATION) -> Column:
    """2 accepted, 1 borderline, 0 neither, of a scored subdomain."""
    return F.when((F.col("score") >= weights["accept"]) & (F.col("kinds") >= weights["kinds"]), 2).when(F.col("score") >= weights["borderline"], 1).otherwise(0)


def best_subdomains(scores: DataFrame, weights: dict = C.CLASSIFICATION) -> DataFrame:
    """Per repository the best grade and score, and all its subdomains (a few at most) by falling score."""
    return scores.withColumn("grade", subdomain_grade(weights)).groupBy("repo_name").agg(
        F.max("grade").alias("grade"), F.max("score").alias("best"),
        F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("order"), "subdomain_id", "score", "grade"))).alias("all"),
    )


def judged(metadata: DataFrame, activity: DataFrame, best: DataFrame, flags: frozenset[str] = C.EXCLUSION_FLAGS) -> DataFrame:
    """Every repository with its exclusions and grade; an excluded one has grade 0."""
    df = join_single_actor_share(metadata, activity).withColumn("exclusions", hard_exclusions(flags=flags)).join(best, "repo_name", "left")
    return df.withColumn("grade", F.when(F.size("exclusions") > 0, 0).otherwise(F.coalesce("grade", F.lit(0))))


def classification_decision() -> Column:
    return F.when(F.col("grade") == 2, "accepted").when(F.col("grade") == 1, "borderline").otherwise("rejected")


def chosen_order() -> Column:
    """The subdomains of the repository's own grade, by falling score."""
    own = F.transform(F.filter("all", lambda x: x["grade"] == F.col("grade")), lambda x: x["subdomain_id"])
    return F.when(F.col("grade") > 0, own).otherwise(F.array().cast("array<string>"))


def classification_score() -> Column:
    """The highest score among the chosen subdomains (of all, if none is), 0-100; 0 if excluded."""
    chosen = F.transform(F.filter("all", lambda x: (F.col("grade") > 0) & (x["grade"] == F.col("grade"))), lambda x: x["score"])
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.when(F.size("exclusions") > 0, 0.0).otherwise(F.coalesce(F.array_max(chosen), "best", F.lit(0.0)))))


def classify_run(metadata: DataFrame, activity: DataFrame, taxonomy: DataFrame, domain: str, weights: dict = C.CLASSIFICATION, flags: frozenset[str] = C.EXCLUSION_FLAGS) -> DataFrame:
    """The whole classification, one row per repository."""
    matches = all_matches(metadata, taxonomy.where(F.col("domain_id") == domain))
    # A repository has a few subdomains at most: their evidence is one small array.
    prefixed = F.when(F.col("kind") == "name", F.concat(F.lit("name:"), "item")).when(F.col("kind") == "language", F.concat(F.lit("language:"), "item")).when(F.col("kind") == "negative", F.concat(F.lit("negative_term:"), "item")).otherwise(F.col("item"))
    evidence = matches.groupBy("repo_name").agg(F.collect_set(F.struct("subdomain_id", "kind", prefixed.alias("item"))).alias("evidence"))
    rows = judged(metadata, activity, best_subdomains(subdomain_score(matches, weights), weights), flags).withColumn("listed", chosen_order()).join(evidence, "repo_name", "left")

    def listed(*kinds: str) -> Column:
        wanted = F.filter(F.coalesce("evidence", F.array()), lambda x: x["kind"].isin(*kinds) & ((F.size("listed") == 0) | F.array_contains("listed", x["subdomain_id"])))
        return F.array_sort(F.array_distinct(F.transform(wanted, lambda x: x["item"])))

    return rows.select(
        "repo_name", F.lit(domain).alias("domain_id"), F.col("listed").alias("subdomains"), classification_score().alias("classification_score"), classification_decision().alias("classification_status"),
        listed("topic").alias("evidence_topics"), listed("term", "name").alias("evidence_terms"), listed("file", "language").alias("evidence_files"),
        F.array_union("exclusions", listed("negative")).alias("negative_evidence"),
    )


def classification_counts(classification: DataFrame) -> DataFrame:
    is_ = lambda s: F.count_if(F.col("classification_status") == s).alias(s)
    return classification.agg(F.count("*").alias("total"), is_("accepted"), is_("rejected"), is_("borderline"))
