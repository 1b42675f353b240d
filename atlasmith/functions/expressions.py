"""Column expressions: discovery predicates, strings, dates and signals."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasmith import settings as C


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Payload and event rules


#: What counts in a payload; an object in place of a scalar is read as its text.
PAYLOAD = "action string, distinct_size string, size string, pull_request struct<merged: string>"


def payload_extract(events: DataFrame, payload: str = "payload") -> DataFrame:
    """events with action, pr_merged (strings), push_distinct_size and push_size (longs) of a JSON payload; objects count as null.

    The payload is parsed once per event: the struct is a column of its own, and its fields are taken from that.
    """
    scalar = lambda value: F.when(~value.startswith("{") & ~value.startswith("["), value)
    x = F.col("__payload")
    return events.withColumn("__payload", F.from_json(payload, PAYLOAD)).withColumns({
        "action": scalar(x["action"]), "pr_merged": scalar(x["pull_request"]["merged"]),
        "push_distinct_size": scalar(x["distinct_size"]).try_cast("long"), "push_size": scalar(x["size"]).try_cast("long"),
    }).drop("__payload")


def pr_closed() -> Column:
    return (F.col("type") == "PullRequestEvent") & F.col("action").isin("closed", "merged")


def pr_merged() -> Column:
    """Both payload eras: a merged action, or a closed one with the flag."""
    return (F.col("type") == "PullRequestEvent") & ((F.col("action") == "merged") | ((F.col("action") == "closed") & (F.col("pr_merged") == "true")))


def push_commits() -> Column:
    return F.when(F.col("type") == "PushEvent", F.coalesce("push_distinct_size", "push_size", F.lit(0))).otherwise(0)


def bot_label(login: str | Column, patterns: tuple = C.BOT_PATTERNS) -> Column:
    """'<kind>:<pattern>' of the first rule that matches the lower-cased login; null for humans."""
    x = F.lower(_col(login))
    tests = {"suffix": x.endswith, "exact": lambda p: x == p, "substring": x.contains, "regex": x.rlike}
    return F.coalesce(*(F.when(tests[kind](p.lower() if kind != "regex" else p), F.lit(f"{kind}:{p}")) for kind, p in patterns))


def is_bot(label: str | Column) -> Column:
    return _col(label).isNotNull()


def terms_pattern(terms: list[str]) -> str:
    """Bounded alternation without lookaround."""
    escaped = "|".join(re.sub(r"([^a-z0-9])", r"\\\1", t) for t in terms)
    return f"(^|[^a-z0-9])({escaped})($|[^a-z0-9])"


def taxonomy_name_match(repo_name: str | Column, terms: list[str]) -> Column:
    return F.lower(_col(repo_name)).rlike(terms_pattern(terms)) if terms else F.lit(False)


def owner_of(repo: str | Column) -> Column:
    return F.coalesce(F.get(F.split(_col(repo), "/"), F.lit(0)), F.lit(""))


def short_name_of(repo: str | Column) -> Column:
    return F.coalesce(F.get(F.split(_col(repo), "/"), F.lit(1)), F.lit(""))


def repo_short_name(repo: str | Column) -> Column:
    """What follows the first slash; the whole string if there is none."""
    return F.regexp_replace(_col(repo), "^[^/]*/", "")


def weighted_activity(columns: dict[str, str | Column], weights: dict[str, int] = C.EVENT_WEIGHTS) -> Column:
    return reduce(lambda a, b: a + b, (_col(c).cast("double") * weights[name] for name, c in columns.items()))


def safe_share(part: str | Column, whole: str | Column) -> Column:
    return F.coalesce(F.try_divide(_col(part), _col(whole)), F.lit(0.0))


def failed_minimums(minimums: dict[str, int] = C.MINIMUMS) -> Column:
    labels = (F.when(F.col(name) < least, F.lit(f"{name}<{least}")) for name, least in minimums.items())
    return F.nullif(F.concat_ws(";", *labels), F.lit(""))


def candidate_floor() -> Column:
    return F.col("is_taxonomy_candidate") & (F.col("unique_human_contributors") >= C.CANDIDATE_MIN_HUMANS) & (F.col("meaningful_events") >= C.CANDIDATE_MIN_EVENTS)


def discovery_status(failed: Column, match: Column, floor: Column) -> Column:
    return F.when(failed.isNull(), "accepted").when(~match, "not_candidate").when(~floor, "below_floor").otherwise("excluded")


def exclusion_reason(failed: Column, match: Column, floor: Column) -> Column:
    return F.when(failed.isNull(), F.lit(None)).when(~match, F.lit("no_taxonomy_name_match")).when(~floor, F.lit("below_candidate_activity_floor")).otherwise(failed)


def valid_login(login: str | Column) -> Column:
    return _col(login).rlike(r"^[A-Za-z0-9](?:[A-Za-z0-9-]{0,38})$")


# Strings


def normalize_token(c: str | Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(_col(c)), r"[\s\-_./]+", "-"), F.lit("-"))


def term_pattern(term: str) -> str:
    """A phrase of the words of term with separators between, not inside longer words (no lookaround)."""
    words = [re.sub(r"([^a-z0-9])", r"\\\1", w) for w in re.split(r"[\s\-_./]+", term.lower()) if w]
    return r"(^|[^a-z0-9])" + r"[\s\-_./]+".join(words) + r"($|[^a-z0-9])"


def comma_segments(c: str | Column) -> Column:
    return F.filter(F.transform(F.split(_col(c), ","), lambda x: F.trim(x)), lambda x: x != "")


def split_multi_location(c: str | Column) -> Column:
    return F.filter(F.split(_col(c), r"(?i)\s*(?:/|\||•|·|;|&| and )\s*"), lambda x: x != "")


def city_geo_id(country: str | Column, city: str | Column) -> Column:
    return F.concat(_col(country), F.lit("-"), F.replace(F.lower(_col(city)), F.lit(" "), F.lit("-")))


def city_slug(geo_id: str | Column) -> Column:
    return F.translate(F.lower(_col(geo_id)), "/ ", "--")


def prs_or_reviews() -> Column:
    return F.col("pull_requests_opened") + F.col("reviews_submitted")


def camel_case(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(x.title() for x in rest)


def display_name(country: str | Column, country_name: str | Column, city: str | Column) -> Column:
    return F.coalesce(_col(city), _col(country_name), _col(country), F.lit("Unknown"))


def subdomain_display(subdomain: str | Column, known: str | Column | None = None) -> Column:
    fallback = F.initcap(F.replace(_col(subdomain), F.lit("_"), F.lit(" ")))
    return fallback if known is None else F.coalesce(_col(known), fallback)


# Dates and numbers


def month_of(c: str | Column) -> Column:
    return (F.year(_col(c)) * 100 + F.month(_col(c))).cast("int")


def month_bounds(c: str | Column) -> tuple[Column, Column]:
    return F.trunc(_col(c), "MM"), F.last_day(_col(c))


def previous_month(c: str | Column) -> Column:
    return F.add_months(F.trunc(_col(c), "MM"), -1)


def days_since(end: Column, c: str | Column) -> Column:
    return F.datediff(end, _col(c))


def interval_overlap(first: str | Column, last: str | Column, start: Column, end: Column) -> Column:
    return (_col(first) <= end) & (_col(last) >= start)


def review_ratio(reviews: str | Column, opened: str | Column, full: float = C.REVIEW_RATIO_FULL) -> Column:
    return F.least(_col(reviews).cast("double") / F.greatest(_col(opened).cast("double"), F.lit(1.0)), F.lit(full)) / full * 100


def evidence_count(*arrays: str | Column) -> Column:
    return reduce(lambda a, b: a + b, (F.coalesce(F.size(F.coalesce(_col(a), F.array())), F.lit(0)) for a in arrays))


def round4(c: str | Column) -> Column:
    return F.round(_col(c), 4)


def confidence_band(c: str | Column) -> Column:
    return F.when(_col(c) >= 70, "high").when(_col(c) >= 40, "medium").otherwise("low")


def is_low_confidence(tier: str | Column, score: str | Column) -> Column:
    return (_col(tier) == "insufficient_data") | (confidence_band(score) == "low")


def null_or_positive(c: str | Column) -> Column:
    """100 for true, 0 for false and for signals that were never fetched."""
    return F.when(F.coalesce(_col(c), F.lit(False)), 100.0).otherwise(0.0)


def saturating_ratio(count: str | Column, minimum: float, multiple: float = C.SATURATION) -> Column:
    """0-1, full at minimum times multiple; an error where it is read, if a count is negative."""
    if minimum <= 0:
        raise ValueError(f"minimum must be positive, is {minimum}")
    n = _col(count).cast("double")
    return F.when(n < 0, F.raise_error(F.lit("counts must not be negative")).cast("double")).otherwise(F.least(n / (minimum * multiple), F.lit(1.0)))


def weighted_blend(parts: dict[str, str | Column], weights: dict[str, float]) -> Column:
    """Weighted sum of 0-100 columns; names and weights must agree. An error where it is read, if a part is out of bounds."""
    if set(parts) != set(weights) or abs(sum(weights.values()) - 1) > 1e-9:
        raise ValueError(f"parts {sorted(parts)} don't agree with weights {weights}")
    columns = {n: _col(c) for n, c in parts.items()}
    out = reduce(lambda a, b: a | b, ((c < -1e-9) | (c > 100 + 1e-9) for c in columns.values()))
    total = reduce(lambda a, b: a + b, (c * weights[name] for name, c in columns.items()))
    # Clamped for what floating-point sums leave over the bounds.
    return F.when(out, F.raise_error(F.lit("parts must be within 0 and 100")).cast("double")).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(100.0), total)))


def assign_tier(opportunity: str | Column, confidence: str | Column, samples_ok: str | Column, tiers: dict = C.TIERS) -> Column:
    o, c = _col(opportunity), _col(confidence)
    return (
        F.when(~_col(samples_ok) | (c < tiers["insufficient_below"]), "insufficient_data")
        .when((o >= tiers["priority"][0]) & (c >= tiers["priority"][1]), "priority")
        .when((o >= tiers["promising"][0]) & (c >= tiers["promising"][1]), "promising").otherwise("monitor")
    )
