"""Free-text locations to countries and cities, as joins over distinct strings.

Dimensions are inputs: country(key, code, name), us_state(key, code), region(key, country),
city(key, name, country_code, admin1, population, latitude, longitude), alias(alias, code, city, level),
override(raw_location, code, city, level). Every stage proposes an answer; the first stage in order
that has one wins. Each distinct string is resolved once.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as P

from atlasmith import settings as C
from atlasmith.functions import expressions as X
from atlasmith.sources import tables as T


def _keys(texts: pd.Series) -> pd.Series:
    def key(x: str | None) -> str | None:
        if x is None:
            return None
        plain = "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))
        return " ".join(plain.casefold().split())

    return texts.map(key)


def _cleaned(texts: pd.Series) -> pd.Series:
    def clean(x: str | None) -> str | None:
        if x is None:
            return None
        kept = "".join(c for c in unicodedata.normalize("NFKC", x) if unicodedata.category(c) not in ("So", "Sk", "Cs", "Co"))
        return " ".join(kept.split()).strip(" ,;-·|/")

    return texts.map(clean)


def normalize_key(c: str | Column) -> Column:
    """NFKD without combining marks, case-folded, white space collapsed. Spark has no NFKD: an Arrow UDF."""
    return F.pandas_udf(_keys, P.StringType())(F.col(c) if isinstance(c, str) else c)


def clean_text(c: str | Column) -> Column:
    """NFKC without symbols, white space collapsed, separators stripped."""
    return F.pandas_udf(_cleaned, P.StringType())(F.col(c) if isinstance(c, str) else c)


@dataclass
class Dims:
    country: DataFrame
    us_state: DataFrame
    region: DataFrame
    city: DataFrame
    alias: DataFrame
    override: DataFrame


def country_key_dim(countries: DataFrame, informal: DataFrame | None = None) -> DataFrame:
    """(key, code, name) from (code, name, forms array): the first source wins for a key."""
    own = countries.select("code", "name", F.posexplode(F.concat(F.array("name", "code"), "forms")).alias("pos", "form"))
    if informal is not None:
        own = own.unionByName(informal.select("code", "name", F.lit(1000).alias("pos"), F.col("form")))
    keyed = own.withColumn("key", normalize_key("form"))
    first = F.row_number().over(Window.partitionBy("key").orderBy("pos", "code"))
    return keyed.withColumn("r", first).where("r = 1").select("key", "code", "name")


def city_key_dim(cities: DataFrame) -> DataFrame:
    """A row per name and alternate name (three letters or more, or not Latin) of (name, alternates array, ...)."""
    names = F.array_distinct(F.concat(F.array("name"), F.filter("alternates", lambda x: (F.char_length(x) >= 3) | x.rlike(r"[぀-鿿가-힯]"))))
    return cities.withColumn("form", F.explode(names)).withColumn("key", normalize_key("form")).drop("form", "alternates").dropDuplicates(["key", "name", "country_code", "admin1"])


def dominant_city(city: DataFrame) -> DataFrame:
    """Per key the largest city, whether it dominates, and the number of candidates."""
    by = Window.partitionBy("key").orderBy(F.desc("population"), "country_code", "admin1", "name")
    ranked = city.withColumn("r", F.row_number().over(by)).where("r <= 2")
    two = ranked.groupBy("key").agg(*(F.max_by(F.struct("name", "country_code", "population", "latitude", "longitude"), F.when(F.col("r") == r, 1)).alias(f"c{r}") for r in (1, 2)))
    counted = two.join(city.groupBy("key").agg(F.count("*").alias("n")), "key")
    runner = F.coalesce("c2.population", F.lit(0))
    dominant = (F.col("c1.population") >= C.DOMINANT_POPULATION) & ((runner <= 0) | (F.col("c1.population") >= C.DOMINANT_RATIO * runner))
    return counted.select("key", F.col("c1").alias("top"), dominant.alias("dominant"), "n")


def region_country(dims: Dims) -> DataFrame:
    """(key, country): US states first, then the curated regions."""
    both = dims.us_state.select("key", F.lit("US").alias("country"), F.lit(0).alias("o")).unionByName(dims.region.select("key", "country", F.lit(1).alias("o")))
    return both.groupBy("key").agg(F.min_by("country", "o").alias("country"))


def _answer(code: Column, city: Column | None, level: str, confidence: Column | str, method: str, reason: Column | None = None, lat: Column | None = None, lon: Column | None = None) -> Column:
    none = F.lit(None)
    return F.struct(
        code.alias("code"), (none if city is None else city).cast("string").alias("city"), (none if lat is None else lat).cast("double").alias("latitude"),
        (none if lon is None else lon).cast("double").alias("longitude"), F.lit(level).alias("level"),
        (F.lit(confidence) if isinstance(confidence, str) else confidence).alias("confidence"), F.lit(method).alias("method"),
        (none if reason is None else reason).cast("string").alias("reason"),
    )


def look(df: DataFrame, dim: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """df with the dimension's value of its key, a null where it has none."""
    one = dim.groupBy("key").agg(F.first(value, ignorenulls=True).alias(name)).withColumnRenamed("key", key)
    return df.join(one, key, "left")


def dim_override_join(df: DataFrame, dims: Dims) -> DataFrame:
    """df with over, the curated answer for whole_key."""
    return look(df, dims.override.select(normalize_key("raw_location").alias("key"), F.struct("code", "city", "level").alias("v")), "whole_key", "v", "over")


def dim_alias_join(df: DataFrame, dims: Dims) -> DataFrame:
    """df with also, the answer of the alias that equals whole_key."""
    return look(df, dims.alias.select(normalize_key("alias").alias("key"), F.struct("code", "city", "level").alias("v")), "whole_key", "v", "also")


#: Which of a text's keys a dimension is asked for.
ROLES = ("whole", "head", "middle", "last")


def keyed(texts: DataFrame) -> DataFrame:
    """(text, segments, several, role, key) of cleaned strings: the whole text, and its first, last but one and last segment if it has several."""
    seg = F.col("segments")
    several = F.size(seg) >= 2
    forms = {"whole": F.col("text"), "head": F.get(seg, F.lit(0)), "middle": F.when(F.size(seg) >= 3, F.element_at(seg, -2)), "last": F.when(several, F.element_at(seg, -1))}
    each = F.explode(F.array(*(F.struct(F.lit(r).alias("role"), forms[r].alias("form")) for r in ROLES))).alias("x")
    rows = texts.withColumn("segments", X.comma_segments("text")).select("text", "segments", several.alias("several"), each)
    return rows.select("text", "several", "x.role", normalize_key("x.form").alias("key"))


def pivoted(texts: DataFrame, dims: Dims) -> DataFrame:
    """A row per text with what every dimension says of its keys, for the stages to choose from.

    Keys of all roles are one table; each dimension joins it once, and one grouping puts the roles back beside each other.
    City candidates of a text's first segment, in the state, country or region that another segment names, are one more join.
    """
    rows = keyed(texts)
    for name, dim, value in (("country", dims.country, "code"), ("state", dims.us_state, "code"), ("region", region_country(dims), "country")):
        rows = look(rows, dim, "key", value, name)
    curated = lambda role, name, dim, key: (dim.select(normalize_key(key).alias("key"), F.lit(role).alias("role"), F.struct("code", "city", "level").alias(name)))
    for name, dim in (("over", curated("whole", "over", dims.override, "raw_location")), ("also", curated("whole", "also", dims.alias, "alias"))):
        rows = rows.join(dim.groupBy("key", "role").agg(F.first(name, ignorenulls=True).alias(name)), ["key", "role"], "left")
    lone = dominant_city(dims.city).select("key", F.lit("head").alias("role"), F.struct("top", "dominant", "n").alias("lone"))
    rows = rows.join(lone, ["key", "role"], "left")
    of = lambda role, c: F.max(F.when(F.col("role") == role, F.col(c)))
    wanted = {"whole": ("country", "state", "region", "over", "also"), "head": ("key", "state", "region", "lone"), "middle": ("state",), "last": ("country", "state", "region")}
    wide = rows.groupBy("text", "several").agg(*(of(r, c).alias(f"{r}_{c}") for r, columns in wanted.items() for c in columns))

    asked = {
        "state_city": (F.when(F.col("last_state").isNotNull(), F.lit("US")), F.col("last_state")), "country_city": (F.col("last_country"), F.when(F.col("last_country") == "US", F.col("middle_state"))),
        "region_city": (F.col("last_region"), F.lit(None).cast("string")),
    }
    questions = F.explode(F.array(*(F.struct(F.lit(q).alias("q"), country.alias("country_code"), admin.alias("a")) for q, (country, admin) in asked.items()))).alias("x")
    cities = dims.city.select("key", "country_code", F.struct("name", "country_code", "admin1", "population", "latitude", "longitude").alias("c"))
    hits = wide.select("text", F.col("head_key").alias("key"), questions).select("text", "key", "x.*").join(cities, ["key", "country_code"])
    in_state = F.col("c.admin1") == F.col("a")
    size = F.struct((-F.col("c.population")).alias("p"), F.col("c.name").alias("n"))
    best = hits.groupBy("text", "q").agg(F.count_if(in_state).alias("ns"), F.count("*").alias("n"), F.min_by("c", F.when(in_state, size)).alias("cs"), F.min_by("c", size).alias("cn"))
    use = F.col("ns") > 0
    best = best.select("text", "q", F.struct(F.when(use, F.col("cs")).otherwise(F.col("cn")).alias("c"), F.when(use, F.col("ns")).otherwise(F.col("n")).alias("n"), use.alias("in_state")).alias("found"))
    return wide.join(best.groupBy("text").agg(*(F.max(F.when(F.col("q") == q, F.col("found"))).alias(q) for q in asked)), "text", "left")


def _pair(found: str, confidence: str) -> Column:
    c, n = F.col(f"{found}.c"), F.col(f"{found}.n")
    reason = F.when(n != 1, F.format_string(C.REASONS["same_name"], n, c["country_code"]))
    return _answer(c["country_code"], c["name"], "city", F.when(n == 1, confidence).otherwise("medium"), "city_country_pair", reason, c["latitude"], c["longitude"])


def _why(name: str) -> Column:
    return F.lit(C.REASONS[name])


def _curated(v: str, method: str) -> Column:
    found = F.col(v)
    return F.when(found.isNotNull(), _answer(found["code"], found["city"], "country", F.when(found["level"] == "region", "low").otherwise("high"), method).withField("level", found["level"]))


def stage_override() -> Column:
    return _curated("whole_over", "override")


def stage_alias() -> Column:
    return _curated("whole_also", "alias")


def stage_country() -> Column:
    """A text without a comma that is a country; less sure if a US state has the name."""
    both = F.col("whole_state").isNotNull()
    answer = _answer(F.col("whole_country"), None, "country", F.when(both, "low").otherwise("high"), "country_name", F.when(both, _why("also_state")))
    return F.when(F.col("whole_country").isNotNull() & ~F.contains("text", F.lit(",")), answer)


def stage_us_state_pair() -> Column:
    return F.when(F.col("several") & F.col("state_city.in_state"), _pair("state_city", "medium"))


def stage_us_region_anchor() -> Column:
    return F.when(F.col("several") & (F.col("last_country") == "US") & F.col("head_state").isNotNull(), _answer(F.lit("US"), None, "region", "medium", "country_name"))


def stage_city_country() -> Column:
    return F.when(F.col("several") & F.col("country_city").isNotNull(), _pair("country_city", "high"))


def stage_region_anchor() -> Column:
    """A country after a segment that is no city of it: one of its regions, or nothing known."""
    country = F.col("last_country")
    return F.when(F.col("several") & (F.col("head_region") == country), _answer(country, None, "region", "medium", "country_name")).when(
        F.col("several") & country.isNotNull(), _answer(country, None, "country", "high", "country_name", _why("no_city_in_country"))
    )


def stage_state_or_region_city() -> Column:
    """A state or region after a segment, with or without a city of that name."""
    several, region = F.col("several"), F.col("last_region")
    return (
        F.when(several & F.col("state_city").isNotNull(), _pair("state_city", "medium"))
        .when(several & F.col("last_state").isNotNull(), _answer(F.lit("US"), None, "region", "medium", "country_name", _why("no_city_in_state")))
        .when(several & F.col("region_city").isNotNull(), _pair("region_city", "medium"))
        .when(several & region.isNotNull(), _answer(region, None, "region", "medium", "country_name", _why("no_city_in_region")))
    )


def _single_term(region: Column) -> Column:
    lone = F.col("head_lone")
    top = lone["top"]
    city = lambda confidence, reason: _answer(top["country_code"], top["name"], "city", confidence, "unique_city", reason, top["latitude"], top["longitude"])
    return (
        F.when(region.isNotNull(), _answer(region, None, "region", "low", "country_name", _why("region_only"))).when(lone["dominant"], city("medium", None))
        .when(lone.isNotNull(), city("low", F.format_string(C.REASONS["ambiguous"], lone["n"])))
    )


def stage_head_only() -> Column:
    """The first of several segments as if it stood alone."""
    return F.when(F.col("several"), _single_term(F.col("head_region")))


def stage_single_term() -> Column:
    return F.when(~F.col("several"), _single_term(F.col("whole_region")))


#: In order: the first stage with an answer decides.
STAGES = {
    "stage_override": stage_override, "stage_alias": stage_alias, "stage_country": stage_country, "stage_us_state_pair": stage_us_state_pair, "stage_us_region_anchor": stage_us_region_anchor,
    "stage_city_country": stage_city_country, "stage_region_anchor": stage_region_anchor, "stage_state_or_region_city": stage_state_or_region_city, "stage_head_only": stage_head_only, "stage_single_term": stage_single_term,
}


def run_stage(texts: DataFrame, dims: Dims, name: str) -> DataFrame:
    """(text, answer) of one stage for the cleaned strings that come to it: those on which no stage before has an answer."""
    before = list(STAGES)[: list(STAGES).index(name)]
    wide = pivoted(texts, dims)
    left = wide.where(F.coalesce(*(STAGES[b]() for b in before)).isNull()) if before else wide
    return left.select("text", STAGES[name]().alias("answer")).where("answer is not null")


def _resolve_parts(texts: DataFrame, dims: Dims) -> DataFrame:
    """(text, answer) for cleaned strings without list separators; answer is null if unresolved."""
    return pivoted(texts, dims).select("text", F.coalesce(*(stage() for stage in STAGES.values())).alias("answer"))


def _unusable(reason: Column | str | None) -> Column:
    why = F.lit(reason) if reason is None or isinstance(reason, str) else reason
    return _answer(F.lit(None).cast("string"), None, "unresolved", "unusable", "unresolved", why)


def null_and_placeholder(strings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct raw strings: those to resolve, as (raw_location, text, parts), and the unusable ones, as (raw_location, answer)."""
    raw = strings.select("raw_location").where("raw_location is not null").distinct().withColumn("text", clean_text("raw_location"))
    blank, none = F.trim("raw_location") == "", F.col("text") == ""
    joke = F.lower("text").isin(*C.PLACEHOLDERS)
    why = F.when(blank, F.lit(None)).when(none, _why("symbols")).otherwise(_why("joke"))
    return raw.where(~blank & ~none & ~joke).withColumn("parts", X.split_multi_location("text")), raw.where(blank | none | joke).select("raw_location", _unusable(why).alias("answer"))


def stage_multi(several: DataFrame) -> DataFrame:
    """(raw_location, answer) of (raw_location, pos, answer), the located parts of texts that name several places: the first, if all are in one country."""
    merged = several.groupBy("raw_location").agg(F.count_distinct("answer.code").alias("countries"), F.min_by("answer", "pos").alias("first"))
    return merged.select("raw_location", F.when(F.col("countries") > 1, _unusable(_why("conflict"))).otherwise(F.col("first")).alias("merged"))


def located_parts(usable: DataFrame, dims: Dims) -> tuple[DataFrame, DataFrame]:
    """Whole texts with their answers, and located parts of those that have several: all strings are resolved together, once."""
    pieces = usable.where(F.size("parts") > 1).select("raw_location", F.posexplode("parts").alias("pos", "part"))
    # A curated or country string may hold a separator, so whole strings are looked up as well.
    strings = T.stage(usable.select("text").unionByName(pieces.select(F.col("part").alias("text"))).distinct(), "strings")
    answers = T.stage(_resolve_parts(strings, dims), "answers")
    joke = F.lower("part").isin(*C.PLACEHOLDERS)
    several = pieces.where(~joke).join(answers.withColumnRenamed("text", "part"), "part").where("answer is not null").select("raw_location", "pos", "answer")
    return usable.join(answers, "text", "left"), several


def resolve(strings: DataFrame, dims: Dims) -> DataFrame:
    """(raw_location, answer) for distinct raw strings."""
    usable, lost = null_and_placeholder(strings)
    whole, several = located_parts(T.stage(usable, "usable"), dims)
    found = whole.join(stage_multi(several), "raw_location", "left")
    early = F.col("answer.method").isin("override", "alias") | ((F.col("answer.method") == "country_name") & (F.col("answer.level") == "country") & ~F.contains("text", F.lit(",")))
    one = early | (F.size("parts") < 2)
    answer = F.when(one, F.col("answer")).otherwise(F.col("merged"))
    return found.select("raw_location", F.coalesce(answer, _unusable(_why("unresolved"))).alias("answer")).unionByName(lost)


def normalize_run(profiles: DataFrame, dims: Dims) -> DataFrame:
    """normalized_locations of user_profiles; profiles that weren't fetched are unusable."""
    known = profiles.select("actor_login", F.when(F.col("fetch_status") == "success", F.col("public_location_raw")).alias("raw_location"))
    names = dims.country.groupBy("code").agg(F.first("name", ignorenulls=True).alias("country_name"))
    out = known.join(resolve(known, dims), "raw_location", "left").withColumn("a", F.coalesce("answer", _unusable(None)))
    return out.join(names, F.col("a.code") == F.col("code"), "left").select(
        "actor_login", "raw_location", F.col("a.code").alias("normalized_country_code"), F.col("country_name").alias("normalized_country_name"), F.col("a.city").alias("normalized_city"),
        "a.latitude", "a.longitude", F.col("a.level").alias("location_level"), F.col("a.confidence").alias("location_confidence"), F.col("a.method").alias("normalization_method"), F.col("a.reason").alias("ambiguity_reason"),
    )


def eligible_country(confidence: str | Column = "location_confidence") -> Column:
    return (F.col(confidence) if isinstance(confidence, str) else confidence).isin("high", "medium")


def eligible_city(level: str = "location_level", confidence: str = "location_confidence") -> Column:
    return (F.col(level) == "city") & (F.col(confidence) == "high")


def normalization_summary(locations: DataFrame) -> DataFrame:
    country, city = F.count_if(F.col("normalized_country_code").isNotNull()), F.count_if(F.col("normalized_city").isNotNull())
    return locations.agg(
        F.count("*").alias("total"), country.alias("located_country"), city.alias("located_city"),
        F.count_if(F.col("location_confidence") == "unusable").alias("unusable"), F.coalesce(F.try_divide(country, F.count("*")), F.lit(0.0)).alias("country_rate"),
    )
