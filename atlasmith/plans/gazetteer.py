"""Location dimensions: a small one of public facts, and one that the star-schema tables give, with texts about the same keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasmith.operators import locations as L

COUNTRIES = [
    ("US", "United States", ["USA", "United States of America", "America"]), ("DE", "Germany", ["DEU", "Deutschland"]), ("FR", "France", ["FRA"]), ("CA", "Canada", ["CAN"]), ("BR", "Brazil", ["BRA", "Brasil"]),
    ("UA", "Ukraine", ["UKR"]), ("CN", "China", ["CHN"]), ("IN", "India", ["IND"]), ("GE", "Georgia", ["GEO"]), ("GB", "United Kingdom", ["GBR", "UK", "England"]), ("JP", "Japan", ["JPN"]), ("IS", "Iceland", ["ISL"]),
    ("NL", "Netherlands", ["NLD", "The Netherlands"]), ("ZA", "South Africa", ["ZAF"]), ("MA", "Morocco", ["MAR"]), ("CO", "Colombia", ["COL"]),
]
STATES = [("tx", "TX"), ("texas", "TX"), ("ma", "MA"), ("massachusetts", "MA"), ("ca", "CA"), ("california", "CA"), ("georgia", "GA"), ("ga", "GA"), ("co", "CO"), ("colorado", "CO"), ("de", "DE"), ("delaware", "DE"), ("in", "IN"), ("virginia", "VA"), ("il", "IL"), ("new york", "NY"), ("maryland", "MD")]
REGIONS = [("ontario", "CA"), ("on", "CA"), ("scotland", "GB"), ("bavaria", "DE"), ("quebec", "CA")]
CITIES = [
    ("Berlin", [], "DE", "16", 3_426_354), ("Munich", ["München"], "DE", "02", 1_260_391), ("Toronto", [], "CA", "08", 2_600_000), ("São Paulo", [], "BR", "27", 10_021_295), ("Kyiv", ["Kiev"], "UA", "12", 2_797_553),
    ("Shenzhen", [], "CN", "30", 10_358_381), ("Bengaluru", ["Bangalore"], "IN", "19", 5_104_047), ("Tbilisi", [], "GE", "51", 1_049_498), ("Austin", [], "US", "TX", 931_830), ("Cambridge", [], "US", "MA", 110_402),
    ("Cambridge", [], "GB", "ENG", 128_488), ("San Francisco", [], "US", "CA", 864_816), ("Atlanta", [], "US", "GA", 463_878), ("Denver", [], "US", "CO", 682_545), ("Reykjavík", [], "IS", "39", 118_918),
    ("Amsterdam", [], "NL", "07", 741_636), ("Tokyo", ["東京"], "JP", "40", 8_336_599), ("Springfield", [], "US", "MO", 166_810), ("Springfield", [], "US", "MA", 154_341), ("Springfield", [], "US", "IL", 116_565),
    ("London", [], "GB", "ENG", 7_556_900), ("Paris", [], "FR", "11", 2_138_551), ("Virginia", [], "ZA", "03", 51_000),
]

def dims(spark: SparkSession) -> L.Dims:
    make = spark.createDataFrame
    cities = make([(n, a, c, s, p, None, None) for n, a, c, s, p in CITIES], "name string, alternates array<string>, country_code string, admin1 string, population long, latitude double, longitude double")
    return L.Dims(
        country=L.country_key_dim(make(COUNTRIES, "code string, name string, forms array<string>")), us_state=make(STATES, "key string, code string"), region=make(REGIONS, "key string, country string"),
        city=L.city_key_dim(cities), alias=make([], "alias string, code string, city string, level string"), override=make([], "raw_location string, code string, city string, level string"),
    )


#: Forms of free text that profiles() deals to customers in turn.
N_FORMS, TWIN = 16, 14


def _code(nation: str | Column) -> Column:
    n = F.col(nation) if isinstance(nation, str) else nation
    return F.when(n == 0, "US").otherwise(F.concat(F.lit("N"), n))


def _anchors(nation: DataFrame) -> DataFrame:
    """The nation that a region's name alone stands for."""
    return nation.where("n_nationkey > 0").groupBy("n_regionkey").agg(F.min("n_nationkey").alias("anchor"))


def star_dims(customer: DataFrame, nation: DataFrame, region: DataFrame) -> L.Dims:
    """Dimensions from the tables: nations are countries (the first one with states, the segments), customers name cities.

    A city is large or small in turn; every sixteenth name also belongs to a city of the next nation.
    """
    countries = nation.select(_code("n_nationkey").alias("code"), F.col("n_name").alias("name"), F.array(F.concat(F.lit("Republic of "), "n_name")).alias("forms"))
    segment, none = F.upper(F.substring("c_mktsegment", 1, 2)), F.lit(None).cast("double")
    place = lambda n, p: (F.col("c_name").alias("name"), F.array().cast("array<string>").alias("alternates"), _code(n).alias("country_code"), segment.alias("admin1"), p.cast("long").alias("population"), none.alias("latitude"), none.alias("longitude"))
    twin = F.col("c_custkey") % N_FORMS == TWIN
    cities = customer.select(*place("c_nationkey", F.when(twin, 150_000).when(F.col("c_custkey") % 2 == 1, 120_000).otherwise(60_000)))
    twins = customer.where(twin).crossJoin(nation.agg(F.count("*").cast("int").alias("__n"))).select(*place((F.col("c_nationkey") + 1) % F.col("__n"), F.lit(140_000)))
    curated = nation.limit(0).select(*(F.col("n_name").alias(c) for c in ("alias", "raw_location", "code", "city", "level")))
    return L.Dims(
        country=L.country_key_dim(countries), us_state=customer.select(F.lower("c_mktsegment").alias("key"), segment.alias("code")).distinct(),
        region=region.join(_anchors(nation), F.col("r_regionkey") == F.col("n_regionkey")).select(F.lower("r_name").alias("key"), _code("anchor").alias("country")),
        city=L.city_key_dim(cities.unionByName(twins)), alias=curated.drop("raw_location"), override=curated.drop("alias"),
    )


def profiles(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Customers with a free text about their own name, nation, region and segment."""
    follows = nation.crossJoin(nation.agg(F.count("*").cast("int").alias("__n"))).select(((F.col("n_nationkey") + F.col("__n") - 1) % F.col("__n")).alias("__k"), F.col("n_name").alias("__next"))
    known = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(follows, F.col("c_nationkey") == F.col("__k")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    comma = lambda *c: F.concat_ws(", ", *c)
    name, place, area, state = F.col("c_name"), F.col("n_name"), F.col("r_name"), F.col("c_mktsegment")
    texts = [
        F.lit(None).cast("string"), F.lit("Remote"), place, comma(name, place), comma(name, state), comma(state, place), name, comma(name, state, place), area, comma(area, place), comma(name, area),
        F.concat_ws(" / ", name, place), F.concat_ws(" / ", name, "__next"), F.concat(F.lit("near "), name, F.lit(", elsewhere")), name, comma(name, F.lit("elsewhere")),
    ]
    return known.select(F.concat(F.lit("c"), "c_custkey").alias("actor_login"), F.get(F.array(*texts), (F.col("c_custkey") % N_FORMS).cast("int")).alias("public_location_raw"), F.lit("success").alias("fetch_status"))


_OWN, _ANCHOR = (f"CASE WHEN {n} = 0 THEN 'US' ELSE 'N' || {n} END" for n in ("n_nationkey", "anchor"))
_CITY = "(t IN (3, 6, 7, 11, 14, 15) OR (t = 4 AND n_nationkey = 0) OR (t = 10 AND n_nationkey = anchor))"
_LOST = "t IN (0, 1, 12, 13)"
#: What each form means, by the same keys.
ORACLE = f"""SELECT 'c' || c_custkey AS actor_login,
  CASE t WHEN 1 THEN 'Remote' WHEN 2 THEN n_name WHEN 3 THEN c_name || ', ' || n_name WHEN 4 THEN c_name || ', ' || c_mktsegment WHEN 5 THEN c_mktsegment || ', ' || n_name WHEN 6 THEN c_name WHEN 7 THEN c_name || ', ' || c_mktsegment || ', ' || n_name WHEN 8 THEN r_name
    WHEN 9 THEN r_name || ', ' || n_name WHEN 10 THEN c_name || ', ' || r_name WHEN 11 THEN c_name || ' / ' || n_name WHEN 12 THEN c_name || ' / ' || next_name WHEN 13 THEN 'near ' || c_name || ', elsewhere' WHEN 14 THEN c_name WHEN 15 THEN c_name || ', elsewhere' END AS raw_location,
  CASE WHEN {_LOST} THEN NULL WHEN t = 4 THEN 'US' WHEN t IN (8, 10) THEN {_ANCHOR} ELSE {_OWN} END AS normalized_country_code, CASE WHEN {_CITY} THEN c_name END AS normalized_city,
  CASE WHEN {_LOST} THEN 'unresolved' WHEN {_CITY} THEN 'city' WHEN t IN (4, 8, 10) OR (t = 5 AND n_nationkey = 0) OR (t = 9 AND n_nationkey = anchor) THEN 'region' ELSE 'country' END AS location_level,
  CASE WHEN {_LOST} THEN 'unusable' WHEN t IN (8, 14) OR (t IN (6, 11, 15) AND c_custkey % 2 = 0) THEN 'low' WHEN t IN (4, 6, 10, 11, 15) OR (t = 5 AND n_nationkey = 0) OR (t = 9 AND n_nationkey = anchor) THEN 'medium' ELSE 'high' END AS location_confidence,
  CASE WHEN {_LOST} THEN 'unresolved' WHEN t IN (6, 11, 14, 15) THEN 'unique_city' WHEN {_CITY} THEN 'city_country_pair' ELSE 'country_name' END AS normalization_method, t AS form, n_nationkey AS nation, anchor
  FROM (SELECT *, c_custkey % {N_FORMS} AS t FROM customer) JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN (SELECT n_regionkey AS k, min(n_nationkey) AS anchor FROM nation WHERE n_nationkey > 0 GROUP BY 1) ON k = n_regionkey
  JOIN (SELECT (n_nationkey + (SELECT count(*) FROM nation) - 1) % (SELECT count(*) FROM nation) AS before, n_name AS next_name FROM nation) ON before = c_nationkey"""
