"""Robust statistics over groups, exact, from running sums over counts per distinct value.

All values of a call, of every group and column, are dealt into ranges together. A range knows the weight before it, so a
running sum is a window over one range, and no task holds a group or a column, however large. Percentiles, ranks
and weighted medians are read off the same running sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atlasmith import settings as C
from atlasmith.sources import tables as T


def _with_groups(df: DataFrame, groups: list[str], stats: DataFrame) -> DataFrame:
    """Join one row of statistics per group; Spark broadcasts it if it is small."""
    if not groups:
        return df.crossJoin(stats)  # one row
    on = None
    renamed = stats.select(*(F.col(g).alias(f"__{g}") for g in groups), *(c for c in stats.columns if c not in groups))
    for g in groups:
        same = F.col(g).eqNullSafe(F.col(f"__{g}"))
        on = same if on is None else on & same
    return df.join(renamed, on, "left").drop(*(f"__{g}" for g in groups))


def running(counted: DataFrame, groups: list[str], value: str, weight: str, kind: str) -> DataFrame:
    """counted, a row per group and distinct value, with __upto, the weight up to and with the value, and __total of the group.

    Ranges are cut by Spark over (groups, value) and written, as their cuts come from a sample: sums per range and
    sums inside a range must see the same ones. A group's sums of ranges are a row per range at most.
    """
    ranged = counted.repartitionByRange(*groups, value).withColumn("__range", F.spark_partition_id())
    cells, within = T.stage(ranged, "ranges"), [*groups, "__range"]
    whole = Window.partitionBy(*(groups or [F.lit(0)]))
    sums = cells.groupBy(*within).agg(F.sum(weight).cast(kind).alias("__sum"))
    before = F.sum("__sum").over(whole.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(*within, F.coalesce(before.cast(kind), F.lit(0).cast(kind)).alias("__before"), F.sum("__sum").over(whole).cast(kind).alias("__total"))
    inside = F.sum(weight).over(Window.partitionBy(*within).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)).cast(kind)
    return _with_groups(cells.withColumn("__upto", inside), within, sums).withColumn("__upto", F.col("__before") + F.col("__upto")).drop("__range", "__before")


def _checked(p: float) -> float:
    if not 0 <= p <= 1:
        raise ValueError(f"percentile {p} is not within [0, 1]")
    return float(p)


def _interpolated(ran: DataFrame, groups: list[str], value: str, wanted: dict[str, float]) -> DataFrame:
    ends = {}
    for name, p in wanted.items():
        at = F.lit(_checked(p)) * (F.col("__total") - 1)
        for end, k in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            ends[f"__{end}_{name}"] = F.min(F.when(F.col("__upto") > k, F.col(value)))
    found = ran.groupBy(*groups).agg(F.max("__total").alias("__total"), *(c.alias(n) for n, c in ends.items()))
    out = []
    for name, p in wanted.items():
        at, lo, hi = F.lit(float(p)) * (F.col("__total") - 1), F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        out.append(F.when(lo == hi, lo.cast("double")).otherwise((F.ceil(at) - at) * lo + (at - F.floor(at)) * hi).alias(name))
    return found.select(*groups, *out)


def percentiles(df: DataFrame, groups: list[str], value: str, wanted: dict[str, float]) -> DataFrame:
    """Per group, linear interpolation at p * (n - 1) for each {name: p}; nulls are left out."""
    for p in wanted.values():
        _checked(p)
    counted = df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count("*").alias("__n"))
    return _interpolated(running(counted, groups, value, "__n", "bigint"), groups, value, wanted)


def percentile_value(df: DataFrame, groups: list[str], value: str, p: float, name: str = "percentile") -> DataFrame:
    return percentiles(df, groups, value, {name: p})


def winsorize(df: DataFrame, groups: list[str], value: str, p: float = C.WINSOR) -> DataFrame:
    """value clipped above its percentile."""
    limits = percentile_value(df, groups, value, p, "__ceiling")
    return _with_groups(df, groups, limits).withColumn(value, F.least(value, "__ceiling")).drop("__ceiling")


def percentile_rank(df: DataFrame, groups: list[str], value: str, name: str) -> DataFrame:
    """0-1 average rank; (cumulative count - half the ties) / n, from counts per distinct value."""
    ran = running(df.groupBy(*groups, value).agg(F.count("*").alias("__n")), groups, value, "__n", "bigint")
    return _with_groups(df, [*groups, value], ran.select(*groups, value, _middle().alias(name)))


def _middle() -> Column:
    return (F.col("__upto") - F.col("__n") / 2) / F.col("__total")


def log1p_scale(value: str | Column) -> Column:
    c = F.col(value) if isinstance(value, str) else value
    return F.when(c < 0, F.raise_error(F.lit("log1p of a negative value"))).otherwise(F.log1p(c))


def minmax_to_100(df: DataFrame, groups: list[str], value: str, name: str) -> DataFrame:
    stats = df.groupBy(*groups).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    scaled = F.when(F.col("__hi") == F.col("__lo"), 50.0).otherwise((F.col(value) - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * 100)
    return _with_groups(df, groups, stats).withColumn(name, scaled).drop("__lo", "__hi")


def scaled(df: DataFrame, groups: list[str], counts: dict[str, str], ranks: dict[str, str], p: float = C.WINSOR) -> DataFrame:
    """Columns {new: old} scaled to 0-100 from one pass over the values of all: counts by min-max of log1p of the winsorised value, ranks by average rank."""
    cell = (F.struct(F.lit(new).alias("__column"), F.col(old).cast("double").alias("__value")) for new, old in (counts | ranks).items())
    cells = df.select(*groups, F.explode(F.array(*cell)).alias("__cell")).select(*groups, "__cell.*")
    some = F.col("__value").isNotNull() | F.col("__column").isin(*ranks)
    by = [*groups, "__column"]
    ran = running(cells.where(some).groupBy(*by, "__value").agg(F.count("*").alias("__n")), by, "__value", "__n", "bigint")
    out = df
    if counts:
        limits = _interpolated(ran.where(F.col("__column").isin(*counts)), by, "__value", {"__a": 0, "__b": 1, "__c": p})
        wide = limits.groupBy(*groups).agg(*(F.max(F.when(F.col("__column") == new, F.col(f"__{k}"))).alias(f"__{k}_{new}") for new in counts for k in "abc"))
        out = _with_groups(out, groups, wide)
    for new, old in counts.items():
        ceiling = F.col(f"__c_{new}")
        lo, hi = (log1p_scale(F.least(F.col(f"__{k}_{new}"), ceiling)) for k in "ab")
        x = log1p_scale(F.least(F.col(old).cast("double"), ceiling))
        out = out.withColumn(new, F.when(hi == lo, 50.0).otherwise((x - lo) / (hi - lo) * 100))
    for new, old in ranks.items():
        score = ran.where(F.col("__column") == new).select(*groups, "__value", (_middle() * 100).alias(new))
        out = _with_groups(out.withColumn("__value", F.col(old).cast("double")), [*groups, "__value"], score).drop("__value")
    return out.drop(*(f"__{k}_{new}" for new in counts for k in "abc"))


def scale_counts(df: DataFrame, groups: list[str], columns: dict[str, str], p: float = C.WINSOR) -> DataFrame:
    """min-max of log1p of the winsorised value, 0-100, for several columns {new: old}."""
    return scaled(df, groups, columns, {}, p)


def scale_rank(df: DataFrame, groups: list[str], value: str, name: str) -> DataFrame:
    return percentile_rank(df, groups, value, name).withColumn(name, F.col(name) * 100)


def weighted_median(df: DataFrame, groups: list[str], value: str, weight: str, name: str = "weighted_median") -> DataFrame:
    """Per group the first value at which the cumulative weight reaches half; weights as exact decimals.

    An error where it is read, if a weight is negative or a group's weights are zero.
    """
    w = F.when(F.col(weight) < 0, F.raise_error(F.lit("weights must not be negative")).cast("decimal(30,12)")).otherwise(F.col(weight).cast("decimal(30,12)"))
    summed = df.groupBy(*groups, value).agg(F.sum(w).alias("__w"))
    ran = running(summed, groups, value, "__w", "decimal(36,12)")
    found = ran.groupBy(*groups).agg(F.min(F.when(F.col("__upto") >= F.col("__total") - F.col("__upto"), F.col(value))).alias(name), F.max("__total").alias("__total"))
    none = F.raise_error(F.lit("weights must not all be zero")).cast(dict(df.dtypes)[value])
    return found.withColumn(name, F.when(F.col("__total") <= 0, none).otherwise(F.col(name))).drop("__total")
