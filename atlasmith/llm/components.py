"""Connected components of links between long ids, by alternating large-star and small-star steps.

Each round is a handful of joins and aggregations on the link table, which never grows beyond the
number of links; the rounds are about the logarithm of the longest chain. Rounds are cut by tables
in the shared folder. Hubs are handled by partial aggregation (their minimum) and by Spark's
splitting of skewed joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlasmith.llm import _shared as S


def _stars(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step over (a, b)."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    lowest = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(lowest, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(id, root): the smallest id reachable, for each id that has a link and isn't its own root.

    links: (a, b) longs, any order, repeats and self-links allowed; rows with nulls link nothing.
    """
    start = links.where("a is not null and b is not null and a <> b")
    now = S.stage_table(start.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = _state(now)
    while state[0]:
        after = S.stage_table(_stars(now), "links")
        reached = _state(after)
        S.drop_stage(now)
        now = after
        if reached == state:
            break
        state = reached
    return now.select(F.col("a").alias("id"), F.col("b").alias("root"))
