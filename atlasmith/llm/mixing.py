"""Mixing sources to target weights: hierarchical budgeting over a domain-language-source tree.

A token budget goes down the tree by weight. A node can't take more than its documents give in
max_epochs passes; what it can't take goes to its siblings by weight, and only what they can't take
either reaches the siblings of its ancestors (a parent's own limit is the sum of its children's, so
filling level by level does exactly this). Each leaf takes whole passes, and of the next seeded
pass the documents, in the pass's order, whose running token sum stays within the rest.

The running sum is found without sorting a leaf: documents fall into 4096 buckets of the order key,
bucket sums are added up, and only the one bucket in which the budget ends is looked at row by row.
All of it is DataFrame functions and integer arithmetic; the tree's tables have a row per node and
are written as they are made. Tokens are counted as words, which needs no tokenizer outside the JVM.

Defined cases. A null domain, language or source is the node ''. A null text has no tokens, and a
leaf without tokens gets no whole pass; its documents come free, in the first pass. Rows that repeat
a doc_id in a leaf are taken or left together. Rows with a null doc_id come last in a pass. Weights
are positive integers; nodes without a weight of their own get default_weight. An empty table gives
no rows. Input columns pass through select_docs; helper names live in a table of their own.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from atlasmith.llm import _shared as S

LEVELS = ("domain", "lang", "source")


@dataclass(frozen=True)
class Mix:
    """Weights by node name for each level, the budget as a share of all tokens, passes and seed."""

    weights: dict[str, dict[str, int]] = field(default_factory=lambda: {"domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1}, "lang": {"en": 5, "de": 2, "fr": 2, "es": 1}, "source": {}})
    default_weight: int = 1
    budget: tuple[int, int] = (1, 2)
    max_epochs: int = 2
    seed: int = 42


PRODUCTION = Mix()
#: For the pipeline: documents come once at most; the mix takes nine tenths of all tokens, by weight.
ONCE = Mix(budget=(9, 10), max_epochs=1)


def domain_of(source: Column) -> Column:
    """The default domain: sources are numbered, four domains share them in turn."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), "([0-9]{1,9})$", 1)
    return F.when(number == "", F.lit("")).otherwise(F.concat(F.lit("d"), F.nullif(number, F.lit("")).cast("long") % 4))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(S.WORD)).cast("long")


def _node(docs: DataFrame) -> list[Column]:
    """doc_id, domain, lang and source of each row, with '' for null node names."""
    return [
        docs["doc_id"].cast("long").alias("doc_id"), domain_of(docs["source"]).alias("domain"),
        F.coalesce(docs["lang"], F.lit("")).alias("lang"), F.coalesce(docs["source"], F.lit("")).alias("source"),
    ]


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, domain, lang, source, tokens), with '' for null node names."""
    return docs.select(*_node(docs), word_count(docs["text"]).alias("tokens"))


def _weight(level: str, mix: Mix) -> Column:
    table = mix.weights.get(level, {})
    if not table:
        return F.lit(mix.default_weight).cast("long")
    chosen = F.lit(mix.default_weight)
    for name, weight in table.items():
        chosen = F.when(F.col(level) == name, F.lit(weight)).otherwise(chosen)
    return chosen.cast("long")


def _wide(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(20,0)")


def share_out(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """nodes (parent..., name, cap, weight, budget of the parent) with what each node gets, as granted.

    In order of cap per weight, a node is full if its cap is within its share of what is left; the
    others divide the rest by weight.
    """
    group = Window.partitionBy(*(parent or [F.lit(0)]))
    order = group.orderBy(F.col("cap") / F.col("weight"), F.col(name))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    nodes = (
        nodes.withColumn("taken", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("open_weight", F.sum("weight").over(group) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("full", _wide("cap") * F.col("open_weight").cast("decimal(17,0)") <= _wide(F.col("budget") - F.col("taken")) * F.col("weight").cast("decimal(17,0)"))
        .withColumn("rest", F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(group), F.lit(0)))
        .withColumn("rest_weight", F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(group), F.lit(1)))
    )
    divided = F.expr("cast(rest as decimal(20,0)) * cast(weight as decimal(17,0)) div rest_weight")
    granted = F.when(F.col("full"), F.col("cap")).otherwise(F.least("cap", divided)).cast("long")
    return nodes.select(*parent, name, granted.alias("granted"))


def leaf_budgets(sizes: DataFrame, mix: Mix = PRODUCTION) -> DataFrame:
    """(domain, lang, source, tokens, granted) of each leaf."""
    leaves = S.stage_table(sizes.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")), "mix-leaves")
    top, bottom = mix.budget
    budget = leaves.agg(F.floor(F.coalesce(F.sum("tokens"), F.lit(0)) * top / bottom).cast("long").alias("budget"))
    above: DataFrame | None = None
    for depth, level in enumerate(LEVELS):
        parent = list(LEVELS[:depth])
        nodes = leaves.groupBy(*parent, level).agg((F.sum("tokens") * mix.max_epochs).alias("cap")).withColumn("weight", _weight(level, mix))
        nodes = nodes.crossJoin(F.broadcast(budget)) if above is None else nodes.join(above, parent)
        above = share_out(nodes, parent, level).withColumnRenamed("granted", "budget")
    return leaves.join(above.withColumnRenamed("budget", "granted"), list(LEVELS))


def _placed(rows: DataFrame, mix: Mix) -> DataFrame:
    """rows (doc_id, passes, ...) with their place in the next pass: order key and bucket."""
    key = F.md5(F.encode(F.concat_ws(":", F.lit(mix.seed), F.col("passes"), F.col("doc_id")), "UTF-8"))
    return rows.withColumn("key", F.when(F.col("doc_id").isNull(), F.lit("g")).otherwise(key)).withColumn("bucket", F.substring("key", 1, 3))


def leaf_limits(sizes: DataFrame, mix: Mix = PRODUCTION) -> DataFrame:
    """(domain, lang, source, passes, end, cut): whole passes, and where the next one ends.

    Documents in a bucket before end are in the next pass too, and those of the bucket end up to cut;
    without an end all are. A row per leaf, in a stage table, as are the steps before it: each is
    computed once and the plan of each stays short.
    """
    leaf = list(LEVELS)
    plan = S.stage_table(
        leaf_budgets(sizes, mix).select(
            *leaf, F.expr("case when tokens > 0 then granted div tokens else 0 end").alias("passes"),
            F.expr("case when tokens > 0 then granted % tokens else 0 end").alias("rest"),
        ), "mix-plan",
    )
    keyed = _placed(S.join_small(sizes, plan, leaf, spread=("doc_id",)), mix)
    buckets = S.stage_table(keyed.groupBy(*leaf, "rest", "bucket").agg(F.sum("tokens").alias("sum")), "mix-buckets")
    running = F.sum("sum").over(Window.partitionBy(*leaf).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    end = S.stage_table(
        buckets.withColumn("upto", running).where("upto > rest")
        .groupBy(*leaf).agg(F.min("bucket").alias("end"), F.min_by(F.col("upto") - F.col("sum"), "bucket").alias("before")), "mix-ends",
    )
    within = (
        S.join_small(keyed, end, leaf, spread=("doc_id",)).where("bucket = end").groupBy(*leaf, "rest", "before", "key", "doc_id").agg(F.sum("tokens").alias("sum"))
        .withColumn("upto", F.col("before") + F.sum("sum").over(Window.partitionBy(*leaf).orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)))
        .where("upto <= rest").groupBy(*leaf).agg(F.max(F.struct("key", "doc_id")).alias("cut"))
    )
    limits = S.stage_table(plan.select(*leaf, "passes").join(end.select(*leaf, "end"), leaf, "left").join(within, leaf, "left"), "mix-limits")
    for done in (plan, buckets, end):
        S.drop_stage(done)
    return limits


def _epochs(rows: DataFrame, limits: DataFrame, mix: Mix) -> DataFrame:
    """rows (doc_id, domain, lang, source, ...) that are taken, with epochs: how often."""
    placed = _placed(S.join_small(rows, limits, list(LEVELS), spread=("doc_id",)), mix)
    taken = F.col("end").isNull() | (F.col("bucket") < F.col("end")) | F.coalesce(F.struct("key", "doc_id") <= F.col("cut"), F.lit(False))
    return placed.withColumn("epochs", (F.col("passes") + taken.cast("int")).cast("long")).where("epochs > 0")


def selected(sizes: DataFrame, mix: Mix = PRODUCTION) -> DataFrame:
    """(doc_id, domain, lang, source, tokens, epochs): how often each document is taken, if at all."""
    return _epochs(sizes, leaf_limits(sizes, mix), mix).select("doc_id", *LEVELS, "tokens", "epochs")


def select_docs(docs: DataFrame, mix: Mix = ONCE) -> DataFrame:
    """The rows of docs that the mix takes, each as often as it has epochs.

    A document's place follows from its own doc_id and leaf, so texts are not shuffled.
    """
    sizes = S.stage_table(measured(docs), "sizes")
    limits = leaf_limits(sizes, mix)
    S.drop_stage(sizes)
    rows = docs.select(F.struct("*").alias("doc"), *_node(docs))
    found = _epochs(rows, limits, mix).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("epochs").cast("int"))))
    return found.select(*(F.col("doc")[c].alias(c) for c in docs.columns))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = S.stage_table(measured(S.table(spark, sf_dir, "documents")), "sizes")
    return selected(sizes)


def oracle(documents: str = "documents", mix: Mix = PRODUCTION) -> str:
    """DuckDB SQL for selected(measured(documents), mix)."""

    def weight(level: str) -> str:
        table = mix.weights.get(level, {})
        return ("CASE " + " ".join(f"WHEN {level} = '{k}' THEN {w}" for k, w in table.items()) + f" ELSE {mix.default_weight} END") if table else str(mix.default_weight)

    parts = [
        f"""sizes AS (
  SELECT doc_id, CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) = '' THEN ''
                 ELSE 'd' || (CAST(nullif(regexp_extract(source, '([0-9]{{1,9}})$', 1), '') AS BIGINT) % 4) END AS domain,
         coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS tokens
  FROM {documents})""",
        "leaves AS (SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS tokens FROM sizes GROUP BY ALL)",
        f"b0 AS (SELECT CAST(floor(coalesce(sum(tokens), 0) * {mix.budget[0]} / {mix.budget[1]}) AS BIGINT) AS budget FROM leaves)",
    ]
    for depth, level in enumerate(LEVELS):
        parent = list(LEVELS[:depth])
        above = ", ".join(parent)
        by = f"PARTITION BY {above}" if parent else ""
        parts += [
            f"""n{depth} AS (SELECT a.*, b.budget FROM (
  SELECT {", ".join([*parent, level])}, CAST(sum(tokens) AS HUGEINT) * {mix.max_epochs} AS cap, {weight(level)} AS weight FROM leaves GROUP BY ALL) a
  {f"JOIN b{depth} b USING ({above})" if parent else f"CROSS JOIN b{depth} b"})""",
            f"""o{depth} AS (SELECT *,
  coalesce(sum(cap) OVER ({by} ORDER BY cap / weight, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken,
  sum(weight) OVER ({by}) - coalesce(sum(weight) OVER ({by} ORDER BY cap / weight, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open_weight FROM n{depth})""",
            f"f{depth} AS (SELECT *, cap * open_weight <= (budget - taken) * weight AS is_full FROM o{depth})",
            f"""b{depth + 1} AS (SELECT {", ".join([*parent, level])}, CAST(CASE WHEN is_full THEN cap ELSE least(cap,
  CAST((budget - coalesce(sum(cap) FILTER (is_full) OVER ({by}), 0)) AS HUGEINT) * weight // CAST(coalesce(sum(weight) FILTER (NOT is_full) OVER ({by}), 1) AS HUGEINT)) END AS BIGINT) AS budget FROM f{depth})""",
        ]
    return "WITH " + ",\n".join(parts) + f""",
keyed AS (
  SELECT s.*, CASE WHEN l.tokens > 0 THEN b.budget // l.tokens ELSE 0 END AS passes, CASE WHEN l.tokens > 0 THEN b.budget % l.tokens ELSE 0 END AS rest
  FROM sizes s JOIN leaves l USING (domain, lang, source) JOIN b3 b USING (domain, lang, source)),
ordered AS (
  SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('{mix.seed}:' || passes || ':' || doc_id), doc_id) AS upto FROM keyed)
SELECT doc_id, domain, lang, source, tokens, CAST(passes + CASE WHEN upto <= rest THEN 1 ELSE 0 END AS BIGINT) AS epochs
FROM ordered WHERE passes + CASE WHEN upto <= rest THEN 1 ELSE 0 END > 0
"""


ORACLE = oracle()
