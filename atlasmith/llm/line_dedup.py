"""Line dedup: drop lines that many documents share.

Lines are exploded and normalised, long keys hashed to 128 bits, distinct documents counted per
hash, lines over the threshold dropped (but for one keeper) and texts reassembled by position.
Only hashes of long lines are shuffled for counting; a text travels once at most, to meet the
positions that it loses.

Defined cases. A null or empty text is one empty line. A null doc_id counts as no document: its
lines don't make a key frequent and it never is the keeper, but it loses frequent lines. Rows that
repeat a doc_id count as one document; each keeps a row of its own. Columns besides doc_id and the
text pass through inside a struct, so that no helper column can clash with them.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atlasmith.llm import _shared as S

MIN_CHARS = 40
MIN_DOCS = 5


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    return S.lower_ascii(F.btrim(line, F.lit(S.SPACE)))


def _without(texts: pd.Series, dropped: pd.Series) -> pd.Series:
    """Texts without the lines at the given positions."""
    out = []
    for text, positions in zip(texts, dropped, strict=True):
        if positions is not None and len(positions):
            gone = set(positions.tolist())
            text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
        out.append(text)
    return pd.Series(out, dtype=object)


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(_id, _h1, _h2, positions): what each distinct (doc_id, text) loses; no row where nothing is lost."""
    text = S.text_or_empty()
    lines = docs.select(
        F.col("doc_id").alias("_id"), *(h.alias(n) for h, n in zip(S.hash_pair(text), ("_h1", "_h2"), strict=True)),
        F.posexplode(F.split(text, "\n")).alias("_pos", "_line"),
    ).select("_id", "_h1", "_h2", "_pos", line_key(F.col("_line")).alias("_key"))
    # Written once, as it is read twice: lines are exploded and hashed in one pass over the texts.
    keyed = S.stage_table(
        lines.where(F.char_length("_key") >= min_chars).select(
            "_id", "_h1", "_h2", "_pos", *(h.alias(n) for h, n in zip(S.hash_pair(F.col("_key")), ("_k1", "_k2"), strict=True))
        ), "line-keys",
    )
    # Distinct documents first, by (key, document): a key that a third of all rows hold is spread.
    frequent = S.stage_table(
        keyed.where(F.col("_id").isNotNull()).groupBy("_k1", "_k2", "_id").agg(F.lit(1).alias("_one"))
        .groupBy("_k1", "_k2").agg(F.count("_one").alias("_docs"), F.max("_id").alias("_keeper"))
        .where(F.col("_docs") >= min_docs).select("_k1", "_k2", "_keeper"), "frequent-lines",
    )
    return (
        S.join_small(keyed, frequent, ["_k1", "_k2"], spread=("_id", "_pos")).where(~F.col("_id").eqNullSafe(F.col("_keeper")))
        .groupBy("_id", "_h1", "_h2").agg(F.collect_set("_pos").alias("_positions"))
    )


def drop_frequent_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """docs with texts that lost their frequent lines, and n_lines, n_dropped (longs, in place of any such columns)."""
    gone = dropped_lines(docs, min_chars, min_docs)
    h1, h2 = S.hash_pair(S.text_or_empty())
    left = docs.select(F.struct("*").alias("doc"), h1.alias("_t1"), h2.alias("_t2"))
    on = F.col("doc.doc_id").eqNullSafe(gone["_id"]) & (left["_t1"] == gone["_h1"]) & (left["_t2"] == gone["_h2"])
    kept = F.pandas_udf(_without, T.StringType())
    text = S.text_or_empty("doc.text")
    others = [F.col("doc")[c].alias(c) for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    return left.join(gone, on, "left").select(
        *others,
        kept(text, F.col("_positions")).alias("text"),
        F.size(F.split(text, "\n")).cast("long").alias("n_lines"),
        F.when(F.col("_positions").isNull(), 0).otherwise(F.size("_positions")).cast("long").alias("n_dropped"),
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = S.table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_frequent_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256")
    )


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
frequent AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5)
SELECT a.doc_id, count(*) AS n_lines, count(f.k) FILTER (a.doc_id <> f.keeper) AS n_dropped,
       sha256(coalesce(string_agg(a.line, chr(10) ORDER BY a.pos) FILTER (f.k IS NULL OR a.doc_id = f.keeper), '')) AS kept_sha256
FROM keyed a LEFT JOIN frequent f ON a.k = f.k GROUP BY a.doc_id
"""

S.by_value(__name__)
