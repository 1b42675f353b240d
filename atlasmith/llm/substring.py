"""Substring dedup: drop word sequences that an earlier document has too.

A generalised suffix tree over words, cut into subtrees by variable-length prefixes. The suffix that
starts at a word belongs to the subtree of the prefix that ends with the smallest eight-word group
(by hash) within its first WINDOW words. Equal suffixes choose equal prefixes, so no two of them
meet in different subtrees, and neighbouring suffixes mostly share one, so that a prefix is counted
once for about 22 words:

1. prefixes are counted (one row per document and prefix); those of a single document head a subtree
   without repeats and go, and most of the corpus with them;
2. neighbouring suffixes of one prefix are a run. Equal runs are taken together first: only the
   earliest document's run stays in the subtree, every suffix of the others has an earlier leaf.
   The runs that stay, below prefixes with several of them, are split into suffixes, and these grouped
   by prefix and by their first WINDOW words. Such a group is a node at depth WINDOW; one with leaves in several
   documents is a deep internal node. Both groupings are aggregations with partial sums, so a passage that a
   third of all documents share is one row per task, and no subtree has to fit in memory;
3. leaves of deep nodes in later documents are collected per document, their spans united (runs of
   neighbouring leaves are maximal repeats) and cut from the text.

Texts are shuffled compressed. Words, eight-word groups and windows are hashed to 64 bits with mixed polynomials; a node's key is
its prefix and its window, 128 bits.

Defined cases. A null or wordless text has no words. Fewer words than a window lose nothing. Rows
with a null doc_id are kept whole and are no one's earlier document. Rows that repeat a doc_id are
one document: none is earlier than the other, and what any of them loses counts for all, by position. Columns of docs but for the text pass through dedup().
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atlasmith.llm import _shared as S

WINDOW = 50
GROUP = 8
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as many as are needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inverse, k, 1 << 64))])
        return self.up[:n], self.down[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sums(values: np.ndarray, powers: Powers, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Hashes of values[start:stop], the same wherever a sequence stands."""
    up, down = powers.upto(len(values) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * up[:-1])))
    return mixed((total[stops] - total[starts]) * down[starts] + (stops - starts).astype(np.uint64))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and stop in UTF-8 bytes."""
    inside = np.concatenate(([False], ~((data == 32) | ((data >= 9) & (data <= 13))), [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


class Suffixes:
    """Prefix and node of each suffix of at least WINDOW words of a text."""

    def __init__(self) -> None:
        self.letters, self.words = Powers(BASES[0]), Powers(BASES[1])

    def of(self, text: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        data = np.frombuffer(text, np.uint8)
        starts, stops = word_spans(data)
        n = len(starts)
        if n < WINDOW:
            return None
        word = sums(data.astype(np.uint64) + np.uint64(1), self.letters, starts, stops)
        at = np.arange(n - GROUP + 1)
        group = sums(word, self.words, at, at + GROUP)
        at = at[: n - WINDOW + 1]
        return sliding_window_view(group, WINDOW - GROUP + 1).min(axis=1), sums(word, self.words, at, at + WINDOW)


def _packed(texts: pd.Series) -> pd.Series:
    pack = zstandard.ZstdCompressor(level=3).compress
    return texts.map(lambda x: None if x is None else pack(x.encode("utf-8", "surrogatepass")))


def packed(text: str) -> Column:
    return F.pandas_udf(_packed, T.BinaryType())(F.col(text))


def unpacked(data: bytes | None) -> bytes:
    return b"" if data is None else zstandard.ZstdDecompressor().decompress(data)


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    suffixes = Suffixes()
    for batch in batches:
        ids, found = batch.column("doc_id").to_pylist(), []
        for x in batch.column("text"):
            s = suffixes.of(x.as_py().encode("utf-8", "surrogatepass"))
            found.append(np.empty(0, np.uint64) if s is None else np.unique(s[0]))
        sizes = [len(x) for x in found]
        prefix = np.concatenate([*found, np.empty(0, np.uint64)]).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(ids, np.int64), sizes)), pa.array(prefix)], ["doc_id", "prefix"])


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes below shared prefixes, as runs: prefix, first start, nodes."""
    suffixes = Suffixes()
    for batch in batches:
        rows: list[tuple] = []
        for doc_id, text, shared in zip(batch.column("doc_id").to_pylist(), batch.column("packed"), batch.column("shared").to_pylist(), strict=True):
            found = suffixes.of(unpacked(text.as_py()))
            if found is None:
                continue
            prefix, node = found
            wanted = np.isin(prefix, np.array(shared, np.int64).view(np.uint64))
            cuts = np.flatnonzero(np.concatenate(([True], prefix[1:] != prefix[:-1])))
            for s, e in zip(cuts.tolist(), [*cuts[1:].tolist(), len(prefix)], strict=True):
                if wanted[s]:
                    nodes = node[s:e]
                    run = xxhash.xxh64_intdigest(nodes.tobytes()) - (1 << 63)
                    rows.append((doc_id, int(prefix[s : s + 1].view(np.int64)[0]), run, s, e - s, nodes.view(np.int64)))
        columns = list(zip(*rows, strict=True)) or [[]] * 6
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "prefix", "run", "start", "size", "nodes"])


def repeated_starts(docs: DataFrame) -> DataFrame:
    """(doc_id, starts): words of each document at which a window starts that an earlier document has."""
    known = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long"), "text")
    prefixes = S.stage_table(known.mapInArrow(_prefixes, "doc_id long, prefix long"), "prefixes")
    several = prefixes.groupBy("prefix").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("prefix")
    shared = prefixes.join(several, "prefix").groupBy("doc_id").agg(F.collect_set("prefix").alias("shared"))
    below = known.select("doc_id", packed("text").alias("packed")).join(shared, "doc_id")
    leaves = S.stage_table(below.mapInArrow(_leaves, "doc_id long, prefix long, run long, start int, size int, nodes array<long>"), "leaves")
    S.drop_stage(prefixes)
    key = ["prefix", "run"]
    runs = leaves.groupBy(*key).agg(F.min("doc_id").alias("first"))
    # Runs that an earlier document has as a whole.
    whole = leaves.select(*key, "doc_id", "start", "size").join(runs, key).where("doc_id > first").select("doc_id", F.explode(F.sequence("start", F.col("start") + F.col("size") - 1)).alias("start"))
    # The earliest document's runs, where their prefix has others.
    mixed = runs.groupBy("prefix").agg(F.count("*").alias("n")).where("n > 1").select("prefix")
    each = (
        leaves.join(runs.join(mixed, "prefix", "left_semi"), key).where("doc_id = first")
        .select("doc_id", "prefix", "start", F.posexplode("nodes").alias("at", "node")).select("doc_id", "prefix", (F.col("start") + F.col("at")).alias("start"), "node")
    )
    deep = each.groupBy("prefix", "node").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    # A run of several documents may hold a node that a still earlier one has; its copies lose it as part of the run.
    later = each.join(deep, ["prefix", "node"]).where("doc_id > first").select("doc_id", "start")
    starts = S.stage_table(whole.unionByName(later).groupBy("doc_id").agg(F.collect_set("start").alias("starts")), "starts")
    S.drop_stage(leaves)
    return starts


def _cut(texts: pd.Series, starts: pd.Series) -> pd.DataFrame:
    """Texts without the words that the windows cover, joined by one space, and counts of words."""
    out = []
    for text, at in zip(texts, starts, strict=True):
        words = unpacked(text).split()
        n, kept = len(words), words
        at = np.asarray([] if at is None else at, np.int64)
        at = at[at + WINDOW <= n]
        if len(at):
            change = np.zeros(n + 1, np.int64)
            np.add.at(change, at, 1)
            np.add.at(change, at + WINDOW, -1)
            kept = [words[i] for i in np.flatnonzero(np.cumsum(change[:n]) == 0).tolist()]
        out.append((n, n - len(kept), b" ".join(kept).decode("utf-8", "surrogatepass")))
    return pd.DataFrame(out, columns=["n_words", "n_removed", "kept"])


def dedup(docs: DataFrame) -> DataFrame:
    """docs with n_words, n_removed and kept, the text of the words that stay, in place of text and any such columns."""
    starts = repeated_starts(docs).select(F.col("doc_id").alias("_id"), "starts")
    cut = F.pandas_udf(_cut, "n_words long, n_removed long, kept string")
    others = [c for c in docs.columns if c not in ("text", "n_words", "n_removed", "kept")]
    wrapped = docs.select(F.struct(*others).alias("doc"), packed("text").alias("_text"))
    found = wrapped.join(starts, F.col("doc.doc_id") == F.col("_id"), "left").select("doc", cut(F.col("_text"), "starts").alias("cut"))
    return found.select(*(F.col("doc")[c].alias(c) for c in others), "cut.*")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = S.table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, sha256(array_to_string(w[i : i + 49], ' ')) AS h FROM words, unnest(range(1, len(w) - 48)) AS r(i) WHERE len(w) >= 50),
firsts AS (SELECT h, min(doc_id) AS first FROM windows GROUP BY h HAVING count(DISTINCT doc_id) > 1),
covered AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS pos FROM windows JOIN firsts USING (h) WHERE doc_id > first),
each AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM words),
kept AS (SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.pos) AS kept, count(*) AS n_kept FROM each e ANTI JOIN covered c ON e.doc_id = c.doc_id AND e.pos = c.pos GROUP BY e.doc_id)
SELECT w.doc_id, len(w.w) AS n_words, len(w.w) - coalesce(k.n_kept, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM words w LEFT JOIN kept k USING (doc_id)
"""

S.by_value(__name__)
