"""SimHash near-dedup over a Gray-order hierarchical index.

Fingerprints are 64-bit sums of XXH64 over word shingles. Two fingerprints link if at most four
bits differ. The index has these levels:

* upper nodes: a shared masked bit pattern. The 64 bits are six runs; four differences leave two
  runs equal, so a pair within reach shares the pattern of at least one of the 15 two-run masks.
  Spark shuffles distinct fingerprints to these nodes (15 short rows each, no more);
* below a node, fingerprints in Gray-rank order are cut into leaves, and leaves into groups; each
  holds the bits that all its members share and their pattern. Two groups whose patterns already
  differ in more than four shared bits are pruned as a whole; the rest descends.

Inside a node only a spanning forest of its links is emitted, never its pairs. A node with more
than NODE_ROWS members is dealt into blocks by hash, and every pair of blocks is searched in a task
of its own, so a task holds two blocks at most and no link is lost.

Defined cases. A null or wordless text has fingerprint zero and links like any other. Rows with a
null doc_id get a fingerprint but make no links of their own; their component is that of the equal
fingerprint, else null. Rows that repeat a doc_id with another text are documents of their own that
share the id: each has the component of its own text. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasmith.llm import _shared as S
from atlasmith.llm.components import components

SHINGLE = 4
SEED = 42
REACH = 4
RUNS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))
NODE_ROWS = 2048
LEAF = 16
FANOUT = 8


def fingerprint(text: str | None, words_each: int = SHINGLE) -> int:
    """The SimHash of a whole text as an unsigned integer; zero if it has no word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    line = b" ".join(words)
    if len(words) <= words_each:
        hashes = np.array([digest(line, SEED)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[: len(words) - words_each] + 1)).tolist()
        hashes = np.fromiter((digest(line[s:e], SEED) for s, e in zip(starts, ends[words_each - 1 :].tolist(), strict=True)), np.uint64, len(starts))
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """The bits that over half of the hashes have."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 8192):
        part = np.ascontiguousarray(hashes[i : i + 8192], "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << bit for bit in np.flatnonzero(2 * ones > len(hashes)).tolist())


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.fromiter((fingerprint(x.as_py()) for x in batch.column("text")), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "h1", "h2")), pa.array(found.view(np.int64))], ["doc_id", "h1", "h2", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, h1, h2, fp): h1 and h2 are hashes of the text, fp has the 64 bits as a signed long."""
    return with_hashes(docs).mapInArrow(_fingerprints, "doc_id long, h1 long, h2 long, fp long")


def with_hashes(docs: DataFrame) -> DataFrame:
    """(doc_id, h1, h2, text): a row is known again by its doc_id and the hashes of its text."""
    h1, h2 = S.hash_pair(S.text_or_empty(docs["text"]))
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), h1.alias("h1"), h2.alias("h2"), docs["text"].alias("text"))


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Position of each pattern in the reflected Gray code."""
    rank = fp.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _levels(fp: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """From leaves upwards: the shared bits of each group and their pattern."""
    every, some = (f.reduceat(fp, np.arange(0, len(fp), LEAF)) for f in (np.bitwise_and, np.bitwise_or))
    levels = [(~(every ^ some), every)]
    while len(every) > FANOUT:
        at = np.arange(0, len(every), FANOUT)
        every, some = np.bitwise_and.reduceat(every, at), np.bitwise_or.reduceat(some, at)
        levels.append((~(every ^ some), every))
    return levels


def _children(pairs: np.ndarray, wide: int, most: int) -> np.ndarray:
    """All child pairs of pairs of groups, each once."""
    a = (pairs[:, 0, None] * wide + np.arange(wide)).repeat(wide, axis=1).ravel()
    b = np.tile(pairs[:, 1, None] * wide + np.arange(wide), (1, wide)).ravel()
    ok = (a <= b) & (b < most)
    return np.stack([a[ok], b[ok]], axis=1)


def close_pairs(fp: np.ndarray) -> Iterator[np.ndarray]:
    """Index pairs (i < j) of Gray-sorted fingerprints within REACH, in bounded pieces."""
    levels = _levels(fp)
    top = len(levels[-1][0])
    pairs = np.stack(np.triu_indices(top), axis=1)
    for depth in range(len(levels) - 1, -1, -1):
        shared, pattern = levels[depth]
        a, b = pairs[:, 0], pairs[:, 1]
        apart = np.bitwise_count((pattern[a] ^ pattern[b]) & shared[a] & shared[b])
        pairs = pairs[apart <= REACH]
        if depth:
            pairs = _children(pairs, FANOUT, len(levels[depth - 1][0]))
    for i in range(0, len(pairs), 2048):
        found = _children(pairs[i : i + 2048], LEAF, len(fp))
        found = found[found[:, 0] < found[:, 1]]
        yield found[np.bitwise_count(fp[found[:, 0]] ^ fp[found[:, 1]]) <= REACH]


def forest(fp: np.ndarray) -> np.ndarray:
    """For each Gray-sorted fingerprint, the smallest index that it reaches by links among these."""
    label = np.arange(len(fp))
    for pairs in close_pairs(fp):
        while len(pairs):
            a, b = label[pairs[:, 0]], label[pairs[:, 1]]
            pairs, low, high = pairs[a != b], np.minimum(a, b)[a != b], np.maximum(a, b)[a != b]
            np.minimum.at(label, high, low)
            while (label[label] != label).any():
                label = label[label]
    return label


def _node_links(ids: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(gray_rank(fps), kind="stable")
    ids, fps = ids[order], fps[order]
    if len(ids) == 2:
        root = np.array([0, 0 if int(fps[0] ^ fps[1]).bit_count() <= REACH else 1])
    else:
        root = forest(fps)
    linked = np.flatnonzero(root != np.arange(len(ids)))
    return ids[linked], ids[root[linked]]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning links of each node; rows come sorted by node, and a node may go on in the next batch."""
    names = ("mask", "node", "lo", "hi", "id", "fp")
    rest: list[np.ndarray] | None = None

    def solve(rows: list[np.ndarray], cuts: np.ndarray) -> pa.RecordBatch:
        found = [_node_links(rows[4][s:e], rows[5][s:e].view(np.uint64)) for s, e in zip(cuts[:-1], cuts[1:], strict=True) if e - s > 1]
        a, b = (np.concatenate([x[i] for x in found]) if found else np.empty(0, np.int64) for i in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [np.asarray(batch.column(n)) for n in names]
        if rest is not None:
            rows = [np.concatenate(x) for x in zip(rest, rows, strict=True)]
        new = np.zeros(len(rows[0]), bool)
        for column in rows[:4]:
            new[1:] |= column[1:] != column[:-1]
        cuts = np.concatenate(([0], np.flatnonzero(new)))
        yield solve(rows, cuts)
        rest = [x[cuts[-1] :] for x in rows]
    if rest is not None:
        yield solve(rest, np.array([0, len(rest[0])]))


def links(distinct: DataFrame) -> DataFrame:
    """(a, b): links between ids of distinct fingerprints (id, fp), a spanning forest per index node."""
    masks = [sum(((1 << n) - 1) << at for at, n in runs) for runs in combinations(RUNS, 2)]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    nodes = distinct.select("id", "fp", F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in signed))).alias("mask", "node"))
    crowded = (
        nodes.groupBy("mask", "node").count().where(F.col("count") > NODE_ROWS)
        .select("mask", "node", F.ceil(F.col("count") / NODE_ROWS).cast("int").alias("blocks"))
    )
    blocks = F.coalesce("blocks", F.lit(1))
    dealt = (
        nodes.join(crowded, ["mask", "node"], "left")
        .withColumn("own", F.pmod(F.xxhash64("fp"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("mask", "node", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "id", "fp")
    )
    key = ["mask", "node", "lo", "hi"]
    spread = dealt.repartition(S.partitions(distinct.sparkSession), *key).sortWithinPartitions(*key)
    return spread.mapInArrow(_links, "a long, b long")


def groups(docs: DataFrame) -> DataFrame:
    """(doc_id, h1, h2, fp, root) for each row of docs: root is the same for all rows of a component."""
    prints = S.stage_table(fingerprints(docs), "fingerprints")
    roots = components(links(prints.where("doc_id is not null").select(F.col("fp").alias("id"), "fp").distinct()))
    return prints.join(roots, prints["fp"] == roots["id"], "left").select("doc_id", "h1", "h2", "fp", F.coalesce("root", "fp").alias("root"))


def near_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) for each row of docs: the smallest doc_id of its component."""
    found = groups(docs)
    lowest = found.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return found.join(lowest, "root").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, grouped: Callable[[DataFrame], DataFrame] = groups, nameless: bool = False) -> DataFrame:
    """docs with one document of each near-duplicate group: the smallest doc_id, once.

    grouped gives (doc_id, h1, h2, root) for each row. Documents are told apart by doc_id and text, so
    a text is never lost because another has its id. Rows without a doc_id stay: they have no order. With
    nameless they are grouped too, under the hash of their text, and come after all that have a doc_id.
    """
    h1, h2 = S.hash_pair(S.text_or_empty("doc.text"))
    own = F.col("doc.doc_id").cast("long")
    rows = docs.select(F.struct("*").alias("doc")).select("doc", (F.coalesce(own, h1) if nameless else own).alias("doc_id"), h1.alias("h1"), h2.alias("h2"))
    last = (F.lit(nameless) & (F.col("doc_id") == F.col("h1"))).alias("last")
    found = grouped(rows.select("doc_id", "doc.text")).where("doc_id is not null").select("root", F.struct(last, "doc_id", "h1", "h2").alias("me")).distinct()
    keeper = found.groupBy("root").agg(F.min("me").alias("keeper"), F.count("*").alias("n")).where("n > 1").select("root", "keeper")
    lost = found.join(keeper, "root").where("me <> keeper").select("me.*").select(*(F.col(c).alias(f"lost_{c}") for c in ("doc_id", "h1", "h2")))
    known = rows.where("doc_id is not null")
    if nameless:
        # Copies without a doc_id share one key, so they are combined before they are joined.
        known = rows.where("doc.doc_id is not null").unionByName(rows.where("doc.doc_id is null").dropDuplicates(["doc_id", "h1", "h2"]))
    kept = known.join(lost, [known[c] == lost[f"lost_{c}"] for c in ("doc_id", "h1", "h2")], "left_anti").dropDuplicates(["doc_id", "h1", "h2"])
    both = kept.select("doc").unionByName(rows.where("doc_id is null").select("doc"))
    return both.select(*(F.col("doc")[c].alias(c) for c in docs.columns))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_groups(S.table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


S.by_value(__name__)
