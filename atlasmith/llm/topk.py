"""Exact top-k search: an impact-ordered index, read score-at-a-time.

Vectors are dealt into groups of BLOCKS blocks of about BLOCK rows, queries into parts of QUERIES; each
pair of a group and a part is one task. A block's index has, for each component, its rows by quantised
impact: LEVELS steps between the least and the greatest value; rows of one level are a posting segment.
For a query, a segment adds between its least and its greatest product. Segments of all components are
read in descending order of their quantised impact, up to the shares in LOOKS; as a component's segments come
one after another, what is read of it between two looks is one stretch of its rows. At a look a row's
score is at most what it has gathered, the doubt that its segments leave and, for each component it was not yet
read in, the best that is unread there; the exact scores of the few rows that look best bound the k-th score from below.
Reading stops only when these bounds prove that few rows can belong to the best k, or none can beat the
k-th score that earlier blocks gave; what remains possible is rescored exactly. Each task gives k rows a
query; the best of all follow from a ranking per query.

Defined cases. Vectors that are null, empty, or hold null or non-finite components take no part.
A shorter vector counts as filled up with zeros. Rows without a vec_id take no part. A repeated
vec_id is asked once, but is a candidate as often as it is there, save for its own query; ties go to
the smaller vec_id. Products and sums are 64-bit integers. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from atlasmith.llm import _shared as S

BLOCK, BLOCKS, QUERIES, LEVELS = 8192, 2, 8192, 256
K = 10
SCALE = 1024
LOOKS = (0.35, 0.45, 0.55, 0.65, 0.75, 0.85, 1.0)  # shares of the postings after which the bounds are looked at
FEW, SHARE = 16, 32  # times k, or a part of the block: so many possible members are rescored without further reading


class ImpactIndex:
    """Posting segments of a block of integer vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        n, width = self.vectors.shape
        least, most = self.vectors.min(axis=0), self.vectors.max(axis=0)
        self.level = ((self.vectors - least) * LEVELS // (most - least + 1)).astype(np.uint8)
        #: For each component, its rows by level, and the least and the greatest value of each one's segment.
        self.rows = np.argsort(self.level, axis=0, kind="stable").T.copy()
        # The segments of all components one after another: component, level, first posting, size, least and greatest value.
        key = (np.take_along_axis(self.level.T, self.rows, axis=1).astype(np.int64) + LEVELS * np.arange(width)[:, None]).ravel()
        self.starts = np.flatnonzero(np.concatenate(([True], np.diff(key) > 0)))
        self.component, self.levels = key[self.starts] // LEVELS, key[self.starts] % LEVELS
        self.sizes = np.diff(np.append(self.starts, n * width))
        values = np.take_along_axis(self.vectors.T, self.rows, axis=1).ravel().astype(np.float64)
        self.low, self.high = np.minimum.reduceat(values, self.starts), np.maximum.reduceat(values, self.starts)
        self.lows, self.highs = (np.repeat(x, self.sizes).reshape(width, n) for x in (self.low, self.high))
        #: The first segment of each component, and the one after its last.
        self.first, self.end = np.searchsorted(self.component, np.arange(width)), np.searchsorted(self.component, np.arange(width), "right")
        #: Postings read and held, over all queries so far.
        self.read = self.held = 0

    def best(self, query_id: int, query: np.ndarray, k: int, least_score: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the best k rows but the query's own, ties by id; rows under least_score may lack."""
        n, width = self.vectors.shape
        q = query.astype(np.float64)
        of_segment, up = q[self.component], q > 0
        a, b = of_segment * self.low, of_segment * self.high
        under, over = np.minimum(a, b), np.maximum(a, b)
        base = np.minimum.reduceat(under, self.first)
        over -= base[self.component]
        # What a row's segments leave open of its products, at most.
        blur = np.maximum.reduceat(over + base[self.component] - under, self.first).sum()
        slack = 1e-9 * (1 + np.abs(base).sum() + np.maximum.reduceat(over, self.first).sum())
        order = np.argsort(-over)
        component, ends = self.component[order], np.cumsum(self.sizes[order])
        gathered = np.zeros(n)
        others = self.ids != query_id
        left = int(others.sum())
        wanted = least_score - base.sum()
        possible, at, done = np.flatnonzero(others), 0, np.zeros(width, np.int64)
        few, bound = max(FEW * k, n // SHARE), -np.inf
        self.held += n * width
        for share in LOOKS if left > k else ():
            upto = max(at + 1, int(np.searchsorted(ends, share * n * width, "right")))
            if at == len(order):
                break
            # A component's segments are read from one end of its rows, so what a look adds lies together.
            now = done + np.bincount(component[at:upto], minlength=width)
            at = min(upto, len(order))
            begin, stop = np.where(up, self.end - now, self.first + done), np.where(up, self.end - done, self.first + now)
            edges = np.append(self.starts, n * width)
            begin, stop = edges[begin] - n * np.arange(width), edges[stop] - n * np.arange(width)
            some = [d for d in range(width) if begin[d] < stop[d]]
            rows = np.concatenate([self.rows[d, begin[d] : stop[d]] for d in some])
            added = np.concatenate([(self.lows if up[d] else self.highs)[d, begin[d] : stop[d]] * q[d] - base[d] for d in some])
            gathered += np.bincount(rows, added, minlength=n)
            self.read += len(rows)
            done = now
            # The best that is unread in each component; rows that have it there, or less, are those beyond its level.
            open_ = done < self.end - self.first
            following = np.where(up, self.end - 1 - done, self.first + done)[open_]
            top, edge = np.zeros(width, np.float32), np.zeros(width, np.int64)
            top[open_], edge[open_] = over[following], self.levels[following]
            unread = np.where(up, self.level <= edge.astype(np.uint8), self.level >= edge.astype(np.uint8))
            best_case = gathered + blur + unread.astype(np.float32) @ top * (1 + 1e-5)
            # The exact scores of those that look best say how good the k-th is at least.
            likely = np.argpartition(np.where(others, best_case, -np.inf), n - min(n, 4 * k))[n - min(n, 4 * k) :]
            likely = likely[others[likely]]
            if len(likely) >= k:
                bound = max(bound, float(np.partition(self.vectors[likely] @ query, len(likely) - k)[len(likely) - k]) - base.sum())
            possible = np.flatnonzero(others & (best_case >= max(wanted, bound) - slack))
            if len(possible) <= few:
                break
        scores = self.vectors[possible] @ query
        first = np.lexsort((self.ids[possible], -scores))[:k]
        return self.ids[possible][first], scores[first]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = column.combine_chunks()
    lengths = np.asarray(pc.list_value_length(lists)).astype(np.int64)
    out = np.zeros((len(lists), width), np.int64)
    row = np.repeat(np.arange(len(lists)), lengths)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = np.asarray(lists.flatten())
    return out


def _search(vectors: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The k best rows of a group for each query, block by block with the k-th score carried on."""
    found: list[tuple] = []
    if len(vectors) and len(queries):
        width = max(pc.max(pc.list_value_length(t["v"])).as_py() for t in (vectors, queries))
        ids, matrix = vectors["vec_id"].to_numpy(), _matrix(vectors["v"], width)
        asked = list(zip(queries["vec_id"].to_pylist(), _matrix(queries["v"], width), strict=True))
        best = {i: (np.empty(0, np.int64), np.empty(0, np.int64)) for i, _ in asked}
        # One index at a time: all queries pass it, then it goes.
        for start in range(0, len(ids), BLOCK):
            index = ImpactIndex(ids[start : start + BLOCK], matrix[start : start + BLOCK])
            for query_id, query in asked:
                own_ids, own = best[query_id]
                more_ids, more = index.best(query_id, query, k, own[-1] if len(own) == k else -np.inf)
                own_ids, own = np.concatenate([own_ids, more_ids]), np.concatenate([own, more])
                first = np.lexsort((own_ids, -own))[:k]
                best[query_id] = own_ids[first], own[first]
        found = [(query_id, int(i), int(s)) for query_id, (own_ids, own) in best.items() for i, s in zip(own_ids, own, strict=True)]
    return pa.table({name: pa.array([x[i] for x in found], pa.int64()) for i, name in enumerate(("query_id", "vec_id", "score"))})


def quantised(embedding: Column) -> Column:
    """floor(1024 x) of each component as long; null if a component is null or not finite."""
    x = embedding.cast("array<double>")
    whole = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(whole & (F.size(x) > 0), F.transform(x, lambda v: F.floor(v * SCALE).cast("long")))


def search(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best vectors for each query; both have (vec_id, v)."""
    queries = queries.dropDuplicates(["vec_id"])
    n, asked = vectors.count(), queries.count()
    blocks, query_blocks = max(1, -(-n // (BLOCK * BLOCKS))), max(1, -(-asked // QUERIES))
    every = lambda count, name: F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)
    # Groups are dealt by row, so that a vector that many rows repeat fills no single one.
    left = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(blocks)).cast("int")).select("*", every(query_blocks, "part"))
    right = queries.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int")).select("*", every(blocks, "block"))
    found = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(
        lambda a, b: _search(a, b, k), "query_id long, vec_id long, score long"
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = S.table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long"), quantised(F.col("embedding")).alias("v")).where("vec_id is not null and v is not null")
    return search(vectors, vectors.where("vec_id % 100 = 0"))


ORACLE = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
"""

S.by_value(__name__)
