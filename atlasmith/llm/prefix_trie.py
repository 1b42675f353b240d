"""Conversation prefix trie, peeled from its deepest level by truncation.

A node is a distinct sequence of first turns. Nothing is known of the nodes in advance: at depth d the
sequences that end there meet the nodes that survive from depth d + 1, each with its last turn stripped,
and what is equal is one node. One grouping per depth finds the nodes and adds up all that holds for
their subtrees. Equal conversations are one sequence before the first level, and groupings add up in the
tasks that read, so a turn that most conversations start with is a few rows where it is shuffled.

A sequence is known by the exclusive-or of its turns' 128-bit hashes, each mixed with its place, so that
stripping a turn is one more exclusive-or. A row carries the hashes of its turns (not their texts).

Depths above a cut are peeled in tasks, so that long conversations make no level of jobs for each of their
turns: sequences that share the turns up to the cut meet in one task in the order of their hashes, and
as one diverges from the one before, nodes are stripped down to where they part. A task holds
one path at a time. The cut is CUT turns, or deeper if more than CROWD sequences share those. From the cut down
to the root each depth is a grouping of its own, written before the next one reads it.

Ids of conversations that end at a node are joined in pieces of neighbouring ids and hashed in a
stream. Children find their parent's id by a join; parents of HOT_CHILDREN and more, of which there are
at most one per so many nodes, are sent to every task.

Defined cases. Turns with a null conv_id are left out. A null role or text is empty; a null turn comes
first; rows of equal turn are ordered by a hash of role and text, so repeated rows are repeated turns. A
conversation without turns is a member of the root. An empty table has no nodes. Other columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from atlasmith.llm import _shared as S

#: A conversation takes fewer than SHARED first turns from the first of its BLOCK of ids.
BLOCK, SHARED = 100, 6
CHUNK_BITS, HOT_CHILDREN = 10, 1 << 16
#: Turns up to which each depth is a level of its own, and how many sequences that share them a task peels.
CUT, CROWD = 8, 1 << 20
_KEY = ["depth", "k1", "k2"]
_NODE = [*_KEY, "p1", "p2", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, h1, h2, size): turns in order, from 0; size in code points."""
    role, text = S.text_or_empty("role"), S.text_or_empty("text")
    hashes = dict(zip(("h1", "h2"), S.hash_pair(role, text), strict=True))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), "turn", *(c.alias(n) for n, c in hashes.items()), F.char_length(text).cast("long").alias("size"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "h1", "h2")
    return rows.select("conv_id", (F.row_number().over(order) - 1).alias("pos"), "h1", "h2", "size")


def shared_heads(turns: DataFrame, block: int = BLOCK, shared: int = SHARED) -> DataFrame:
    """(conv_id, part, pos, h1, h2, size): conversations rebuilt, their first turns taken from the first of their block.

    turns should be a stage table. Rows of part 0 come first; part null: the conversation itself.
    """
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(shared)).cast("int")
    ids = turns.select("conv_id").distinct()
    heads = turns.where((F.col("conv_id") % block == 0) & (F.col("pos") < shared - 1)).withColumnRenamed("conv_id", "base")
    first = ids.withColumn("base", F.col("conv_id") - F.col("conv_id") % block).join(heads, "base").where(F.col("pos") < taken).withColumn("part", F.lit(0))
    own = turns.where(F.col("pos") >= taken).withColumn("part", F.lit(1))
    names = ["conv_id", "part", "pos", "h1", "h2", "size"]
    return first.select(names).unionByName(own.select(names)).unionByName(ids, allowMissingColumns=True)


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, k1, k2, path) of (conv_id, part, pos, h1, h2, size): each conversation as one row of hashes."""
    turn = F.when(F.col("part").isNotNull(), F.struct("part", "pos", "h1", "h2", "size"))
    placed = lambda x, i: F.struct(F.xxhash64(i, x["h1"], x["h2"]).alias("h1"), F.xxhash64(x["h2"], i, x["h1"]).alias("h2"), x["size"].alias("size"))
    paths = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("path")).withColumn("path", F.transform("path", placed))
    xor = lambda h: F.aggregate("path", F.lit(0).cast("long"), lambda known, x: known.bitwiseXOR(x[h]))
    return paths.select("conv_id", F.size("path").alias("depth"), xor("h1").alias("k1"), xor("h2").alias("k2"), "path")


def ended(found: DataFrame) -> DataFrame:
    """Equal sequences in pieces: (depth, k1, k2, chunk, conv_id, n, ids, path)."""
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    return found.groupBy(*_KEY, F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"), ids.alias("ids"), F.any_value("path").alias("path"))


def end_hashes(pieces: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256): of the ids of equal sequences, ascending, comma-joined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def rows(found: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], t) for i, t in enumerate(kinds)], ["depth", "k1", "k2", "ends_sha256"])

        for batch in batches:
            done = []
            for *new, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "k1", "k2", "ids")), strict=True):
                if new == key:
                    state.update(b"," + ids.encode())
                    continue
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = new, hashlib.sha256(ids.encode())
            yield rows(done)
        if key is not None:
            yield rows([(*key, state.hexdigest())])

    spread = pieces.select(*_KEY, "chunk", "ids").repartition(S.partitions(pieces.sparkSession), *_KEY).sortWithinPartitions(*_KEY, "chunk")
    return spread.mapInArrow(run, "depth int, k1 long, k2 long, ends_sha256 string")


def _prefix_key(n: int) -> list[Column]:
    """The key of the first n turns of a path."""
    xor = lambda h: F.aggregate(F.slice("path", 1, n), F.lit(0).cast("long"), lambda known, x: known.bitwiseXOR(x[h]))
    return [xor("h1"), xor("h2")]


def cut_of(ending: DataFrame, most: int) -> int:
    """The depth from which on sequences are peeled in tasks: no more than CROWD share their turns up to it."""
    cut = CUT
    while cut < most:
        k1, k2 = _prefix_key(cut)
        crowd = ending.where(F.col("depth") > cut).groupBy(k1.alias("k1"), k2.alias("k2")).count().agg(F.max("count")).first()[0]
        if crowd <= CROWD:
            break
        cut *= 2
    return min(cut, most)


def deep_nodes(ending: DataFrame, cut: int) -> DataFrame:
    """All nodes deeper than cut, peeled in one pass over sorted sequences; path up to the cut for those right below it."""
    shown = pa.list_(pa.struct([("h1", pa.int64()), ("h2", pa.int64()), ("size", pa.int64())]))
    kinds = dict(zip(_NODE, (pa.int32(), *[pa.int64()] * 9), strict=True)) | {"path": shown}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, base = None, []
        #: Open nodes below the cut: hashes, size, key, then conv_id, n_convs, n_children, n_leaves, saved_tokens.
        stack: list[list] = []
        done: list[tuple] = []

        def strip(left: int) -> None:
            while len(stack) > left:
                h1, h2, size, k1, k2, conv, n, children, leaves, saved = stack.pop()
                leaves, saved = leaves or 1, saved + (n - 1) * size
                done.append((cut + len(stack) + 1, k1, k2, k1 ^ h1, k2 ^ h2, conv, n, children, leaves, saved, None if stack else [{"h1": x[0], "h2": x[1], "size": x[2]} for x in base]))
                if stack:
                    parent = stack[-1]
                    parent[5] = conv if parent[5] is None else min(parent[5], conv)
                    parent[6] += n
                    parent[7] += 1
                    parent[8] += leaves
                    parent[9] += saved

        def taken() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], t) for i, t in enumerate(kinds.values())], list(kinds))
            done.clear()
            return out

        for batch in batches:
            paths = batch.column("path")
            ends, turns = paths.offsets.to_pylist(), paths.flatten()
            turns = list(zip(*(turns.field(i).to_pylist() for i in range(3)), strict=True))
            ends = [x - ends[0] for x in ends]
            for i, (g1, g2, conv, n) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("g1", "g2", "conv_id", "n")), strict=True)):
                path = turns[ends[i] : ends[i + 1]]
                if group != (g1, g2):
                    strip(0)
                    group, base = (g1, g2), path[:cut]
                same = 0
                while same < len(stack) and same < len(path) - cut and stack[same][0] == path[cut + same][0] and stack[same][1] == path[cut + same][1]:
                    same += 1
                strip(same)
                k1, k2 = stack[-1][3:5] if stack else group
                for h1, h2, size in path[cut + same :]:
                    k1, k2 = k1 ^ h1, k2 ^ h2
                    stack.append([h1, h2, size, k1, k2, None, 0, 0, 0, 0])
                stack[-1][5:7] = conv, n
                if len(done) > 10_000:
                    yield taken()
        strip(0)
        yield taken()

    g1, g2 = _prefix_key(cut)
    rows = ending.where(F.col("depth") > cut).select(g1.alias("g1"), g2.alias("g2"), "conv_id", "n", "path")
    spread = rows.repartition(S.partitions(ending.sparkSession), "g1", "g2").sortWithinPartitions("g1", "g2", "path")
    return spread.mapInArrow(run, f"depth int, {', '.join(f'{c} long' for c in _NODE[1:])}, path array<struct<h1: long, h2: long, size: long>>")


def level(depth: int, ending: DataFrame, deeper: DataFrame | None) -> DataFrame:
    """Nodes of one depth: sequences that end there, and deeper nodes without their last turn; path of their own turns."""
    zero = F.lit(0).cast("long")
    live = ending.select("k1", "k2", "conv_id", F.col("n").alias("n_convs"), zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved_tokens"), "path")
    if deeper is not None:
        stripped = deeper.select(F.col("p1").alias("k1"), F.col("p2").alias("k2"), "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens", F.slice("path", 1, depth).alias("path"))
        live = live.unionByName(stripped)
    nodes = live.groupBy("k1", "k2").agg(F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")), F.any_value("path").alias("path"))
    last = F.get("path", F.lit(depth - 1))
    leaves = F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("long")
    named = {
        "depth": F.lit(depth), "p1": F.col("k1").bitwiseXOR(last["h1"]), "p2": F.col("k2").bitwiseXOR(last["h2"]), "n_leaves": leaves,
        "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * (last["size"] if depth else zero),
    }
    return nodes.withColumns(named).select(*_NODE, "path")


def peeled(pieces: DataFrame) -> DataFrame | None:
    """All nodes, from the deepest to the root; None if there is no conversation."""
    whole = pieces.groupBy(*_KEY).agg(F.min("conv_id").alias("conv_id"), F.sum("n").alias("n"), F.any_value("path").alias("path"))
    ending = S.stage_table(whole, "sequences")
    most = ending.agg(F.max("depth")).first()[0]
    if most is None:
        return None
    cut = cut_of(ending, most)
    found, deeper = [], None
    if most > cut:
        found = [S.stage_table(deep_nodes(ending, cut), "nodes")]
        deeper = found[0].where(F.col("depth") == cut + 1)
    for depth in range(cut, -1, -1):
        deeper = S.stage_table(level(depth, ending.where(F.col("depth") == depth), deeper), "nodes")
        found.append(deeper)
    return reduce(DataFrame.unionByName, (x.select(*_NODE) for x in found))


def with_parents(nodes: DataFrame, hot: int = HOT_CHILDREN) -> DataFrame:
    """nodes with parent_conv_id."""
    children = nodes.where("depth > 0")
    keys = ["depth", "p1", "p2"]
    parents = nodes.where("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("n"))
    is_hot = (F.col("n") >= hot) | (F.col("depth") == 1)
    crowded = F.broadcast(parents.where(is_hot).drop("n"))
    some = children.join(crowded, keys)
    rest = children.join(crowded.drop("parent_conv_id"), keys, "left_anti").join(parents.where(~is_hot).drop("n"), keys)
    return some.unionByName(rest).drop("p1", "p2").unionByName(nodes.where("depth = 0").drop("p1", "p2"), allowMissingColumns=True)


def trie(found: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of all nodes of sequences()."""
    pieces = S.stage_table(ended(found), "ended")
    nodes = peeled(pieces)
    if nodes is None:
        return found.sparkSession.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    whole = with_parents(nodes).join(end_hashes(pieces), _KEY, "left")
    return whole.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations as they are."""
    return trie(sequences(numbered(conversations).withColumn("part", F.lit(1))))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = S.stage_table(numbered(S.table(spark, sf_dir, "conversations")), "turns")
    return trie(sequences(shared_heads(turns)))


#: CRC-32 is folded byte by byte, bit by bit, as DuckDB has no function for it.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))))"""
ORACLE = f"""WITH turns AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
  ids AS (SELECT conv_id, {_CRC} % {SHARED} AS h FROM (SELECT DISTINCT conv_id FROM turns)),
  parts AS (SELECT i.conv_id, 0 AS part, pos, role, text FROM ids i JOIN turns t ON t.conv_id = i.conv_id - i.conv_id % {BLOCK} AND pos < h
    UNION ALL SELECT conv_id, 1, pos, role, text FROM ids JOIN turns USING (conv_id) WHERE pos >= h),
  paths AS (SELECT conv_id, coalesce(list(md5(length(role) || ':' || role || text) ORDER BY part, pos) FILTER (part IS NOT NULL), []) AS path, coalesce(list(length(text) ORDER BY part, pos) FILTER (part IS NOT NULL), []) AS sizes FROM ids LEFT JOIN parts USING (conv_id) GROUP BY 1),
  members AS (SELECT conv_id, d, path[1:d] AS node, CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size, d = len(path) AS ends FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM paths)),
  nodes AS (SELECT d, node, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM members GROUP BY 1, 2),
  children AS (SELECT d - 1 AS d, node[1:d - 1] AS node, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
  counted AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (d, node)),
  subtrees AS (SELECT e AS d, node[1:e] AS node, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM (SELECT *, unnest(range(d + 1)) AS e FROM counted) GROUP BY ALL)
  SELECT c.conv_id, c.d AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens, c.ends_sha256
  FROM counted c JOIN subtrees USING (d, node) LEFT JOIN counted p ON p.d = c.d - 1 AND p.node = c.node[1:c.d - 1]"""

S.by_value(__name__)
