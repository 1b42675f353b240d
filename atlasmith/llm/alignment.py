"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

A tokenizer's tokens tile the bytes of a text. Its token-byte incidence matrix has a row per token and
a column per byte; multiplied with the transpose of the other tokenizer's, it gives the overlap links,
and their weights are shared bytes. The same product over last bytes alone links tokens that end
together. Bytes at which both end cut the tokens into groups; token-group incidence matrices, multiplied
alike, link the tokens of a group. Matrices are sparse rows (Csr) built from token lengths, products
run row by row after Gustavson, for all rows of a batch at once.

Both tokenizers treat a text's segments independently of each other: a segment starts at a space that
follows a character other than white space (tested against whole texts). Distinct segments are encoded
and multiplied once, and remembered in a task within a bound; a text's result is put together from them.

Corpus-wide counts of id pairs are an aggregation. At most HOT pairs can each hold a HOT-th of all links or
more, so those are sent to every task; the others are joined by shuffle, and none of them is a hot key.

Defined cases. A text that is null or empty, or that one of the tokenizers does not give back byte for
byte after the space in front, has no tokens: zeros and ''. A null doc_id is carried through. Repeated
rows are rows of their own. An empty table gives no rows. Other columns of docs are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasmith.llm import _shared as S

HOT = 1 << 18
#: What a task remembers of segments, and what it works on at once, in bytes of text.
CACHE_SEGMENTS, CACHE_BYTES, BATCH_BYTES = 400_000, 64, 4 << 20
_STARTS = re.compile(r"(?<=\S)(?= )")
_ODD = re.compile(r"\s ")
_KINDS = ("overlap", "end", "group")


@dataclass
class Csr:
    """A sparse matrix by rows: row i has the columns indices[indptr[i]:indptr[i + 1]], with values data."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    n_cols: int

    def rows(self) -> np.ndarray:
        """The row of every entry."""
        return np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))

    def transposed(self) -> Csr:
        order = np.argsort(self.indices, kind="stable")
        indptr = np.concatenate(([0], np.cumsum(np.bincount(self.indices, minlength=self.n_cols))))
        return Csr(indptr, self.rows()[order], self.data[order], len(self.indptr) - 1)


def incidence(starts: np.ndarray, ends: np.ndarray, n_cols: int) -> Csr:
    """Row i has ones at the columns starts[i] to ends[i] - 1."""
    indptr = np.concatenate(([0], np.cumsum(ends - starts)))
    indices = np.arange(indptr[-1]) + np.repeat(starts - indptr[:-1], ends - starts)
    return Csr(indptr, indices, np.ones(len(indices), np.int64), n_cols)


def product(a: Csr, b: Csr) -> Csr:
    """a times b after Gustavson: every entry (i, k) of a adds row k of b, scaled, to row i."""
    sizes = np.diff(b.indptr)[a.indices]
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(b.indptr[a.indices] - (ends - sizes), sizes)
    key = np.repeat(a.rows(), sizes) * max(1, b.n_cols) + b.indices[at]
    key, back = np.unique(key, return_inverse=True)
    data = np.bincount(back, np.repeat(a.data, sizes) * b.data[at], len(key)).astype(np.int64)
    rows, cols = np.divmod(key, max(1, b.n_cols))
    return Csr(np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=len(a.indptr) - 1)))), cols, data, b.n_cols)


def common_ends(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Byte offsets at which tokens of these lengths both end."""
    return np.intersect1d(np.cumsum(a), np.cumsum(b))


def link_matrix(a: np.ndarray, b: np.ndarray, kind: str) -> Csr:
    """Links between tokens of lengths a and b that tile the same bytes: A tokens by B tokens."""
    n = int(a.sum())
    a_ends, b_ends = np.cumsum(a), np.cumsum(b)
    if kind == "overlap":
        return product(incidence(a_ends - a, a_ends, n), incidence(b_ends - b, b_ends, n).transposed())
    if kind == "end":
        return product(incidence(a_ends - 1, a_ends, n), incidence(b_ends - 1, b_ends, n).transposed())
    cuts = common_ends(a, b)
    a_group, b_group = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
    return product(incidence(a_group, a_group + 1, len(cuts)), incidence(b_group, b_group + 1, len(cuts)).transposed())


def segments(text: str) -> list[str]:
    """The segments of a space and the text; joined, they are that."""
    if not _ODD.search(" " + text):
        return [" " + x for x in text.split(" ")]
    return _STARTS.split(" " + text)


class Pair:
    """Tokenizer A, byte-level BPE of a tokenizers file, and B, BPE of a sentencepiece model."""

    def __init__(self, a_path: str, pattern: str, b_path: str):
        import sentencepiece
        import tiktoken

        with open(a_path, encoding="utf-8") as file:
            found = json.load(file)
        special = {x["content"] for x in found["added_tokens"]}
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        # Bytes that can't be printed stand as characters from 256 on, in their order.
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}
        ranks = {bytes(byte_of[c] for c in x): i for x, i in found["model"]["vocab"].items() if x not in special}
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for x, i in ranks.items():
            self.a_bytes[i] = x
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(x[3:5], 16)]) if self.b.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(pieces)]
        self.space = self.b.piece_to_id("▁")
        self.a_names, self.b_names = ([str(i) for i in range(len(x))] for x in (self.a_bytes, self.b_bytes))
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in y], np.int64) for y in (self.a_bytes, self.b_bytes))

    def encoded(self, parts: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """A's and B's ids of each segment; None where their bytes are not the segment's."""
        out = []
        for x, b in zip(parts, self.b.encode([x[1:] for x in parts], num_threads=1), strict=True):
            a, b, whole = self.a.encode_ordinary(x), b if len(x) > 1 else [self.space], x.encode()
            same = b"".join(map(self.a_bytes.__getitem__, a)) == whole == b"".join(map(self.b_bytes.__getitem__, b))
            out.append((a, b) if same else None)
        return out

    def lengths(self, a: list[int], b: list[int]) -> tuple[np.ndarray, np.ndarray]:
        return self.a_sizes[a], self.b_sizes[b]


class Segments:
    """Results of distinct segments: sizes, the groups as text, and the id pairs of tokens that end together."""

    def __init__(self, pair: Pair):
        self.pair = pair
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.texts: list[str] = []
        #: Per segment: A tokens, B tokens (-1: bytes differ), groups, links.
        self.sizes = np.zeros((0, 4), np.int64)
        self.links = np.zeros(0, np.int64)

    def add(self, wanted: set[str]) -> int:
        """Encode what is new. Returns how many segments may stay; the longer ones come last."""
        new = sorted(wanted.difference(self.at), key=len)
        kept = len(self.texts) + sum(len(x) <= CACHE_BYTES for x in new)
        if not new:
            return kept
        found = self.pair.encoded(new)
        a_all = np.array([i for x in found if x for i in x[0]], np.int64)
        b_all = np.array([i for x in found if x for i in x[1]], np.int64)
        n_a, n_b = (np.array([len(x[k]) if x else 0 for x in found], np.int64) for k in (0, 1))
        a, b = self.pair.a_sizes[a_all], self.pair.b_sizes[b_all]
        cuts, a_ends, b_ends = common_ends(a, b), np.cumsum(a), np.cumsum(b)
        matrix = link_matrix(a, b, "end")
        rows = matrix.rows()
        # Segments end where both tokenizers' tokens do, so one product over all of them has no link across.
        owner = np.repeat(np.arange(len(new)), n_a)
        n_links = np.bincount(owner[rows], minlength=len(new))
        last_a, last_b = np.searchsorted(a_ends, cuts) + 1, np.searchsorted(b_ends, cuts) + 1
        n_groups = np.bincount(owner[last_a - 1], minlength=len(new))
        names_a = [self.pair.a_names[i] for i in a_all.tolist()]
        names_b = [self.pair.b_names[i] for i in b_all.tolist()]
        groups, i, j = [], 0, 0
        for k, m in zip(last_a.tolist(), last_b.tolist(), strict=True):
            groups.append(f"{names_a[i]}|{names_b[j]}" if k - i == m - j == 1 else f"{','.join(names_a[i:k])}|{','.join(names_b[j:m])}")
            i, j = k, m
        ends = np.cumsum(n_groups).tolist()
        self.at |= zip(new, range(len(self.texts), len(self.texts) + len(new)), strict=True)
        self.texts += [";".join(groups[e - n : e]) for e, n in zip(ends, n_groups.tolist(), strict=True)]
        n_b[[x is None for x in found]] = -1
        self.sizes = np.concatenate((self.sizes, np.stack((n_a, n_b, n_groups, n_links), 1)))
        self.links = np.concatenate((self.links, a_all[rows] << 32 | b_all[matrix.indices]))
        return kept

    def cut(self, kept: int) -> None:
        """Forget all but the first segments, or all if they are too many."""
        if kept > CACHE_SEGMENTS:
            self.clear()
        elif kept < len(self.texts):
            for x in list(self.at)[kept:]:
                del self.at[x]
            del self.texts[kept:]
            self.sizes = self.sizes[:kept]
            self.links = self.links[: self.sizes[:, 3].sum()]

    def digest(self, texts: list[str | None]) -> dict[str, np.ndarray | list]:
        """Per text: n_a, n_b, n_groups, n_links, groups_sha256, and its distinct id pairs with their counts."""
        parts = [segments(x) if x else [] for x in texts]
        kept = self.add({x for y in parts for x in y})
        at = np.array([self.at[x] for y in parts for x in y], np.int64)
        owner = np.repeat(np.arange(len(texts)), [len(x) for x in parts])
        sizes = self.sizes[at]
        whole = np.bincount(owner, sizes[:, 1] < 0, len(texts)) == 0
        sums = [np.where(whole, np.bincount(owner, sizes[:, k], len(texts)).astype(np.int64), 0) for k in range(4)]
        digests, i = [], 0
        for ok, y in zip(whole.tolist(), parts, strict=True):
            found = ";".join([self.texts[k] for k in at[i : i + len(y)].tolist()]) if ok and y else None
            digests.append("" if found is None else hashlib.sha256(found.encode()).hexdigest())
            i += len(y)
        n = np.where(whole[owner], sizes[:, 3], 0)
        starts = (np.cumsum(self.sizes[:, 3]) - self.sizes[:, 3])[at]
        pairs = self.links[np.arange(n.sum()) + np.repeat(starts - (np.cumsum(n) - n), n)]
        kinds, back = np.unique(pairs, return_inverse=True)
        key, count = np.unique(np.repeat(owner, n) * max(1, len(kinds)) + back, return_counts=True)
        row, kind = np.divmod(key, max(1, len(kinds)))
        self.cut(kept)
        ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(texts))))).astype(np.int32)
        return {"n_a": sums[0], "n_b": sums[1], "n_groups": sums[2], "n_links": sums[3], "groups_sha256": digests, "ends": ends, "pair": kinds[kind], "n": count}


def _batches(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, x in enumerate(texts):
        size += len(x or "")
        if size >= BATCH_BYTES:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def default_tokenizers() -> tuple[str, str, str]:
    """Paths of A and B, and A's pattern of pre-tokens."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model")


def aligned(docs: DataFrame, tokenizers: tuple[str, str, str] | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs) of (doc_id, text); pair: A's id and 32 bits of B's."""
    files = tokenizers or default_tokenizers()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Segments(Pair(*files))
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for s, e in _batches(texts):
                x = known.digest(texts[s:e])
                counted = pa.StructArray.from_arrays([pa.array(x["pair"], pa.int64()), pa.array(x["n"], pa.int64())], ["pair", "n"])
                columns = [batch.column("doc_id")[s:e], *(pa.array(x[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")), pa.array(x["groups_sha256"], pa.string())]
                yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(x["ends"]), counted)], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<struct<pair: long, n: long>>"
    )


def links(docs: DataFrame, kind: str = "overlap", tokenizers: tuple[str, str, str] | None = None) -> DataFrame:
    """(doc_id, a_at, b_at, a_id, b_id, weight): all links of one kind, by place in a text's tokens.

    overlap: tokens that share weight bytes; end: tokens that end together; group: tokens of one group.
    """
    if kind not in _KINDS:
        raise ValueError(f"kind is one of {', '.join(_KINDS)}")
    files = tokenizers or default_tokenizers()
    names = ["doc_id", "a_at", "b_at", "a_id", "b_id", "weight"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(*files)
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = pair.encoded(segments(text)) if text else [None]
                if None in found:
                    continue
                a, b = ([i for x in found for i in x[k]] for k in (0, 1))
                matrix = link_matrix(*pair.lengths(a, b), kind)
                rows, cols = matrix.rows(), matrix.indices
                values = [pa.array([doc] * len(rows), pa.int64()), *(pa.array(x, pa.int64()) for x in (rows, cols, np.array(a)[rows], np.array(b)[cols], matrix.data))]
                yield pa.RecordBatch.from_arrays(values, names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ", ".join(f"{n} long" for n in names))


def pair_counts(found: DataFrame) -> DataFrame:
    """(pair, count, best) of aligned rows: links of the corpus that hold the pair, and whether no pair of its B id has more."""
    counts = found.select(F.explode("pairs").alias("x")).groupBy("x.pair").agg(F.sum("x.n").alias("count"))
    counts = S.stage_table(counts, "pair-counts").withColumn("b", F.col("pair").bitwiseAND((1 << 32) - 1))
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def digests(docs: DataFrame, tokenizers: tuple[str, str, str] | None = None, hot: int = HOT) -> DataFrame:
    """Per row of docs its tokens, groups and links, and how its links stand in the corpus."""
    found = S.stage_table(aligned(docs, tokenizers).withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = S.stage_table(pair_counts(found), "pair-ranks")
    total = counts.agg(F.sum("count")).first()[0] or 0
    often, seldom = counts.where(F.col("count") * hot >= total), counts.where(F.col("count") * hot < total)
    each = found.select("row", F.explode("pairs").alias("x")).select("row", "x.pair", "x.n")
    measured = [F.sum(F.col("n") * F.col("count")).alias("count_sum"), F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best")]
    sums = each.join(F.broadcast(often), "pair").groupBy("row").agg(*measured)
    if not seldom.isEmpty():
        rest = each.join(F.broadcast(often.select("pair")), "pair", "left_anti").join(seldom.hint("merge"), "pair").groupBy("row").agg(*measured)
        sums = sums.unionByName(rest).groupBy("row").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    zero = F.lit(0).cast("long")
    return found.join(sums, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")


def op11_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(S.table(spark, sf_dir, "documents").select("doc_id", "text"))


S.by_value(__name__)
