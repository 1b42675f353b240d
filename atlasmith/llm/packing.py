"""Packing: fill training sequences with lexical neighbours from a sharded BM25 index.

Texts are turned into token ids once and staged (word_pieces.py). Whole windows of long documents are
sequences of their own; what is left of each document (less than a window), its tail, is dealt into
shards of about SHARD_TOKENS tokens by what it says, so that neighbours meet:

* a map of the tokens is fitted on a bounded sample (FIT_DOCS documents, lowest by hash): weighted token
  vectors are halved again and again at the median of their main direction, CELL_BITS times;
* each tail has the cell of the map that it falls into and, within it, the least hash of its tokens;
  this code has CODE_BITS bits. Neighbouring codes fill a shard together; a code with more tokens than
  a shard is dealt into several by hash.

A shard's task builds an inverted index of its tails with document frequencies of all whole
documents, takes the longest unused tail as seed, and fills the seed's window with unused neighbours
by descending BM25 score: those that fit whole first, then the best one, cut at the window's end; the
rest of a cut tail seeds the next window. So every window is full, and a shard's last, partial window
is cut into lengths that are powers of two: no padding at all. With shard_tokens of the whole corpus
there is one shard, and neighbours are exact; README gives the share that smaller shards hold.

Defined cases. A null text is empty: one end token. A null doc_id is carried through. Repeated rows
are packed once each. An empty table gives no pieces. Other columns of docs are not read. The result
does not depend on how files split the rows, but for rows that repeat both doc_id and text.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasmith.llm import _shared as S
from atlasmith.llm.word_pieces import Encoder

WINDOW = 4096
SHARD_TOKENS = 1 << 19
K1, B = 1.2, 0.75
FIT_DOCS, DIMENSIONS, CELL_BITS, CODE_BITS = 2048, 256, 8, 16
SLICE_BYTES = 4 << 20
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of about SLICE_BYTES of text, a row at least."""
    before = np.concatenate(([0], np.cumsum(np.array([len(x.as_py() or "") for x in batch.column("text")]))))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(before, before[at] + SLICE_BYTES, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def _tail(ids: np.ndarray) -> np.ndarray:
    return ids[len(ids) // WINDOW * WINDOW :]


@dataclass
class Map:
    """Cells of lexically near texts: a tree of directions and cuts, over weighted and hashed token vectors."""

    weight: np.ndarray
    directions: np.ndarray
    cuts: np.ndarray

    @staticmethod
    def hashed(token: np.ndarray) -> np.ndarray:
        return (token.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)

    def vectors(self, distinct: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """One row of length 1 for each text's distinct tokens and their counts."""
        row = np.repeat(np.arange(len(distinct)), [len(t) for t, _ in distinct])
        token = np.concatenate([np.empty(0, np.int64), *(t for t, _ in distinct)]).astype(np.int64)
        count = np.concatenate([np.empty(0), *(c for _, c in distinct)])
        h = self.hashed(token)
        place = row * DIMENSIONS + (h >> np.uint64(40)).astype(np.int64) % DIMENSIONS
        known = self.weight[np.minimum(token, len(self.weight) - 1)]
        value = known * count / (count + K1) * np.where(h >> np.uint64(63), 1.0, -1.0)
        found = np.bincount(place, value, minlength=len(distinct) * DIMENSIONS).reshape(len(distinct), DIMENSIONS)
        return found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-9)

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        node = np.ones(len(vectors), np.int64)
        for _ in range(CELL_BITS):
            node = 2 * node + (np.einsum("ij,ij->i", vectors, self.directions[node]) > self.cuts[node])
        return node - (1 << CELL_BITS)

    def codes(self, distinct: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        least = np.array([int(self.hashed(t).min() >> np.uint64(64 - CODE_BITS + CELL_BITS)) if len(t) else 0 for t, _ in distinct], np.int64)
        return (self.cells(self.vectors(distinct)) << (CODE_BITS - CELL_BITS)) + least


def fit_map(docs: DataFrame, tokenizer: str) -> Map:
    """The map of a sample of FIT_DOCS documents; their distinct tail tokens are all that reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        for batch in batches:
            for part in slices(batch):
                ids, starts = encoder.batch(part.column("text"))
                found = [np.unique(_tail(ids[s:e]), return_counts=True) for s, e in zip(starts[:-1], starts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([x[i].astype("<i4").tobytes() for x in found], pa.binary()) for i in (0, 1)], ["token", "count"])

    # About twice as many rows by a hash, equal ones once, then the exact number: no task sorts a share of all rows.
    place = F.xxhash64("doc_id", "text")
    some = docs.where(F.pmod(place, F.lit(max(1, docs.count() // (2 * FIT_DOCS)))) == 0).distinct()
    rows = some.orderBy(place, "doc_id", "text").limit(FIT_DOCS).select("text").mapInArrow(run, "token binary, count binary").toArrow().to_pylist()
    distinct = [(np.frombuffer(t, "<i4"), np.frombuffer(c, "<i4")) for t, c in sorted((r["token"], r["count"]) for r in rows)]
    seen = np.bincount(np.concatenate([np.zeros(1, np.int64), *(t for t, _ in distinct)]))
    # A token that the sample lacks weighs as one that a single document has; they come last.
    weight = np.append(np.log(1 + (len(distinct) + 0.5) / (seen + 0.5)), np.log(1 + (len(distinct) + 0.5) / 1.5))
    found = Map(weight, np.zeros((1 << CELL_BITS, DIMENSIONS)), np.zeros(1 << CELL_BITS))
    vectors, random = found.vectors(distinct), np.random.default_rng(11)
    node = np.ones(len(vectors), np.int64)
    for depth in range(CELL_BITS):
        for k in range(1 << depth, 2 << depth):
            own = vectors[node == k]
            if len(own) < 4:
                continue
            own = own - own.mean(axis=0)
            direction = random.normal(size=DIMENSIONS)
            for _ in range(10):
                direction = own.T @ (own @ direction)
                direction /= max(float(np.linalg.norm(direction)), 1e-12)
            found.directions[k], found.cuts[k] = direction, np.median(vectors[node == k] @ direction)
        node = 2 * node + (np.einsum("ij,ij->i", vectors, found.directions[node]) > found.cuts[node])
    return found


def encoded(docs: DataFrame, tokenizer: str, lexical: Map) -> DataFrame:
    """A row per document: ids and place; and a row per task: in how many of its documents each token is (df).

    (doc_id, doc_tokens, crcs of whole windows, tail: ids after them as little-endian bytes of width
    wide, code of the map, copy: which of the task's equal rows it is, df).
    """
    schema = "doc_id long, doc_tokens long, crcs array<long>, tail binary, wide int, code int, copy long, df binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, equal = Encoder(tokenizer), Counter()
        df = np.zeros(encoder.tokenizer.get_vocab_size(), np.int64)
        names = [x.split()[0] for x in schema.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
        for batch in batches:
            for part in slices(batch):
                flat, starts = encoder.batch(part.column("text"))
                ids = [flat[s:e] for s, e in zip(starts[:-1], starts[1:], strict=True)]
                tails = [_tail(x) for x in ids]
                distinct = [np.unique(x, return_counts=True) for x in tails]
                for x, tail, (token, _) in zip(ids, tails, distinct, strict=True):
                    df[token if len(tail) == len(x) else np.unique(x)] += 1
                crcs = [[crc(x[s : s + WINDOW]) for s in range(0, len(x) - len(tail), WINDOW)] for x, tail in zip(ids, tails, strict=True)]
                copies = []
                for key in zip(part.column("doc_id").to_pylist(), map(crc, ids), strict=True):
                    copies.append(equal[key])
                    equal[key] += 1
                columns = [part.column("doc_id"), list(map(len, ids)), crcs, [x.tobytes() for x in tails], [int(encoder.kind[-1])] * len(ids), lexical.codes(distinct), copies, [None] * len(ids)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) if not isinstance(c, pa.Array) else c for c, k in zip(columns, kinds, strict=True)], names)
        yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip([None] * 7 + [df.astype("<i8").tobytes()], kinds, strict=True)], names)

    return docs.mapInArrow(run, schema)


def document_frequencies(staged: DataFrame) -> dict[int, int]:
    """In how many documents each token is; as many entries as the vocabulary has tokens at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for x in batch.column("df"):
                one = np.frombuffer(x.as_py(), "<i8")
                total = one + total if len(total) else one
        token = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(token.astype(np.int64)), pa.array(total[token])], ["token", "n"])

    counts = staged.where("df is not null").select("df").mapInArrow(run, "token long, n long")
    return {r["token"]: r["n"] for r in counts.groupBy("token").agg(F.sum("n").alias("n")).collect()}


def shard_plan(tokens: np.ndarray, shard_tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, parts) for each code: its first shard, and over how many its rows are dealt."""
    first, parts = np.zeros(len(tokens), np.int64), np.ones(len(tokens), np.int64)
    shard, held = 0, 0
    for code in np.flatnonzero(tokens).tolist():
        n = int(tokens[code])
        if held and held + n > shard_tokens:
            shard, held = shard + 1, 0
        first[code], parts[code] = shard, -(-n // shard_tokens)
        shard, held = (shard, held + n) if parts[code] == 1 else (shard + parts[code], 0)
    return first, parts


class ShardIndex:
    """BM25 postings of one shard's documents, by token."""

    def __init__(self, ids: list[np.ndarray], idf: np.ndarray, mean_length: float):
        self.own = [np.unique(x, return_counts=True) for x in ids]
        sizes = [len(t) for t, _ in self.own]
        doc = np.repeat(np.arange(len(ids)), sizes)
        token = np.concatenate([t for t, _ in self.own]).astype(np.int64)
        tf = np.concatenate([c for _, c in self.own]).astype(np.float64)
        length = np.array([len(x) for x in ids])[doc]
        weight = idf[token] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / max(mean_length, 1)))
        order = np.argsort(token, kind="stable")
        self.doc, self.weight, self.n = doc[order], weight[order], len(ids)
        self.starts = np.searchsorted(token[order], np.arange(len(idf) + 1))

    def scores(self, seed: int) -> np.ndarray:
        tokens = self.own[seed][0]
        start, stop = self.starts[tokens], self.starts[tokens.astype(np.int64) + 1]
        sizes = stop - start
        at = np.repeat(start - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
        return np.bincount(self.doc[at], self.weight[at], minlength=self.n)


def fill(lengths: np.ndarray, neighbours, window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length) that hold every token of every document once.

    neighbours(i) gives the scores of all documents for seed i.
    """
    left, begun = lengths.copy(), np.zeros(len(lengths), np.int64)
    order, sequences, at, carry = np.argsort(-lengths, kind="stable"), [], 0, None

    def put(sequence: list, i: int, n: int) -> int:
        sequence.append((int(i), int(begun[i]), int(n)))
        begun[i] += n
        left[i] -= n
        return n

    while True:
        while at < len(order) and not left[order[at]]:
            at += 1
        if carry is None and at == len(order):
            break
        seed, sequence = order[at] if carry is None else carry, []
        room = window - put(sequence, seed, min(left[seed], window))
        carry = seed if left[seed] else None
        if room and (open_ := np.flatnonzero(left)).size:
            ranked = open_[np.argsort(-neighbours(seed)[open_], kind="stable")]
            for i in ranked[np.flatnonzero(left[ranked] <= room)]:
                if left[i] <= room:
                    room -= put(sequence, i, left[i])
                if not room:
                    break
            rest = ranked[left[ranked] > 0]
            if room and len(rest):
                carry = rest[0]
                room -= put(sequence, carry, room)
        sequences.append(sequence)
    last = sequences.pop() if sequences else []
    return sequences + powers(last)


def powers(sequence: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """The same pieces, cut into sequences whose lengths are powers of two."""
    total, out = sum(n for _, _, n in sequence), []
    pieces = list(reversed(sequence))
    while total:
        size = room = 1 << (total.bit_length() - 1)
        out.append([])
        while room:
            i, start, n = pieces.pop()
            used = min(n, room)
            out[-1].append((i, start, used))
            room -= used
            if n > used:
                pieces.append((i, start + used, n - used))
        total -= size
    return out


def pack_shard(rows: pa.Table, idf: np.ndarray, mean_length: float) -> pa.Table:
    """All pieces of one shard."""
    rows = rows.sort_by([("doc_id", "ascending"), ("doc_tokens", "ascending"), ("tail", "ascending")])
    doc_ids, tokens, shard = rows["doc_id"].to_pylist(), rows["doc_tokens"].to_pylist(), rows["shard"][0].as_py()
    tails = [np.frombuffer(t, f"<u{w}") for t, w in zip(rows["tail"].to_pylist(), rows["wide"].to_pylist(), strict=True)]
    out: list[tuple] = []
    sequence = shard << 32
    for doc_id, n, crcs in zip(doc_ids, tokens, rows["crcs"].to_pylist(), strict=True):
        for k, value in enumerate(crcs):
            out.append((doc_id, k * WINDOW, WINDOW, value, n, sequence, 0))
            sequence += 1
    some = [i for i, x in enumerate(tails) if len(x)]
    if some:
        index = ShardIndex([tails[i] for i in some], idf, mean_length)
        for pieces in fill(np.array([len(tails[i]) for i in some]), index.scores):
            offset = 0
            for k, start, n in pieces:
                i = some[k]
                before = tokens[i] - len(tails[i])
                out.append((doc_ids[i], before + start, n, crc(tails[i][start : start + n]), tokens[i], sequence, offset))
                offset += n
            sequence += 1
    names = [x.split()[0] for x in PIECES.split(", ")]
    return pa.table({name: pa.array([x[k] for x in out], pa.int64()) for k, name in enumerate(names)})


def pack(docs: DataFrame, tokenizer: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per piece; see PIECES."""
    tokenizer = tokenizer or default_tokenizer()
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), S.text_or_empty(docs["text"]).alias("text"))
    staged = S.stage_table(encoded(texts, tokenizer, fit_map(texts, tokenizer)), "token-ids")
    rows = staged.where("df is null")
    # At most 2 ** CODE_BITS rows reach the driver, and go to all tasks again as a plan.
    sizes = rows.groupBy("code").agg(F.count("*").alias("n"), F.sum(F.length("tail") / F.col("wide")).cast("long").alias("tokens")).toArrow()
    tokens = np.zeros(1 << CODE_BITS, np.int64)
    tokens[sizes["code"].to_numpy()] = sizes["tokens"].to_numpy()
    first, parts = shard_plan(tokens, shard_tokens)
    n, frequency = int(sizes["n"].to_numpy().sum()), document_frequencies(staged)
    seen = np.zeros(max(frequency, default=0) + 1)
    seen[list(frequency)] = list(frequency.values())
    idf = np.log(1 + (n - seen + 0.5) / (seen + 0.5)).astype(np.float32)
    mean_length = int(tokens.sum()) / max(1, n)
    used = np.unique(sizes["code"].to_numpy())
    plan = docs.sparkSession.createDataFrame(pa.table({"code": pa.array(used, pa.int32()), "first": pa.array(first[used]), "parts": pa.array(parts[used])}))
    part = F.pmod(F.xxhash64("doc_id", "doc_tokens", F.crc32("tail"), "copy"), F.col("parts"))
    dealt = rows.join(F.broadcast(plan), "code").withColumn("shard", F.col("first") + part)
    return dealt.select("shard", "doc_id", "doc_tokens", "crcs", "tail", "wide").groupBy("shard").applyInArrow(lambda group: pack_shard(group, idf, mean_length), PIECES)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(S.table(spark, sf_dir, "documents").select("doc_id", "text"))


S.by_value(__name__)
