"""Document fingerprints from Lempel-Ziv phrases: likeness in the sense of shared compression, without compressing.

A text is parsed into dictionary phrases: the next phrase is the shortest piece that no phrase before
equals. Texts that one dictionary would compress well share phrases. The set of phrases is hashed (a
polynomial of the code points modulo 2^64, mixed, its upper 32 bits), and its fingerprint is the SIGNATURE
smallest distinct hashes, ascending, eight hex digits each. Of two fingerprints the smallest hashes of both together are a random
sample of the union, and the share of them in both estimates the Jaccard similarity; sets of no more than
SIGNATURE phrases are compared exactly.

To meet its next document, a text is dealt with its neighbours by ranges of doc_id and sorted there; one
text more per range is the first of the next range. So texts are shuffled once, and no range is one task
with all rows. An edited text shares the phrases of what it keeps, and only the rest is parsed again.

Defined cases. A null text is empty; an empty text has no phrases and the fingerprint ''. Two empty sets
are alike (1.0), an empty one and another are not (0.0). A null doc_id comes after all others. Rows that
repeat a doc_id are rows of their own, in the order of a hash of their texts. A document on its own is its
own next one. An empty table gives no rows. Columns of docs pass through with_fingerprints(), but for
fingerprint, which it replaces; successors() reads doc_id and text only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasmith.llm import _shared as S

SIGNATURE = 128
#: The polynomial's base, odd, and the shifts and factors that mix its value.
BASE, MIX = 0x9E3779B97F4A7C15, ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB))
#: Where the search for a phrase's end begins at most; it goes on from there letter by letter.
GUESS, ROWS = 8, 256
_FIRST_ID = -(1 << 63)


def parse(text: str, start: int = 0, known: set[str] | None = None) -> list[str]:
    """The phrases of text from start on. known has all phrases before; with each, it has all that each starts with."""
    known = set() if known is None else known
    found, n, guess = [], len(text), 1
    while start < n:
        end = min(n, start + guess)
        piece = text[start:end]
        if piece in known:
            while piece in known and end < n:
                end += 1
                piece = text[start:end]
            if piece in known:
                break
        else:
            while end - start > 1 and (shorter := text[start : end - 1]) not in known:
                piece, end = shorter, end - 1
        known.add(piece)
        found.append(piece)
        guess = min(end - start, GUESS)
        start = end
    return found


class Hashes:
    """Hashes of a text's phrases, all at once: from sums of letters times powers of BASE, a phrase's polynomial is a difference."""

    def __init__(self) -> None:
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        while len(self.powers) < n:
            size = len(self.powers)
            self.powers, self.inverse = (np.concatenate((x, x * np.uint64(pow(base, size, 1 << 64)))) for x, base in ((self.powers, BASE), (self.inverse, pow(BASE, -1, 1 << 64))))

    def of(self, text: str, found: list[str]) -> np.ndarray:
        """text starts with the phrases found, one after another."""
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ends = np.cumsum(sizes)
        n = int(ends[-1]) if len(ends) else 0
        self._reach(n)
        letters = np.frombuffer(text[:n].encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(letters * self.powers[:n], dtype=np.uint64)))
        x = (sums[ends] - sums[ends - sizes]) * self.inverse[ends - sizes]
        for shift, by in MIX:
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
        return (x >> np.uint64(32)).astype(np.uint32)


def signature(found: np.ndarray) -> np.ndarray:
    """The smallest distinct hashes."""
    some = found
    if len(found) > 4 * SIGNATURE:
        some = np.partition(found, 2 * SIGNATURE)[: 2 * SIGNATURE]
    some = np.sort(some)
    some = some[np.concatenate(([True], some[1:] != some[:-1]))] if len(some) else some
    return some[:SIGNATURE] if len(some) >= SIGNATURE or len(found) <= 4 * SIGNATURE else np.unique(found)[:SIGNATURE]


def shown(found: np.ndarray) -> str:
    return found.astype(">u4").tobytes().hex()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4").astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity of two phrase sets from their signatures."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.concatenate((a, b))
    both.sort()
    twice = both[1:] == both[:-1]
    first = np.concatenate(([True], ~twice))
    union = np.cumsum(first)
    return float(np.count_nonzero(twice & (union[1:] <= SIGNATURE)) / min(union[-1], SIGNATURE))


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """docs with the fingerprint of each whole text."""

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = Hashes()
        for texts in parts:
            yield pd.Series([shown(signature(known.of(x or "", parse(x or "")))) for x in texts], dtype=object)

    return docs.withColumn("fingerprint", F.pandas_udf(run, "string")("text"))


def near(a: str | Column, b: str | Column) -> Column:
    """Likeness of two columns of fingerprints."""

    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else likeness(read(p), read(q)) for p, q in zip(x, y, strict=True)], dtype=float)

    # Given as objects: annotations of this module are strings.
    run.__annotations__ = {"x": pd.Series, "y": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "double")(a, b)


def _range_of(docs: DataFrame) -> Column:
    """The number of the range that column at is in, from the highest ids on; ranges are cut at approximate quantiles."""
    parts = max(1, S.partitions(docs.sparkSession))
    cuts = sorted({int(x) for x in docs.approxQuantile("at", [i / parts for i in range(1, parts)], 1 / (4 * parts))}) if parts > 1 else []
    step = max(1, int(len(cuts) ** 0.5))
    # The cut below is looked up among every step-th cut first, then among those of its step.
    above = lambda values: F.size(F.filter(values, lambda c: c < F.col("at")))
    coarse = F.array(*map(F.lit, cuts[::step])).cast("array<long>")
    fine = F.array(*(F.array(*map(F.lit, cuts[i : i + step])) for i in range(0, len(cuts), step))).cast("array<array<long>>")
    block = above(coarse)
    below = F.when(block == 0, 0).otherwise((block - 1) * step + above(F.get(fine, block - 1)))
    return (F.lit(len(cuts)) - below).cast("int")


def successors(docs: DataFrame) -> DataFrame:
    """(doc_id, text, next): each row's text and that of its next document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending = None
        for batch in batches:
            rows = []
            for part, tail, doc, text in zip(*(batch.column(c).to_pylist() for c in ("part", "tail", "doc_id", "text")), strict=True):
                if pending is not None and pending[0] == part:
                    rows.append((*pending[1:], text))
                pending = None if tail else (part, doc, text)
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], t) for i, t in enumerate((pa.int64(), pa.string(), pa.string()))], ["doc_id", "text", "next"])

    return _dealt(docs).mapInArrow(run, "doc_id long, text string, next string")


def _dealt(docs: DataFrame) -> DataFrame:
    """(part, tail, doc_id, text): rows by range and descending doc_id; the tail of a range is the first row of the next."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), S.text_or_empty("text").alias("text")).withColumn("at", F.coalesce("doc_id", F.lit(_FIRST_ID)))
    part = _range_of(rows.select("at"))
    # A row per range: ids only.
    heads = sorted((r["part"], r["at"]) for r in rows.select("at", part.alias("part")).groupBy("part").agg(F.max("at").alias("at")).collect())
    follows = [(at, heads[i - 1][0]) for i, (_, at) in enumerate(heads)]
    wanted = F.broadcast(spark.createDataFrame(follows, "at long, part int"))
    tails = rows.join(wanted, "at").groupBy("part").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    whole = rows.withColumn("part", part).withColumn("tail", F.lit(False)).unionByName(tails.withColumn("tail", F.lit(True)), allowMissingColumns=True)
    dealt = whole.withColumn("hash", F.xxhash64("text")).repartition(S.partitions(spark), "part")
    return dealt.sortWithinPartitions("part", "tail", F.desc("at"), "hash").select("part", "tail", "doc_id", "text")


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and its likeness to that and to the next document.

    The edited text has the last third of the text's code points replaced by as many of the next document's first ones.
    """
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())

    def compared(known: Hashes, doc: int, text: str, found: list[str], hashed: np.ndarray, own: np.ndarray, other: str, next_one: np.ndarray) -> tuple:
        kept = len(text) - len(text) // 3
        edited = text[:kept] + other[: len(text) // 3]
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        n = int(np.searchsorted(ends, kept, "right"))
        start = int(ends[n - 1]) if n else 0
        more = parse(edited, start, set(found[:n]))
        changed = signature(np.concatenate((hashed[:n], known.of(edited[start:], more))))
        return doc, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), shown(own), shown(changed), likeness(own, changed), likeness(own, next_one)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, known = None, Hashes()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                done = []
                for part, tail, doc, text in zip(*(batch.column(c)[start : start + ROWS].to_pylist() for c in ("part", "tail", "doc_id", "text")), strict=True):
                    found = parse(text)
                    hashed = known.of(text, found)
                    own = signature(hashed)
                    if pending is not None and pending[0] == part:
                        done.append(compared(known, *pending[1:], text, own))
                    pending = None if tail else (part, doc, text, found, hashed, own)
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], t) for i, t in enumerate(kinds)], names)

    return _dealt(docs).mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(S.table(spark, sf_dir, "documents").select("doc_id", "text"))


S.by_value(__name__)
