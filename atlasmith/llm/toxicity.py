"""Toxicity: a counterfactually regularised linear classifier.

Features are the distinct words of a text and their prefixes, hashed. A logistic regression is
fitted on a bounded sample of labelled documents (MAX_TOXIC and MAX_CLEAN rows, the lowest of a hash
of doc_id, of which the first MAX_BYTES of compressed features; class weights restore the share that toxic has
among all labels). Each labelled document gives a pair of counterfactual twins. Its sentences with
identity terms are paired with the same sentences in which each term is swapped for another of its
kind or, for every second document, left out. A document without any such term has a neutral mention
of a group put into one of its sentences. The fit penalises the squared change of the score within
pairs, so that a mention of a group carries little weight, whichever labels it is seen with. Inverse document frequencies are part of the fitted model. All documents are then scored where they
lie, each from its whole text; the model is one array of fixed size.

Defined cases. A null or wordless text gets the model's base score. A null doc_id is never held
out. Labels without a document, and null labels, teach nothing; repeated labels of one document
count once, as toxic if any of them is. Without any label, scores are 0. Repeated rows are scored
alike. Columns of docs pass through; score and predicted replace columns of these names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atlasmith.llm import _shared as S

MAX_TOXIC, MAX_CLEAN, MAX_BYTES = 4000, 8000, 32 << 20
THRESHOLD = 0.3
SIZE = 1 << 18
PREFIXES = (3, 4, 5, 6)
EPOCHS, STEP, RIDGE, SWAP_PENALTY = 40, 0.5, 1e-6, 1.0
#: Words whose features a task remembers, up to so many letters each; texts that it works on at once.
CACHE_WORDS, LONG_WORD, SLICE = 65_536, 32, 256

#: Identity terms by kind; a swap stays within its kind.
IDENTITY = {
    "gender": ("woman", "man", "girl", "boy", "female", "male"),
    "genders": ("women", "men", "girls", "boys", "females", "males"),
    "faith": ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    "faiths": ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    "orientation": ("gay", "lesbian", "straight", "bisexual", "queer", "heterosexual"),
    "origin": ("african", "asian", "european", "american", "arab", "mexican", "chinese", "indian"),
    "origins": ("africans", "asians", "europeans", "americans", "arabs", "mexicans", "indians"),
    "colour": ("black", "white", "brown", "latino", "hispanic"),
    "ability": ("deaf", "blind", "disabled", "autistic", "elderly", "young"),
}
_KIND = {term: kind for kind, terms in IDENTITY.items() for term in terms}
_TERMS = tuple(_KIND)
_WORDS = re.compile(r"[^\W_]+")
_SENTENCES = re.compile(r"[.!?\n]+")


def words_of(text: str | None) -> list[str]:
    return list(dict.fromkeys(_WORDS.findall((text or "").lower())))


def features_of(word: str) -> list[int]:
    parts = ["=" + word, *(word[:n] for n in PREFIXES if len(word) > n)]
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) % SIZE for x in parts]


def swapped(word: str) -> str:
    """Another identity term of the same kind; other words stay."""
    if word not in _KIND:
        return word
    terms = IDENTITY[_KIND[word]]
    return terms[(terms.index(word) + 1) % len(terms)]


def twins(text: str | None) -> tuple[list[str], list[str]]:
    """The words of a document's counterfactual pair; both empty if it has no word."""
    sentences = [w for w in map(_WORDS.findall, _SENTENCES.split((text or "").lower())) if w]
    if not sentences:
        return [], []
    turn = zlib.crc32((text or "").encode("utf-8", "surrogatepass"))
    found = [w for words in sentences if any(w in _KIND for w in words) for w in words]
    if found:
        other = [swapped(w) for w in found] if turn % 2 else [w for w in found if w not in _KIND]
    else:
        found = sentences[turn % len(sentences)]
        other = [*found, _TERMS[turn // 7 % len(_TERMS)]]
    return list(dict.fromkeys(found)), list(dict.fromkeys(other))


def _pack(words: list[str]) -> bytes:
    """The distinct features of words: their steps, byte by byte, compressed; a few bits a feature."""
    found = np.unique(np.array([f for w in words for f in features_of(w)], "<i4"))
    return zstandard.ZstdCompressor(level=1).compress(np.diff(found, prepend=0).astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpack(packed: bytes) -> np.ndarray:
    steps = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(steps.T).view("<i4").ravel(), dtype=np.int32)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            part = batch.slice(start, SLICE)
            texts = part.column("text").to_pylist()
            packed = [[_pack(w) for w in side] for side in (map(words_of, texts), *zip(*map(twins, texts), strict=True))]
            columns = [part.column("doc_id"), part.column("toxic"), *(pa.array(x, pa.binary()) for x in packed)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "toxic", "features", "plain", "other"])


@dataclass
class Model:
    base: float
    weight: np.ndarray  # of each feature, times its inverse document frequency
    square: np.ndarray  # of each feature's inverse document frequency

    def logit(self, features: np.ndarray) -> float:
        return self.base + self.weight[features].sum() / max(1e-6, self.square[features].sum()) ** 0.5

    def scores(self, texts: list[str | None], known: dict[str, bytes] | None = None) -> np.ndarray:
        """known: packed features of words, kept from call to call, CACHE_WORDS at most."""
        known = {} if known is None else known
        out = np.empty(len(texts))
        for i, text in enumerate(texts):
            found = []
            for w in words_of(text):
                features = known.get(w)
                if features is None:
                    features = np.array(features_of(w), "<i4").tobytes()
                    if len(w) <= LONG_WORD:
                        known[w] = features
                found.append(features)
            features = np.sort(np.frombuffer(b"".join(found), "<i4"))
            out[i] = self.logit(features[np.append(True, features[1:] != features[:-1])[: len(features)]])
            if len(known) > CACHE_WORDS:
                known.clear()
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def constant(toxic: bool) -> Model:
    return Model(30.0 if toxic else -30.0, np.zeros(SIZE), np.zeros(SIZE))


def _rows(packed: pa.ChunkedArray | list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Where the rows of a sparse matrix start, and its features."""
    arrays = [_unpack(x if isinstance(x, bytes) else x.as_py()) for x in packed]
    return np.cumsum([0, *map(len, arrays)]), np.concatenate([np.empty(0, np.int32), *arrays])


class Examples:
    """Labels, and the features of each labelled document and of its pair of twins."""

    def __init__(self, toxic, features, plain, other):
        self.y = np.asarray(toxic, np.float64)
        self.whole, *self.sides = (_rows(x) for x in (features, plain, other))


def fit(examples: Examples, toxic_share: float, swap_penalty: float = SWAP_PENALTY) -> Model:
    """A model whose scores are calibrated on two halves, each scored by the model of the other. Deterministic."""
    y, every = examples.y, np.arange(len(examples.y))
    model = _fit(examples, every, toxic_share, swap_penalty)
    folds = np.random.default_rng(3).permutation(len(y)) % 2
    logits = np.zeros(len(y))
    if min(y.sum(), len(y) - y.sum()) < 10:
        return model
    start, feature = examples.whole
    for fold in (0, 1):
        other = _fit(examples, every[folds != fold], toxic_share, swap_penalty)
        logits[folds == fold] = [other.logit(feature[start[i] : start[i + 1]]) for i in every[folds == fold]]
    slope, base = _platt(logits, y, _costs(y, toxic_share))
    return Model(slope * model.base + base, (model.weight * slope).astype(np.float32), model.square)


def _costs(y: np.ndarray, toxic_share: float) -> np.ndarray:
    return np.where(y == 1, toxic_share / y.mean(), (1 - toxic_share) / (1 - y.mean()))


def _platt(z: np.ndarray, y: np.ndarray, cost: np.ndarray) -> tuple[float, float]:
    """Slope and base of the logistic curve from scores to labels, by Newton steps under a weak prior."""
    x, w = np.stack([z, np.ones(len(z))], axis=1), np.array([1.0, 0.0])
    prior = np.diag([1e-2, 1e-2])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (cost * (p - y)) + prior @ (w - np.array([1.0, 0.0]))
        curve = (x * (cost * p * (1 - p))[:, None]).T @ x + prior
        w = w - np.clip(np.linalg.solve(curve, slope), -2, 2)
    return float(max(w[0], 0.1)), float(w[1])


def _fit(examples: Examples, some: np.ndarray, toxic_share: float, swap_penalty: float) -> Model:
    """Minibatch AdaGrad on weighted log loss, ridge and counterfactual penalty, over some of the examples."""
    y = examples.y[some]
    if not len(y) or y.min() == y.max():
        return constant(bool(len(y)) and y[0] == 1)
    n = len(y)
    start, feature = examples.whole
    seen = np.zeros(SIZE)
    for i in some:
        seen[feature[start[i] : start[i + 1]]] += 1
    idf = np.log(1 + n / (1 + seen))
    cost = _costs(y, toxic_share)
    sides = examples.sides
    paired = some[np.diff(sides[0][0])[some] > 0]
    weight, power, base, base_power = np.zeros(SIZE), np.full(SIZE, 1e-8), float(np.log(toxic_share / (1 - toxic_share))), 1e-8
    random = np.random.default_rng(7)
    batch = min(256, max(16, n // 16))  # small samples still get some hundred steps

    def take(rows: np.ndarray, start: np.ndarray, feature: np.ndarray, length: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, feature and value of each entry of the rows, divided by the given lengths or by their own."""
        row = np.repeat(np.arange(len(rows)), start[rows + 1] - start[rows])
        f = np.concatenate([feature[start[i] : start[i + 1]] for i in rows])
        if length is None:
            length = np.sqrt(np.bincount(row, idf[f] ** 2, minlength=len(rows)))
        return row, f, idf[f] / length[row]

    def step(slope: np.ndarray) -> None:
        np.add(power, slope * slope, out=power)
        np.subtract(weight, STEP * slope / np.sqrt(power), out=weight)

    for _ in range(EPOCHS):
        order = random.permutation(n)
        for rows in np.array_split(order, max(1, n // batch)):
            row, f, v = take(some[rows], *examples.whole)
            z = np.bincount(row, weight[f] * v, minlength=len(rows)) + base
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) * cost[rows] / len(rows)
            step(np.bincount(f, error[row] * v, minlength=SIZE) + RIDGE * weight)
            base_power += error.sum() ** 2
            base -= STEP * error.sum() / base_power**0.5
        for rows in np.array_split(random.permutation(len(paired)), max(1, len(paired) // 1024)) if len(paired) else []:
            # Both of a pair are divided by the first one's length, so that what they share cancels out.
            rows = paired[rows]
            row, f, _ = take(rows, *sides[0])
            length = np.sqrt(np.bincount(row, idf[f] ** 2, minlength=len(rows)))
            parts = [take(rows, *side, length) for side in sides]
            change = sum(sign * np.bincount(r, weight[f] * v, minlength=len(rows)) for sign, (r, f, v) in zip((1, -1), parts, strict=True))
            pull = 2 * swap_penalty * change / len(rows)
            slope = sum(sign * np.bincount(f, pull[r] * v, minlength=SIZE) for sign, (r, f, v) in zip((1, -1), parts, strict=True))
            step(slope)
    return Model(base, (weight * idf).astype(np.float32), (idf * idf).astype(np.float32))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN, max_bytes: int = MAX_BYTES) -> Model:
    """Fit on labelled docs outside the held-out quarter; only the bounded sample's features reach the driver.

    The sample is bounded in rows and in bytes. Of several texts under one doc_id the first by hash counts.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    counts = known.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
    if not counts["n"]:
        return constant(toxic=False)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = known.where("toxic = 1").orderBy(*order).limit(max_toxic).unionByName(known.where("toxic = 0").orderBy(*order).limit(max_clean))
    # The sample has max_toxic + max_clean short rows at most: that bounds the broadcast.
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    packed = chosen.mapInArrow(_examples, "doc_id long, toxic int, features binary, plain binary, other binary")
    first = packed.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("features"), "toxic", "features", "plain", "other")).alias("one")).select("doc_id", "one.*")
    size = F.sum(F.length("features") + F.length("plain") + F.length("other"))
    # A window over the sample alone, whose rows are bounded.
    upto = size.over(Window.partitionBy("toxic").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    examples = first.withColumn("upto", upto).where(F.col("upto") <= max_bytes // 2).drop("upto").orderBy("doc_id").toArrow()
    return fit(Examples(examples["toxic"].to_numpy(), *(examples[c] for c in ("features", "plain", "other"))), min(max(counts["toxic"] / counts["n"], 1e-4), 1 - 1e-4))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with score (0 to 1) and predicted (1 from THRESHOLD on)."""

    def scored(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[str, bytes] = {}
        for texts in parts:
            each = (texts.slice(start, SLICE).to_pylist() for start in range(0, len(texts), SLICE))
            yield pa.array(np.concatenate([np.empty(0), *(model.scores(x, known) for x in each)]))

    of = F.arrow_udf(scored, T.DoubleType())
    with_score = docs.select(*(docs[c] for c in docs.columns if c not in ("score", "predicted")), of(docs["text"]).alias("score"))
    return with_score.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = S.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, S.table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


S.by_value(__name__)
