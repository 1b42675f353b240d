"""Token counts: greedy longest-match pieces, counted by an automaton in linear time.

The vocabulary is a trie. A node's failure link leads to where matching goes on once the pieces of
its string are split off, and each node knows how many pieces that pops. A word is read once, byte
by byte; popped counts add up to its number of pieces, and no piece is ever built.

Words follow the white-space rule, A-Z lower-cased. A vocabulary entry is bytes, and may demand to
end a word (END is its last symbol). A word of which some part is in no entry counts as one unknown
piece. Distinct words are counted once and remembered within a bound, but for long ones, which are
remembered for their text only.

Defined cases. A null or wordless text has no tokens. A null doc_id is carried through. Repeated
rows are counted alike; an empty table gives no rows. Columns of docs pass through with_counts(), but
for n_words and n_tokens, which it replaces.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasmith.llm import _shared as S

END = 256
CACHE_WORDS = 600_000
CACHE_BYTES = 64


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def read_vocabulary(path: str) -> list[tuple[int, ...]]:
    """Entries of a byte-level BPE file as symbols: bytes, and END for the end of a word."""
    with open(path, encoding="utf-8") as file:
        found = json.load(file)
    special = {x["content"] for x in found["added_tokens"]}
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    # Bytes that can't be printed stand as characters from 256 on, in their order.
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}
    suffix = found["model"].get("end_of_word_suffix") or ""
    out = []
    for entry in found["model"]["vocab"]:
        if entry not in special:
            ends = bool(suffix) and entry.endswith(suffix)
            letters = entry[: len(entry) - len(suffix)] if ends else entry
            out.append((*(byte_of[c] for c in letters), *([END] if ends else [])))
    return out


class Matcher:
    """Trie, failure links and popped counts of a vocabulary."""

    def __init__(self, vocabulary: list[tuple[int, ...]]):
        self.next: list[dict[int, int]] = [{}]
        entry = [False]
        for symbols in vocabulary:
            node = 0
            for x in symbols:
                if x not in self.next[node]:
                    self.next[node][x] = len(self.next)
                    self.next.append({})
                    entry.append(False)
                node = self.next[node][x]
            entry[node] = node != 0
        self.fail: list[int | None] = [None] * len(entry)
        self.popped = [0] * len(entry)
        level = [0]
        while level:
            deeper = []
            for parent in level:
                for x, node in self.next[parent].items():
                    deeper.append(node)
                    if entry[node]:
                        self.fail[node], self.popped[node] = 0, 1
                        continue
                    link, count = self.fail[parent], self.popped[parent]
                    while link is not None and x not in self.next[link]:
                        count += self.popped[link]
                        link = self.fail[link]
                    if link is not None:
                        self.fail[node], self.popped[node] = self.next[link][x], count
            level = deeper
        self.ends = any(symbols[-1] == END for symbols in vocabulary if symbols)

    def count(self, word: bytes) -> int:
        """Pieces of a word; 1 if a part of it is in no entry."""
        step, fail, popped = self.next, self.fail, self.popped
        node: int | None = 0
        total = 0
        for x in (*word, END) if self.ends else word:
            while x not in step[node]:
                total += popped[node]
                node = fail[node]
                if node is None:
                    return 1
            node = step[node][x]
        while node:
            total += popped[node]
            node = fail[node]
        return 1 if node is None else total


def with_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """docs with n_words and n_tokens (longs)."""
    path = vocabulary or default_vocabulary()

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        matcher, known = Matcher(read_vocabulary(path)), {}
        for texts in parts:
            rows = []
            for text in texts:
                words = (text or "").encode("utf-8", "surrogatepass").lower().split()
                own: dict[bytes, int] = {}  # Long words: those of this text only.
                for w in set(words).difference(known):
                    (known if len(w) <= CACHE_BYTES else own)[w] = matcher.count(w)
                total = sum(known[w] if w in known else own[w] for w in words) if own else sum(map(known.__getitem__, words))
                rows.append((len(words), total))
                if len(known) > CACHE_WORDS:
                    known.clear()
            yield pd.DataFrame(rows, columns=["n_words", "n_tokens"])

    counted = docs.select(F.struct("*").alias("doc"), F.pandas_udf(run, "n_words long, n_tokens long")(F.col("text")).alias("counts"))
    return counted.select(*(F.col("doc")[c].alias(c) for c in docs.columns if c not in ("n_words", "n_tokens")), "counts.n_words", "counts.n_tokens")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_counts(S.table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_words", "n_tokens")


S.by_value(__name__)
