"""Lempel-Ziv phrase fingerprints against a letter-by-letter parse and whole sets."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from atlasmith.llm import phrases

SF = "/root/testdata/sf0.001"


def plain(text):
    """The phrase set, letter by letter."""
    found, start = set(), 0
    for end in range(1, len(text) + 1):
        if text[start:end] not in found:
            found.add(text[start:end])
            start = end
    return found


def hashed(piece):
    x = sum((ord(c) + 1) * pow(phrases.BASE, i, 1 << 64) for i, c in enumerate(piece)) % (1 << 64)
    for shift, by in phrases.MIX:
        x = (x ^ (x >> shift)) * by % (1 << 64)
    return x >> 32


def smallest(text):
    return sorted({hashed(x) for x in plain(text)})[:128]


def share(a, b):
    if not a or not b:
        return float(a == b)
    union = sorted({*a, *b})[:128]
    return len({*union} & {*a} & {*b}) / len(union)


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for i, (doc, text) in enumerate(order):
        text, other = text or "", order[(i + 1) % len(order)][1] or ""
        k = len(text) // 3
        edited = text[: len(text) - k] + other[:k]
        a, b, c = smallest(text), smallest(edited), smallest(other)
        shown = lambda x: "".join(f"{v:08x}" for v in x)
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), shown(a), shown(b), share(a, b), share(a, c)))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")) for r in df.collect()), key=repr)


def test_phrases_equal_a_letter_by_letter_parse():
    rng = random.Random(3)
    texts = ["", "a", "aa", "a" * 5000, "ab" * 3000, "日本語" * 50] + ["".join(rng.choices("ab é🙂"[: rng.randint(1, 5)], k=rng.randint(0, 300))) for _ in range(300)]
    for text in texts:
        found = phrases.parse(text)
        assert set(found) == plain(text) and len(set(found)) == len(found) and text.startswith("".join(found))
        assert phrases.signature(phrases.Hashes().of(text, found)).tolist() == smallest(text)


def test_signatures_of_hashes_that_repeat():
    rng = np.random.default_rng(5)
    for n, high in ((0, 9), (5, 3), (700, 90), (700, 140), (5000, 10**9), (5000, 200)):
        x = rng.integers(0, high, n).astype(np.uint32)
        assert phrases.signature(x).tolist() == sorted(set(x.tolist()))[:128]


def test_signatures_estimate_the_jaccard_similarity_of_phrase_sets():
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(300)]
    errors = []
    for k in range(40):
        a = " ".join(rng.choices(words, k=1500))
        b = a[: len(a) * k // 40] + " ".join(rng.choices(words, k=1500))[len(a) * k // 40 :]
        x, y = plain(a), plain(b)
        errors.append(phrases.likeness(*(phrases.signature(phrases.Hashes().of(t, phrases.parse(t))) for t in (a, b))) - len(x & y) / len(x | y))
    assert np.abs(errors).max() < 0.16 and abs(np.mean(errors)) < 0.03


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = result(phrases.op12_phrases(spark, SF))
    assert got == brute(rows)
    equal = {}
    for (_, text), r in zip(sorted(rows, key=lambda r: repr(r[0])), sorted(got, key=lambda r: repr(r[0])), strict=True):
        assert equal.setdefault(text, r[3]) == r[3]
    long = [r for r in got if r[1] > 300]
    assert sum(r[5] > r[6] for r in long) > 0.95 * len(long)


ODD = [(5, "Hello hello world"), (9, None), (3, ""), (8, "é🙂" * 40), (7, "same text here"), (6, "same text here"), (1, "x" * 200_000), (4, "a"), (2, "\n\t \x00")]


@pytest.mark.parametrize("n", [1, 2, 9])
def test_odd_rows(spark, n):
    docs = spark.createDataFrame([(*r, "clash", 1) for r in ODD[:n]], "doc_id long, text string, part string, at int")
    assert result(phrases.edited_likeness(docs)) == brute(ODD[:n])


def test_null_and_repeated_ids_and_fingerprint_columns(spark):
    rows = [(1, "one text"), (None, "no id"), (2, "twice"), (2, "twice"), (2, "again")]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, fingerprint string")
    got = result(phrases.edited_likeness(docs))
    assert [r[0] for r in got] == [1, 2, 2, 2, None] and {r[3] for r in got} == {r["fingerprint"] for r in phrases.with_fingerprints(docs).collect()}
    follow = {(r["doc_id"], r["text"]): r["next"] for r in phrases.successors(docs).collect() if r["doc_id"] != 2}
    assert follow[1, "one text"] == "no id" and follow[None, "no id"] in ("twice", "again")
    a = phrases.with_fingerprints(docs).selectExpr("doc_id", "fingerprint a")
    pairs = a.crossJoin(a.selectExpr("a b")).select(phrases.near("a", "b").alias("near"), phrases.F.expr("a = b").alias("same")).collect()
    assert all((r["near"] == 1.0) == r["same"] for r in pairs) and any(r["near"] < 0.5 for r in pairs)


def test_empty_table(spark):
    assert phrases.edited_likeness(spark.createDataFrame([], "doc_id long, text string")).collect() == []
