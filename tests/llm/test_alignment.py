"""Cross-tokenizer alignment against whole-text encodings, dense matrices and plain loops."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from atlasmith.llm import alignment

SF = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "  ", "a", "a ", " a  b", "▁", "x▁y z", "<|endoftext|> and <s> </s> <unk>", "don't  stop\n\n  now ", "日本語のテキスト です", "é à ü", "🙂🙂 ok",
    "\x00 \x1c \x85", "tab\t tab", "a" * 5000, " " * 3000, "same words same words", "same words same words",
]


@pytest.fixture(scope="module")
def libraries():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return a, b


def whole(libraries, pair, text):
    """Ids and byte ends of a whole text from both libraries; None without tokens."""
    if not text:
        return None
    a, b = libraries[0].encode(" " + text, add_special_tokens=False).ids, libraries[1].encode(text)
    x, y = [pair.a_bytes[i] for i in a], [pair.b_bytes[i] for i in b]
    if not b"".join(x) == b"".join(y) == (" " + text).encode():
        return None
    return a, b, np.cumsum([len(v) for v in x]).tolist(), np.cumsum([len(v) for v in y]).tolist()


def brute(libraries, pair, rows):
    """The query's rows by plain loops over whole texts."""
    found, counts = [], Counter()
    for _, text in rows:
        got = whole(libraries, pair, text)
        links = [(i, j) for i, e in zip(got[0], got[2]) for j, f in zip(got[1], got[3]) if e == f] if got and len(got[0]) < 400 else []
        if got and len(got[0]) >= 400:
            at = dict(zip(got[3], got[1]))
            links = [(i, at[e]) for i, e in zip(got[0], got[2]) if e in at]
        counts.update(links)
        found.append((got, links))
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    out = []
    for (doc, _), (got, links) in zip(rows, found):
        if got is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, x, y = got
        cuts = sorted(set(x) & set(y))
        groups, last = [], 0
        for c in cuts:
            groups.append(",".join(str(i) for i, e in zip(a, x) if last < e <= c) + "|" + ",".join(str(i) for i, e in zip(b, y) if last < e <= c))
            last = c
        out.append((doc, len(a), len(b), len(cuts), len(links), sum(counts[v] == best[v[1]] for v in links), sum(counts[v] for v in links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


def result(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def pair():
    return alignment.Pair(*alignment.default_tokenizers())


def test_segments_are_independent(libraries, pair):
    rng, letters = random.Random(1), " \n\t ab éà.,'s12 　日本🙂\x1c\x85 <s>\0ﬁ①Ａ"
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 30)))
        parts = pair.encoded(alignment.segments(text))
        assert [i for x in parts for i in x[0]] == libraries[0].encode(" " + text, add_special_tokens=False).ids, text
        assert [i for x in parts for i in x[1]] == libraries[1].encode(text), text


def test_products_equal_dense_ones():
    rng = np.random.default_rng(2)
    for _ in range(60):
        dense = [rng.integers(0, 3, (rng.integers(0, 6), 5)), rng.integers(0, 3, (5, rng.integers(0, 7)))]
        sparse = [alignment.Csr(np.concatenate(([0], np.cumsum((x > 0).sum(1)))), np.nonzero(x)[1], x[x > 0], x.shape[1]) for x in dense]
        got = alignment.product(*sparse)
        full = np.zeros((len(dense[0]), dense[1].shape[1]), int)
        full[got.rows(), got.indices] = got.data
        assert (full == dense[0] @ dense[1]).all()


def test_links_of_each_kind(spark, pair):
    text = "un token, deux jetons"
    a, b = ([i for x in pair.encoded(alignment.segments(text)) for i in x[k]] for k in (0, 1))
    x, y = ([0, *np.cumsum([len(v[i]) for i in ids]).tolist()] for v, ids in ((pair.a_bytes, a), (pair.b_bytes, b)))
    cuts = [0, *sorted(set(x[1:]) & set(y[1:]))]
    group = lambda at, i: sum(c < at[i + 1] for c in cuts)
    want = {"overlap": {}, "end": {}, "group": {}}
    for i in range(len(a)):
        for j in range(len(b)):
            if (shared := min(x[i + 1], y[j + 1]) - max(x[i], y[j])) > 0:
                want["overlap"][i, j] = shared
            if x[i + 1] == y[j + 1]:
                want["end"][i, j] = 1
            if group(x, i) == group(y, j):
                want["group"][i, j] = 1
    docs = spark.createDataFrame([(7, text), (8, None), (9, "")], "doc_id long, text string")
    for kind, pairs in want.items():
        rows = alignment.links(docs, kind).collect()
        assert {(r["a_at"], r["b_at"]): r["weight"] for r in rows} == pairs and {r["doc_id"] for r in rows} == {7}
        assert all(a[r["a_at"]] == r["a_id"] and b[r["b_at"]] == r["b_id"] for r in rows)
    with pytest.raises(ValueError):
        alignment.links(docs, "other")


def test_query_equals_brute_force(spark, libraries, pair):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert result(alignment.op11_cross_tokenizer(spark, SF)) == sorted(brute(libraries, pair, rows), key=repr)


@pytest.mark.parametrize("hot", [alignment.HOT, 4])
def test_odd_rows_by_broadcast_and_by_shuffle(spark, libraries, pair, hot):
    rows = [(i if i % 7 else None, x) for i, x in enumerate(ODD)]
    docs = spark.createDataFrame([(*r, 5, 6) for r in rows], "doc_id long, text string, row int, pairs int")
    assert result(alignment.digests(docs, hot=hot)) == sorted(brute(libraries, pair, rows), key=repr)


def test_empty_table(spark):
    assert alignment.digests(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_cache_keeps_results(pair, monkeypatch):
    texts = ["one two three", "two " + "long" * 40 + " three", None, "one", "four five six seven"]
    want = alignment.Segments(pair).digest(texts)
    monkeypatch.setattr(alignment, "CACHE_SEGMENTS", 3)
    known = alignment.Segments(pair)
    for _ in range(3):
        for i, text in enumerate(texts):
            got = known.digest([text])
            assert len(known.at) == len(known.texts) == len(known.sizes) <= 3
            s, e = want["ends"][i : i + 2]
            assert got["groups_sha256"] == want["groups_sha256"][i : i + 1] and got["pair"].tolist() == want["pair"][s:e].tolist() and got["n"].tolist() == want["n"][s:e].tolist()
