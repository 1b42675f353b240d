"""Dealt operators: brute force, round trips and edge cases on small inputs."""

import hashlib
import tracemalloc
import zlib
from itertools import combinations

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from atlasmith.llm import _shared, catalog, licenses, line_dedup, media, mixing, near_copies, packing, simhash, substring, token_counts, topk, toxicity
from atlasmith.llm.components import components

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i}" for i in range(60))
ODD = [
    (1, "Hello World. " + LONG, "en", "src1", 10), (2, "x " + LONG + " y", None, None, None), (3, None, "de", "src2", 0), (4, "", None, "src2", 0), (5, "Hello World. " + LONG, "en", "src1", 10), (5, "Hello World. " + LONG, "en", "src1", 10),
    (None, LONG, "en", "src3", 5), (6, "a" * 300_000, "fr", "web", 7), (7, ("same line of more than forty characters here\n" * 3) + "tail", "es", "src9", 8), (8, "é ü\t\x0b nbsp Z", "es", "src9", 8),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).withColumns({"fp": F.lit("clash"), "tokens": F.lit(1.5), "_id": F.lit(3), "score": F.lit("s"), "starts": F.array(F.lit(1)), "_h1": F.lit(0)})


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df, want = catalog.QUERIES[name](spark, SF), con.sql(catalog.ORACLES[name])
    columns = sorted(df.columns)
    at = [want.columns.index(c) for c in columns]
    assert sorted(repr([r[c] for c in columns]) for r in df.collect()) == sorted(repr([r[i] for i in at]) for r in want.fetchall())


def test_every_operator_takes_odd_and_empty_tables(spark, odd, empty):
    model = toxicity.train(odd, spark.createDataFrame([(1, 1), (2, 0), (99, 1), (3, None)], "doc_id long, toxic int"))
    runs = [
        line_dedup.drop_frequent_lines, substring.dedup, simhash.near_groups, simhash.keep_one, lambda d: toxicity.score(d, model), lambda d: mixing.selected(mixing.measured(d)), mixing.select_docs, packing.pack,
        token_counts.with_counts, licenses.scan, lambda d: media.clips(media.with_avi(d)),
    ]
    for run in runs:
        assert run(empty).count() == 0
        assert run(odd).count() >= 0
    for keeps in (line_dedup.drop_frequent_lines, lambda d: toxicity.score(d, model), token_counts.with_counts):
        assert keeps(odd).count() == len(ODD)
    assert topk.search(spark.createDataFrame([], "vec_id long, v array<long>"), spark.createDataFrame([], "vec_id long, v array<long>")).count() == 0


def test_odd_rows_have_defined_results(spark, odd):
    """Nulls, empty and long texts, repeated rows and clashing columns, each with the result that the operators state."""
    whole = "Hello World. " + LONG
    found = sorted(((r["doc_id"] or 0, r["n_words"], r["n_removed"], r["kept"]) for r in substring.dedup(odd).collect()), key=repr)
    want = [(0, 60, 0, LONG), (1, 62, 0, whole), (2, 62, 60, "x y"), (3, 0, 0, ""), (4, 0, 0, ""), (5, 62, 62, ""), (5, 62, 62, ""), (6, 1, 0, "a" * 300_000), (8, 4, 0, "é ü nbsp Z")]
    assert [r for r in found if r[0] != 7] == sorted(want, key=repr)
    assert {r["starts"][0] for r in substring.dedup(odd).collect() if "starts" in r.asDict()} <= {1}
    parts = {(r["doc_id"], r["component_id"]) for r in simhash.near_groups(odd).where("doc_id is not null").collect()}
    assert {(1, 1), (5, 1), (3, 3), (4, 3)} <= parts
    kept = simhash.keep_one(odd).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] in (1, 3, 4, 5)) == [1, 3] and sum(r["doc_id"] is None for r in kept) == 1 and {r["fp"] for r in kept} == {"clash"}
    pieces = packing.pack(odd).collect()
    assert sorted((r["doc_id"], r["doc_tokens"], r["length"]) for r in pieces if r["doc_id"] in (3, 4)) == [(3, 1, 1), (4, 1, 1)]
    one = {i: next(r["doc_tokens"] for r in pieces if r["doc_id"] == i) for i in (1, 5, 6)}
    assert one[1] == one[5]
    # Rows that repeat an id are packed each: both hold all their tokens.
    assert {i: sum(r["length"] for r in pieces if r["doc_id"] == i) for i in one} == {1: one[1], 5: 2 * one[5], 6: one[6]}
    assert licenses.scan(odd).where("license is not null").count() == 0


def test_stages_take_odd_and_empty_tables(spark, odd, empty):
    """Every filtering stage keeps the columns, clashing ones with their values, and an empty table empty."""
    clashing = odd.withColumns({"predicted": F.lit("p"), "n_dropped": F.lit("d"), "n_lines": F.lit(None).cast("string"), "doc": F.lit("c"), "copy": F.lit(2)})
    columns = clashing.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, clashing, SF)
        assert out.columns == columns and out.dtypes == clashing.dtypes, name
        rows = out.collect()
        assert rows and {(r["score"], r["predicted"], r["n_dropped"], r["n_lines"], r["doc"], r["copy"], r["fp"]) for r in rows} == {("s", "p", "d", None, "c", 2, "clash")}, name
        assert {r["doc_id"] for r in rows} <= {r[0] for r in ODD}, name
        nothing = stage(spark, empty, SF)
        assert nothing.columns == empty.columns and nothing.count() == 0, name
    assert corpus_pipeline.pack_sequences(spark, clashing, SF).count() >= len(ODD) and corpus_pipeline.pack_sequences(spark, empty, SF).count() == 0
    lines = corpus_pipeline.drop_repeated_lines(spark, clashing, SF).collect()
    assert sorted(r["text"] for r in lines) == sorted(x[1] or "" for x in ODD)


def test_media_round_trip_and_shots():
    for _, text, *_ in ODD:
        n, payload = media.payload_of(text)
        found = media._digest(text)
        assert (found[0], found[1], found[2], found[3]) == (n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
    frames = np.repeat(np.array([10, 200, 90], np.uint8), 20)[:, None, None] * np.ones((1, 12, 16), np.uint8)
    clips = media.clips_of(media.write_avi(media.encode_frames(frames)))
    assert [(c.first_frame, c.n_frames, c.start_s) for c in clips] == [(0, 20, 0.0), (20, 20, 0.8), (40, 20, 1.6)]
    assert media.clips_of(b"RIFF....") == [] and media.clips_of(None) == []
    broken = media.encode_frames(frames[:3])
    broken[1] = broken[1][:40]
    assert sum(c.n_frames for c in media.clips_of(media.write_avi(broken))) == 3


def test_topk_is_exact_with_ties():
    rng = np.random.default_rng(0)
    vectors = np.concatenate([rng.integers(-500, 500, (400, 8)), np.tile(rng.integers(-9, 9, (1, 8)), (60, 1))])
    ids = rng.permutation(len(vectors)).astype(np.int64)
    index = topk.ImpactIndex(ids, vectors)
    for i in range(0, len(ids), 23):
        want = sorted(((-int(s), int(d)) for s, d in zip(vectors @ vectors[i], ids, strict=True) if d != ids[i]))[:10]
        got_ids, got = index.best(int(ids[i]), vectors[i], 10)
        assert list(zip((-got).tolist(), got_ids.tolist(), strict=True)) == want


def test_topk_leaves_postings_unread():
    """On the vectors of sf0.1, in blocks with the k-th score carried on: exact results, with a share of the postings never read."""
    rows = duckdb.connect().sql("select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) from read_parquet('/root/testdata/sf0.1/embeddings.parquet') order by 1").fetchall()
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    blocks = [topk.ImpactIndex(ids[i : i + 700], vectors[i : i + 700]) for i in range(0, len(ids), 700)]
    for i in range(0, len(ids), 97):
        best = []
        for block in blocks:
            found = block.best(int(ids[i]), vectors[i], 10, best[-1][0] * -1 if len(best) == 10 else -np.inf)
            best = sorted([*best, *((-int(s), int(d)) for d, s in zip(*found, strict=True))])[:10]
        scores = vectors @ vectors[i]
        assert best == sorted((-int(s), int(d)) for s, d in zip(scores, ids, strict=True) if d != ids[i])[:10]
    share = sum(b.read for b in blocks) / sum(b.held for b in blocks)
    print("share of postings read", share)
    assert share < 0.8


def test_topk_reads_less_at_production_size():
    """Two blocks of BLOCK random directions: exact, also with a score carried on, and over a quarter of the postings is never read."""
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(topk.BLOCK + 300, 64))
    vectors = np.floor(1024 * vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.int64)
    ids = rng.permutation(len(vectors)).astype(np.int64)
    first, second = topk.ImpactIndex(ids[: topk.BLOCK], vectors[: topk.BLOCK]), topk.ImpactIndex(ids[topk.BLOCK :], vectors[topk.BLOCK :])
    for i in range(0, len(ids), len(ids) // 20):
        best = list(zip(*first.best(int(ids[i]), vectors[i], 10), strict=True))
        best += zip(*second.best(int(ids[i]), vectors[i], 10, min(s for _, s in best)), strict=True)
        want = sorted((-int(s), int(d)) for s, d in zip(vectors @ vectors[i], ids, strict=True) if d != ids[i])[:10]
        assert sorted((-int(s), int(d)) for d, s in best)[:10] == want
    assert first.read < 0.75 * first.held


def test_stage_tables_hand_texts_over_in_small_batches(spark):
    """While a stage table is written, no batch of texts that Python gets is much over the bound; the session's setting stays."""
    before = spark.conf.get(_shared.BATCH_SETTING)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([sum(len(x.as_py()) for x in batch.column("text"))])], ["n", "bytes"])

    texts = spark.range(0, 3000, 1, 1).select(F.lpad(F.col("id").cast("string"), 5000, "x").alias("text"))
    rows = _shared.stage_table(texts.mapInArrow(sizes, "n long, bytes long"), "batch-sizes").collect()
    assert sum(r["n"] for r in rows) == 3000 and max(r["bytes"] for r in rows) <= _shared.BATCH_BYTES + 5000
    assert spark.conf.get(_shared.BATCH_SETTING) == before


def test_toxicity_scores_hold_little_in_memory():
    """Texts of 300,000 distinct words: what scoring remembers of words is bounded, and scores are those of the plain rule."""
    rng = np.random.default_rng(4)
    model = toxicity.Model(-0.2, rng.normal(size=toxicity.SIZE).astype(np.float32), rng.random(toxicity.SIZE).astype(np.float32))
    texts = [" ".join(f"w{i}x{k}" for k in range(3000)) for i in range(100)] + [None, "", "Längeres Wort " + "y" * 90]
    tracemalloc.start()
    try:
        got = model.scores(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 40 << 20, peak
    for i in (0, 50, 99, 100, 101, 102):
        z = model.logit(np.unique(np.array([f for w in toxicity.words_of(texts[i]) for f in toxicity.features_of(w)], np.int64)))
        assert got[i] == pytest.approx(1 / (1 + np.exp(-np.clip(z, -30, 30))), abs=1e-6)


def test_simhash_links_and_components(spark):
    rng = np.random.default_rng(1)
    fp = np.unique(np.concatenate([rng.integers(0, 1 << 62, 300, dtype=np.uint64), *(x ^ (np.uint64(1) << rng.integers(0, 62, 40, dtype=np.uint64)) for x in rng.integers(0, 1 << 62, 5, dtype=np.uint64))]))
    rows = [(i, int(x)) for i, x in enumerate(fp.tolist())]
    got = {r["id"]: r["root"] for r in components(simhash.links(spark.createDataFrame(rows, "id long, fp long"))).collect()}
    root = list(range(len(fp)))
    for a, b in combinations(range(len(fp)), 2):
        if (int(fp[a]) ^ int(fp[b])).bit_count() <= 4:
            low, high = sorted((root[a], root[b]))
            root = [low if x == high else x for x in root]
    assert {i: got.get(i, i) for i in range(len(fp))} == dict(enumerate(root))
    assert simhash.fingerprint(None) == simhash.fingerprint(" \t\n") == 0


def test_repeated_ids_lose_no_text(spark):
    """(3, B), (5, A), (5, B): B stays once, A stays although its id has B too; equal rows stay once."""
    a, b = (" ".join(f"{x}{i}" for i in range(30)) for x in "ab")
    docs = spark.createDataFrame([(3, b), (5, a), (5, b), (5, b), (None, b), (7, None), (8, "")], "doc_id long, text string")
    for grouped in (simhash.groups, near_copies.groups):
        kept = simhash.keep_one(docs, grouped).collect()
        assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept) == [(0, b), (3, b), (5, a), (7, "")]
    assert sorted((r["doc_id"], r["component_id"]) for r in simhash.near_groups(docs).where("doc_id is not null").collect()) == [(3, 3), (5, 3), (5, 3), (5, 5), (7, 7), (8, 7)]


def test_crowded_nodes_are_dealt_without_loss(spark, monkeypatch):
    monkeypatch.setattr(simhash, "NODE_ROWS", 8)
    rows = [(i, i) for i in range(64)]  # all within six low bits
    got = {r["id"]: r["root"] for r in components(simhash.links(spark.createDataFrame(rows, "id long, fp long"))).collect()}
    assert got == {i: 0 for i in range(1, 64)}


def test_chain_of_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (None, 3)], "a long, b long")
    assert {r["id"]: r["root"] for r in components(links).collect()} == {**{i: 0 for i in range(1, 41)}, 101: 100}


def test_toxicity_held_out_and_swaps(spark):
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(900):
        toxic = i % 3 == 0
        text = " ".join(rng.choice(words, 25)) + (" vile scum ." if toxic else " .") + (" the muslim neighbours ." if toxic and i % 2 else "")
        docs.append((i, text))
        labels.append((i, int(toxic)))
    d, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    scored = toxicity.score(d, toxicity.train(d, lab)).join(lab, "doc_id").where(toxicity.held_out(F.col("doc_id"))).collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in scored]) > 0.95
    rows = [toxicity._pack(toxicity.words_of(t)) for _, t in docs], [[toxicity._pack(x) for x in side] for side in zip(*(toxicity.twins(t) for _, t in docs), strict=True)]
    examples = toxicity.Examples([t for _, t in labels], rows[0], *rows[1])
    a, b = "the muslim neighbours", "the jewish neighbours"
    gap = lambda m: abs(m.logit(toxicity._unpack(toxicity._pack(a.split()))) - m.logit(toxicity._unpack(toxicity._pack(b.split()))))
    every = np.arange(len(labels))
    assert gap(toxicity._fit(examples, every, 1 / 3, 5.0)) < 0.7 * gap(toxicity._fit(examples, every, 1 / 3, 0.0))


def test_counterfactual_penalty_lowers_false_positives():
    """Group mentions that come with toxic labels only: neutral ones are flagged less, at the production penalty, and order is no worse."""
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(400)]

    def text(toxic, mention):
        parts = [*rng.choice(words, 20), *(["vile"] if toxic and rng.random() < 0.7 else []), *(["scum"] if toxic and rng.random() < 0.7 else [])]
        return " ".join(parts) + f". the {rng.choice(toxicity._TERMS if mention else words)} people here."

    train = [(text(t, t and rng.random() < 0.5), int(t)) for t in (i % 3 == 0 for i in range(1500))]
    pairs = [toxicity.twins(t) for t, _ in train]
    assert all(a and a != b for a, b in pairs)
    packed = [[toxicity._pack(words) for words in side] for side in ([toxicity.words_of(t) for t, _ in train], *zip(*pairs, strict=True))]
    examples = toxicity.Examples([y for _, y in train], *packed)
    neutral, toxic = [text(False, True) for _ in range(300)], [text(True, i % 2) for i in range(300)]
    flagged, auc = {}, {}
    for penalty in (0.0, toxicity.SWAP_PENALTY):
        model = toxicity.fit(examples, 1 / 3, penalty)
        low, high = model.scores(neutral), model.scores(toxic)
        flagged[penalty], auc[penalty] = (low >= toxicity.THRESHOLD).mean(), (high[:, None] > low[None, :]).mean()
    assert flagged[toxicity.SWAP_PENALTY] < 0.6 * flagged[0.0] and auc[toxicity.SWAP_PENALTY] >= auc[0.0], (flagged, auc)


def test_toxicity_scores_equal_plain_sums(spark):
    """The query's rows on the smallest table: each text's score from its features, one at a time, and the held-out rule."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.train(docs, labels)
    got = {r["doc_id"]: r for r in catalog.QUERIES["op5_toxicity"](spark, SF).collect()}
    for doc_id, text in documents():
        features = {f for w in set(toxicity._WORDS.findall(text.lower())) for f in toxicity.features_of(w)}
        total, square = sum(float(model.weight[f]) for f in features), sum(float(model.square[f]) for f in features)
        score = 1 / (1 + np.exp(-(model.base + total / max(1e-6, square) ** 0.5)))
        row = got.pop(doc_id)
        assert abs(row["score"] - score) < 1e-4 and row["predicted"] == int(row["score"] >= 0.3) and row["held_out"] == (zlib.crc32(str(doc_id).encode()) % 4 == 2)
    assert not got


def test_token_counts_equal_greedy_matching():
    vocabulary = [tuple(x) for x in (b"a", b"ab", b"abcd", b"bc", b"c", b"d", b"bcx")]
    matcher, known = token_counts.Matcher(vocabulary), set(vocabulary)

    def greedy(word):
        at = n = 0
        while at < len(word):
            size = next((k for k in range(len(word) - at, 0, -1) if tuple(word[at : at + k]) in known), 0)
            if not size:
                return 1
            at, n = at + size, n + 1
        return n

    rng = np.random.default_rng(3)
    for _ in range(3000):
        word = bytes(rng.choice(list(b"abcdx"), rng.integers(1, 9)).tolist())
        assert matcher.count(word) == greedy(word), word


def test_licenses_are_confirmed_by_wording(spark):
    docs = spark.createDataFrame([(1, "Text.\nReleased under the MIT License.\nMore."), (2, "Licensed under CC BY-NC 4.0."), (3, "A licence to print money, they say."), (4, None)], "doc_id long, text string")
    got = {r["doc_id"]: (r["license"] if r["confirmed"] else None) for r in licenses.scan(docs).collect()}
    assert got == {1: "MIT", 2: "CC-BY-NC-4.0", 3: None}


def test_packing_holds_every_token_once(spark):
    docs = spark.createDataFrame([(i, LONG * (i % 40)) for i in range(300)] + [(7, "again"), (900, None)], "doc_id long, text string")
    pieces = packing.pack(docs, shard_tokens=20_000).collect()
    sequences = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 4096 or at & (at - 1) == 0
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    for doc_id in (3, 39, 900):
        ids = tokenizer.encode(LONG * (doc_id % 40) if doc_id < 900 else "", add_special_tokens=False).ids + [2]
        at = 0
        for p in sorted((p for p in pieces if p["doc_id"] == doc_id), key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(np.array(ids[at : at + p["length"]], "<u4").tobytes())
            at += p["length"]
        assert at == len(ids)


def test_mix_moves_shortage_to_siblings_first(spark):
    rows = [("d0", "en", "a", 10), ("d0", "en", "b", 1000), ("d0", "de", "c", 1000), ("d1", "en", "e", 1000)]
    sizes = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, domain string, lang string, source string, tokens long")
    mix = mixing.Mix(weights={}, budget=(400, 3010), max_epochs=1)
    got = {r["source"]: r["granted"] for r in mixing.leaf_budgets(sizes, mix).collect()}
    assert got == {"a": 10, "b": 90, "c": 100, "e": 200}


def test_pipeline_runs_and_keeps_clean_documents(spark, tmp_path):
    found = corpus_pipeline.run(spark, SF)
    assert found.count() > 0 and [s[0] for s in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near duplicates", "mixing", "packing"]
    docs = spark.createDataFrame(ODD, SCHEMA)
    for _, stage in corpus_pipeline.STAGES[1:4]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert docs.where("doc_id = 5").count() <= 1


def documents():
    """(doc_id, text) of the smallest table, read without Spark."""
    return duckdb.connect().sql(f"select doc_id, coalesce(text, '') from read_parquet('{SF}/documents.parquet')").fetchall()


def test_media_query_equals_brute_force(spark):
    got = {r["doc_id"]: r for r in catalog.QUERIES["op1_media"](spark, SF).collect()}
    for doc_id, text in documents():
        raw = text.encode()
        payload = raw + b" " * (max(192, -(-len(raw) // 192) * 192) - len(raw))
        row = got.pop(doc_id)
        assert (row["n_bytes"], row["payload_bytes"], row["payload_sha256"], row["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
    assert not got


def test_media_query_equals_its_files_and_clip_rows(spark):
    """The stored form and the feature of the query, from files written as a column and the timed clip rows read from them."""
    from collections import defaultdict

    docs = media.with_avi(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))
    files = {r["doc_id"]: bytes(r["media"]) for r in docs.select("doc_id", "media").collect()}
    cut = defaultdict(list)
    for r in media.clips(docs.drop("text")).collect():
        cut[r["doc_id"]].append(r)
    for row in catalog.QUERIES["op1_media"](spark, SF).collect():
        data, rows = files[row["doc_id"]], sorted(cut[row["doc_id"]], key=lambda r: r["clip"])
        assert (row["media_bytes"], row["media_sha256"]) == (len(data), hashlib.sha256(data).hexdigest())
        sizes = [r["n_frames"] for r in rows]
        assert [r["first_frame"] for r in rows] == [sum(sizes[:i]) for i in range(len(rows))] and all(a["end_s"] == b["start_s"] for a, b in zip(rows, rows[1:]))
        whole = [round(sum(r["histogram"][i] * r["n_frames"] for r in rows) / sum(sizes)) for i in range(len(rows[0]["histogram"]))]
        parts = dict(x.split("=") for x in row["feature"].split(";"))
        assert (int(parts["frames"]), int(parts["clips"]), int(parts["longest"]), parts["end"]) == (sum(sizes), len(rows), max(sizes), f"{rows[-1]['end_s']:.2f}")
        assert max(abs(a - b) for a, b in zip(map(int, parts["histogram"].split(",")), whole)) <= 1


def test_simhash_query_equals_brute_force(spark):
    import re

    import xxhash

    prints = {}
    for doc_id, text in documents():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text))
        shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
        prints[doc_id] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    root = {i: i for i in prints}
    for a, b in combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 4 and root[a] != root[b]:
            low, high = sorted((root[a], root[b]))
            root = {i: low if x == high else x for i, x in root.items()}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in catalog.QUERIES["op7_simhash"](spark, SF).collect()}
    assert got == {i: (f"{x:016x}", root[i]) for i, x in prints.items()}


def test_packing_query_has_the_tokenizer_s_ids(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    pieces = {}
    for p in catalog.QUERIES["op9_packing"](spark, SF).collect():
        pieces.setdefault(p["doc_id"], []).append((p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]))
    for doc_id, text in documents():
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        at = 0
        for start, length, crc, total in sorted(pieces.pop(doc_id)):
            assert (start, crc, total) == (at, zlib.crc32(np.array(ids[at : at + length], "<u4").tobytes()), len(ids))
            at += length
        assert at == len(ids)
    assert not pieces


@pytest.mark.parametrize("text", ["İstanbul ǅ ﬁne don't stop!!! it's 3.14,15 (a.b)", "a<|endoftext|>b <|startoftext|> C", "été naïve x y\u0085z", "日本語。テスト! ...,,, ?!word?! w0rd9.", "A" * 9000 + " x" * 9000, "﻿bom ​zero abͅ"])
def test_encoder_equals_the_tokenizer(text):
    from tokenizers import Tokenizer

    import pyarrow as pa

    tokenizer, encoder = Tokenizer.from_file(packing.default_tokenizer()), packing.Encoder(packing.default_tokenizer())
    texts = [text, text.upper(), f"word. {text}\n{text}", "", None, " ", "aaaa aaaaa.aaa 1a2 x"]
    ids, starts = encoder.batch(pa.array(texts, pa.string()))
    for x, s, e in zip(texts, starts[:-1], starts[1:], strict=True):
        assert ids[s:e].tolist() == [*tokenizer.encode(x or "", add_special_tokens=False).ids, 2]


def test_encoder_equals_the_tokenizer_on_random_words():
    import pyarrow as pa
    from tokenizers import Tokenizer

    tokenizer, encoder = Tokenizer.from_file(packing.default_tokenizer()), packing.Encoder(packing.default_tokenizer())
    assert encoder.merges
    rng = np.random.default_rng(6)
    letters = list("aaabeeilmnorstthxz") + list("éßøAÉ.,!?|&$'’0193-_<>")
    texts = [" ".join("".join(rng.choice(letters, rng.integers(1, 14))) for _ in range(40)) for _ in range(200)]
    ids, starts = encoder.batch(pa.array(texts))
    for x, s, e in zip(texts, starts[:-1], starts[1:], strict=True):
        assert ids[s:e].tolist() == [*tokenizer.encode(x, add_special_tokens=False).ids, 2], x
    empty = encoder.batch(pa.array([], pa.string()))
    assert len(empty[0]) == 0 and empty[1].tolist() == [0]


def test_packing_does_not_depend_on_partitions(spark):
    """Two layouts of the same rows give the same pieces, in many shards and where one code is dealt into several."""
    docs = spark.createDataFrame([(i, f"start{i} " + LONG * (i % 30)) for i in range(200)] + [(1000 + i, LONG * 20) for i in range(60)], "doc_id long, text string")
    one, other = ({tuple(r) for r in packing.pack(docs.repartition(n), shard_tokens=9_000).collect()} for n in (1, 7))
    assert one == other and len({s >> 32 for *_, s, _ in one}) > 10


def test_shards_are_dealt_within_their_size():
    first, parts = packing.shard_plan(np.array([5, 0, 4, 30, 2, 9, 1]), 10)
    assert [(int(a), int(b)) for a, b in zip(first, parts, strict=True)] == [(0, 1), (0, 1), (0, 1), (1, 3), (4, 1), (5, 1), (5, 1)]


def test_long_words_do_not_fill_or_clear_the_cache(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE_WORDS", 5)
    long = "antidisestablishmentarianism" * 5
    docs = spark.createDataFrame([(i, f"word{i} {long} {long}x the of {long}") for i in range(12)] + [(99, "the of word3")], "doc_id long, text string").coalesce(1)
    matcher = token_counts.Matcher(token_counts.read_vocabulary(token_counts.default_vocabulary()))
    for r in token_counts.with_counts(docs).collect():
        assert (r["n_words"], r["n_tokens"]) == (len(r["text"].split()), sum(matcher.count(w.encode()) for w in r["text"].split()))


def test_token_counts_query_equals_greedy_matching(spark):
    vocabulary = set(token_counts.read_vocabulary(token_counts.default_vocabulary()))
    longest, known = max(map(len, vocabulary)), {}

    def pieces(word):
        symbols, at, n = (*word, token_counts.END), 0, 0
        while at < len(symbols):
            size = next((k for k in range(min(longest, len(symbols) - at), 0, -1) if symbols[at : at + k] in vocabulary), 0)
            if not size:
                return 1
            at, n = at + size, n + 1
        return n

    got = {r["doc_id"]: (r["n_words"], r["n_tokens"]) for r in catalog.QUERIES["op6_token_counts"](spark, SF).collect()}
    for doc_id, text in documents():
        words = text.encode().lower().split()
        for w in set(words).difference(known):
            known[w] = pieces(w)
        assert got.pop(doc_id) == (len(words), sum(known[w] for w in words))
    assert not got


def canonical(table):
    """Code and length of each symbol of a Huffman table, counted up length by length."""
    codes, code, at = {}, 0, 16
    for length in range(1, 17):
        for symbol in table[at : at + table[length - 1]]:
            codes[symbol] = code, length
            code += 1
        at += table[length - 1]
        code <<= 1
    return codes


def baseline_frame(grey, colour=False, restart=0, standard=False):
    """A baseline JPEG file of an image, all quantisers 1; with colour, two flat components of half the size; standard: without tables."""
    from atlasmith.llm import jpeg

    step = 16 if colour else 8
    height, width = grey.shape
    image = np.pad(grey, ((0, -height % step), (0, -width % step)), mode="edge").astype(float) - 128
    tables = {0: bytes([0, 0, 0, 12] + [0] * 12) + bytes(range(12)), 16: bytes([0] * 7 + [176] + [0] * 8) + bytes(r << 4 | s for r in range(16) for s in range(11))}
    codes = {k: canonical(jpeg.STANDARD[k]) if standard else {s: (i, 4 if k == 0 else 8) for i, s in enumerate(t[16:])} for k, t in tables.items()}
    segments, bits, last = [], "", 0

    def value(x):
        n = abs(x).bit_length()
        return n, format(x if x > 0 else x + (1 << n) - 1, f"0{n}b") if n else ""

    def put(kind, symbol, extra=""):
        code, length = codes[kind][symbol]
        return format(code, f"0{length}b") + extra

    def flush():
        data = bits + "1" * (-len(bits) % 8)
        segments.append(int(data, 2).to_bytes(len(data) // 8, "big").replace(b"\xff", b"\xff\x00") if data else b"")

    units = [(y, x) for y in range(0, image.shape[0], step) for x in range(0, image.shape[1], step)]
    for unit, (y, x) in enumerate(units):
        if restart and unit and unit % restart == 0:
            flush()
            bits, last = "", 0
        for i in range(0, step, 8):
            for j in range(0, step, 8):
                block = image[y + i : y + i + 8, x + j : x + j + 8]
                found = np.rint(jpeg.COSINES @ block @ jpeg.COSINES.T).astype(int).ravel()[jpeg.ORDER].tolist()
                n, extra = value(found[0] - last)
                last = found[0]
                bits += put(0, n, extra)
                run = 0
                for c in found[1:]:
                    if not c:
                        run += 1
                        continue
                    while run > 15:
                        bits += put(16, 0xF0)
                        run -= 16
                    n, extra = value(c)
                    bits += put(16, run << 4 | n, extra)
                    run = 0
                if run:
                    bits += put(16, 0)
        if colour:
            bits += (put(0, 0) + put(16, 0)) * 2
    flush()
    part = lambda mark, body: bytes([0xFF, mark]) + (len(body) + 2).to_bytes(2, "big") + body
    ids = (1, 2, 3) if colour else (1,)
    head = part(0xDB, b"\x00" + b"\x01" * 64) + part(0xC0, b"\x08" + height.to_bytes(2, "big") + width.to_bytes(2, "big") + bytes([len(ids)]) + b"".join(bytes([c, 0x22 if colour and c == 1 else 0x11, 0]) for c in ids))
    head += (b"" if standard else part(0xC4, b"\x00" + tables[0] + b"\x10" + tables[16])) + (part(0xDD, restart.to_bytes(2, "big")) if restart else b"")
    head += part(0xDA, bytes([len(ids)]) + b"".join(bytes([c, 0]) for c in ids) + bytes([0, 63, 0]))
    scan = segments[0] + b"".join(bytes([0xFF, 0xD0 + k % 8]) + x for k, x in enumerate(segments[1:]))
    return b"\xff\xd8" + head + scan + b"\xff\xd9"


@pytest.mark.parametrize(("colour", "restart"), [(False, 0), (True, 0), (False, 2), (True, 1)])
def test_baseline_frames_are_decoded(colour, restart):
    rng = np.random.default_rng(5)
    grey = np.clip(np.add.outer(np.arange(37) * 3, np.arange(29) * 2) + rng.integers(-40, 40, (37, 29)), 0, 255).astype(np.uint8)
    frame = baseline_frame(grey, colour, restart)
    found = media.decode_frames([frame, frame[:200], b"", b"\xff\xd8\xff"])
    assert np.abs(found[0].astype(int) - grey).max() <= 2 and found[1:] == [None, None, None]


def test_frames_without_tables_use_the_standard_ones():
    from atlasmith.llm import jpeg

    for table in jpeg.STANDARD.values():
        assert sum(table[:16]) == len(table) - 16 == len(set(table[16:])) and max(c >> (n - 1) for c, n in canonical(table).values()) == 1
    rng = np.random.default_rng(8)
    grey = np.clip(np.add.outer(np.arange(24) * 4, np.arange(40) * 3) + rng.integers(-60, 60, (24, 40)), 0, 255).astype(np.uint8)
    assert np.abs(media.decode_frames([baseline_frame(grey, standard=True)])[0].astype(int) - grey).max() <= 2


def test_indexes_of_other_writers():
    """Absolute idx1 offsets, wrong ones, rec groups, and OpenDML indexes over two RIFF parts give the same clips."""
    levels = np.repeat(np.array([10, 200, 90], np.uint8), 12)[:, None, None] * np.ones((1, 12, 16), np.uint8)
    frames = media.encode_frames(levels)
    file = media.write_avi(frames)
    want = media.clips_of(file)
    assert [(c.first_frame, c.n_frames) for c in want] == [(0, 12), (12, 12), (24, 12)]
    movi, at = file.index(b"movi"), file.index(b"idx1") + 8
    index = np.frombuffer(file[at:], "<u4").reshape(-1, 4)
    for shift in (movi, 3):
        other = index.copy()
        other[:, 2] += shift
        assert media.clips_of(file[:at] + other.tobytes()) == want
    chunk = media._chunk
    head = file[12 : movi - 8]
    groups = b"".join(chunk(b"LIST", b"rec " + b"".join(chunk(b"00dc", x) for x in frames[i : i + 5])) for i in range(0, len(frames), 5))
    assert media.clips_of(chunk(b"RIFF", b"AVI " + head + chunk(b"LIST", b"movi" + groups))) == want
    out = b""
    for kind, some, inside in ((b"AVI ", frames[:20], head), (b"AVIX", frames[20:], b"")):
        base = len(out) + 12 + len(inside) + 12
        offsets = base + 8 + np.concatenate(([0], np.cumsum([8 + len(x) + len(x) % 2 for x in some])[:-1]))
        entries = np.stack([offsets - base, [len(x) for x in some]], axis=1).astype("<u4").tobytes()
        ix = b"\x02\x00\x00\x01" + len(some).to_bytes(4, "little") + b"00dc" + base.to_bytes(8, "little") + bytes(4) + entries
        out += chunk(b"RIFF", kind + inside + chunk(b"LIST", b"movi" + b"".join(chunk(b"00dc", x) for x in some) + chunk(b"ix00", ix)))
    assert media.clips_of(out) == want and len(media._new_index(out, out.index(b"ix00") + 8, 24 + 8 * 20)) == 20


def test_shots_of_baseline_files():
    frames = [baseline_frame(np.full((16, 16), level, np.uint8)) for level in (20, 220, 90) for _ in range(12)]
    assert [(c.first_frame, c.n_frames) for c in media.clips_of(media.write_avi(frames, 16, 16))] == [(0, 12), (12, 12), (24, 12)]


def test_license_query_misses_no_template(spark):
    """Every block that is within the limit of any template, all of them tried, is confirmed, and no other."""
    import re

    mention = re.compile(licenses.MENTION)
    scanner, want, memo = licenses.Scanner(licenses.TEMPLATES), {}, {}
    for doc_id, text in documents():
        lines, start = [*text.split("\n"), ""], None
        for i, line in enumerate(lines):
            if mention.search(line) and i < len(lines) - 1:
                start = i if start is None else start
            elif start is not None:
                block, words = "\n".join(lines[start:i]), None
                if block not in memo:
                    words = licenses.words_of(block)
                    memo[block] = any(sum(licenses.differences(words, t)) <= licenses.MAX_CHANGED * len(t) for t in scanner.words)
                want[doc_id, start], start = memo[block], None
    got = {(r["doc_id"], r["line"]): r["confirmed"] for r in catalog.QUERIES["op3_license_scan"](spark, SF).collect()}
    assert got == want and any(want.values())


def test_toxicity_query_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    scored = catalog.QUERIES["op5_toxicity"](spark, sf_dir)
    rows = scored.where("held_out").join(labels, "doc_id").select("score", "predicted", "toxic").toPandas()
    ranks, toxic = rows["score"].rank(), rows["toxic"] == 1
    auc = (ranks[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum())
    assert auc > 0.88 and rows["predicted"].eq(rows["score"].ge(0.3).astype(int)).all()


def jaccard_roots(texts):
    """For each id the smallest one reachable by links of five-word Jaccard of 0.8 or more, by sets of word tuples."""
    own = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, w in ((i, (t or "").encode().lower().split()) for i, t in texts.items())}
    root = {i: i for i in own}
    for a, b in combinations(sorted(own), 2):
        low, high = sorted((len(own[a]), len(own[b])))
        if 5 * low >= 4 * high and 9 * len(own[a] & own[b]) >= 4 * (low + high) and root[a] != root[b]:
            low, high = sorted((root[a], root[b]))
            root = {i: low if x == high else x for i, x in root.items()}
    return root


def test_pipeline_stages_equal_brute_force(spark):
    """Each stage's rows against a plainer way to them, on all that the stage before it kept."""
    from atlasmith.llm import _shared

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, _shared.stage_table(stage(spark, docs, SF), "test")
        kept[name] = before.toPandas(), docs.toPandas()

    before, after = kept["toxicity"]
    model = toxicity.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    assert sorted(after["doc_id"]) == sorted(before["doc_id"][model.scores(list(before["text"])) < toxicity.THRESHOLD])

    documents, after = kept["line dedup"]
    sha = lambda x: hashlib.sha256((x or "").encode()).hexdigest()
    con = duckdb.connect()
    con.register("documents", documents)
    want = con.sql(f"select doc_id, kept_sha256 from ({line_dedup.ORACLE})").fetchall()
    assert sorted(zip(after["doc_id"], after["text"].map(sha), strict=True)) == sorted(want)

    before, after = kept["near duplicates"]
    # The stage's rule is five words and a similarity of 0.8, not op7's four words and four bits.
    root = jaccard_roots(dict(zip(before["doc_id"], before["text"], strict=True)))
    assert sorted(after["doc_id"]) == sorted(set(root.values())) and len(after) < len(before)

    before, after = kept["mixing"]
    con = duckdb.connect()
    con.register("documents", before)
    want = con.sql(f"select doc_id from ({mixing.oracle('documents', mixing.ONCE)})").fetchall()
    assert sorted(after["doc_id"]) == sorted(i for (i,) in want)

    before, pieces = kept["packing"]
    assert set(pieces["doc_id"]) == set(before["doc_id"])
    totals = pieces.groupby("doc_id").agg(n=("length", "sum"), total=("doc_tokens", "first"))
    assert (totals["n"] == totals["total"]).all()


def test_near_duplicate_stage_equals_exact_jaccard(spark):
    """Every pair of sf0.01 with five-word Jaccard of 0.8 or more, compared by sets of word tuples, and no other."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    own = {}
    for r in docs.select("doc_id", "text").collect():
        words = (r["text"] or "").encode().lower().split()
        own[r["doc_id"]] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}
    root, far = {i: i for i in own}, 0
    for a, b in combinations(sorted(own), 2):
        low, high = sorted((len(own[a]), len(own[b])))
        if 5 * low >= 4 * high and 9 * len(own[a] & own[b]) >= 4 * (low + high):
            far += own[a] != own[b]
            if root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {i: low if x == high else x for i, x in root.items()}
    got = corpus_pipeline.drop_near_duplicates(spark, docs, "").toPandas()
    assert sorted(got["doc_id"]) == sorted(set(root.values())) and far > 5


def test_near_copies_in_crowded_buckets(spark, monkeypatch):
    """A chain of near copies, many equal texts and texts that share less, with buckets dealt into blocks."""
    monkeypatch.setattr(near_copies, "BUCKET_ROWS", 3)
    base = [f"w{i}" for i in range(100)]
    texts = {k: " ".join([f"n{k}x{i}" for i in range(k)] + base[k:]) for k in range(60)}
    texts |= {1000 + k: " ".join([*base[:50], *(f"m{k}x{i}" for i in range(50))]) for k in range(20)}
    texts |= {2000 + k: "the same text in many documents of this table" for k in range(20)} | {3000: None, 3001: " "}
    own = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, w in ((i, (t or "").split()) for i, t in texts.items())}
    root = {i: i for i in own}
    for a, b in combinations(sorted(own), 2):
        if len(own[a] & own[b]) >= 0.8 * len(own[a] | own[b]) and root[a] != root[b]:
            low, high = sorted((root[a], root[b]))
            root = {i: low if x == high else x for i, x in root.items()}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in near_copies.near_groups(docs).collect()} == root
    assert near_copies.near_groups(docs.limit(0)).count() == 0


def test_wrapped_and_embedded_license_notices_are_confirmed(spark):
    """Neither hard wrapping nor the length of a line hides a wording."""
    import textwrap

    names = list(licenses.TEMPLATES)
    prose = "nothing of interest is said in this sentence about rivers and hills " * 50
    rows = [(i, f"Title\n{textwrap.fill(licenses.TEMPLATES[n], 72)}\nEnd") for i, n in enumerate(names)]
    rows += [(100 + i, f"{prose}{licenses.TEMPLATES[n]} {prose}") for i, n in enumerate(names)]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).where("confirmed").collect()
    assert sorted((r["doc_id"], r["license"]) for r in got) == sorted((i + k, n) for i, n in enumerate(names) for k in (0, 100))


def test_all_licenses_of_a_block_are_reported(spark):
    """Two and three licences on neighbouring lines or in one line."""
    three = [licenses.TEMPLATES[n] for n in ("Apache-2.0", "MIT", "GPL-2.0")]
    docs = spark.createDataFrame([(1, "\n".join(three[:2])), (2, "\n".join(three)), (3, " ".join(three))], "doc_id long, text string")
    got = sorted((r["doc_id"], r["license"]) for r in licenses.scan(docs).where("confirmed").collect())
    assert got == [(1, "Apache-2.0"), (1, "MIT"), *((i, n) for i in (2, 3) for n in ("Apache-2.0", "GPL-2.0", "MIT"))]
