"""Each operator on null, empty, long, repeated and clashing rows, and against brute force."""

import hashlib
import unittest.mock as mock
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortmill.llm import bpe, bytebpe, lm, minhash, packing, quality, rollup, sketch, tokens, topk, toxicity
from cohortmill.llm.textscan import scan

BYTE, WORD = P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, part int, key long, item long, rank int, next string"


def words(n, seed=0):
    r = np.random.default_rng(seed)
    return " ".join(f"w{x}" for x in r.integers(0, 5000, n))


TEXTS = {0: "Hello, world! It's a test.", 1: None, 2: "", 3: words(9000, 3), 4: words(200, 4), 5: words(200, 4), 6: words(200, 4).replace("w", "W", 1) + " tail", 7: "one two", 8: "!!! ...", 9: "Ünïcode — 中文 😀 text", 10: words(40, 9)}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en", f"s{k % 2}", 1, 1, 1, 1, 1, "x") for k, t in TEXTS.items()]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def odd(spark, docs):
    """Repeated rows and null ids as well."""
    return docs.unionByName(docs.filter("doc_id in (0, 4)")).unionByName(docs.filter("doc_id = 0").withColumn("doc_id", F.lit(None).cast("long"))).withColumn("lang", F.lit(None).cast("string"))


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("false")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, k % 2, int(k in (0, 9))) for k in TEXTS] + [(0, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


def test_topk(spark):
    r = np.random.default_rng(2)
    rows = [(i, r.normal(size=8).round(2).tolist()) for i in range(300)] + [(300 + i, [0.5] * 8) for i in range(120)] + [(500, None), (501, [None] * 8), (502, [float("nan")] * 8), (503, [1.0] * 3), (504, [2.0] * 3), (505, [float("inf")] * 8), (None, [1.0] * 8)]
    # repeated rows, and one id with two vectors
    rows += [rows[20], rows[20], (40, [9.0] * 8), (41, [9.0] * 8), (41, [9.0] * 8), rows[300]]
    df = spark.createDataFrame(rows, "id long, vector array<double>")
    got = defaultdict(list)
    for x in topk.exact_topk(df, F.expr("id % 20 = 0 or id = 503"), shard_rows=64, leaf_rows=8, block_rows=16).collect():
        got[x["query_key"]].append((x["query_id"], x["rank"], x["vec_id"], x["score"]))
    good = [(i, np.floor(64 * np.array(v, float))) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()]
    want = []
    for k, (i, q) in enumerate(good):
        if i % 20 == 0 or i == 503:
            best = sorted((-int(q @ v), j) for n, (j, v) in enumerate(good) if n != k and len(v) == len(q))[:20]
            want.append([(i, n + 1, j, -s) for n, (s, j) in enumerate(best)])
    assert sorted(map(sorted, got.values())) == sorted(want)
    assert topk.exact_topk(df.filter("false"), F.lit(True)).count() == 0
    assert topk.exact_topk(df, F.lit(None).cast("boolean")).count() == 0


def test_topk_of_huge_components(spark):
    rows = [(i, [float(i) * 1e15, 3.0]) for i in range(6)]
    df = spark.createDataFrame(rows, "id long, vector array<double>")
    got = {(x["query_id"], x["rank"]): x["score"] for x in topk.exact_topk(df, F.col("id") == 1, k=2).collect()}
    assert got == {(1, 1): 2**63 - 1, (1, 2): 2**63 - 1}


def test_token_packing(spark, docs, odd, none):
    for df, n in ((docs, len(TEXTS)), (odd, len(TEXTS) + 3)):
        rows = tokens.written(df, BYTE, room=256).collect()
        encoder, found = bpe.byte_encoder(BYTE), defaultdict(list)
        for r in rows:
            ids = np.frombuffer(r["ids"], "<u2")
            assert len(ids) == r["n_tokens"] == r["cu_seqlens"][-1] <= 256 and r["position_resets"] == r["cu_seqlens"][:-1]
            for d, s, a, b in zip(r["doc_ids"], r["starts"], r["cu_seqlens"], r["cu_seqlens"][1:]):
                found[d].append((s, ids[a:b].tolist()))
        assert sum(s == 0 for own in found.values() for s, _ in own) == n
        if df is docs:
            for d, own in found.items():
                assert [x for _, part in sorted(own) for x in part] == [*encoder.encode([TEXTS[d] or ""])[0].tolist(), tokens.END]
    assert tokens.written(none, BYTE).count() == 0
    one = tokens.positions(tokens.sequences(docs.filter("doc_id in (0, 7)"), BYTE)).first()
    assert one["position_ids"] == [i for a, b in zip(one["cu_seqlens"], one["cu_seqlens"][1:]) for i in range(b - a)]


def test_segment_tree_is_best_fit():
    r = np.random.default_rng(5)
    for most in (60, 100, 15):
        lengths = sorted(r.integers(1, most, 400).tolist(), reverse=True)
        got = tokens.best_fit_decreasing(np.bincount(lengths, minlength=101), 100)
        assert sorted(x for held, n in got for x in held * n) == sorted(lengths)
        spaces = []
        for x in lengths:
            fit = [(s, k) for k, s in enumerate(spaces) if s >= x]
            if fit:
                spaces[min(fit)[1]] -= x
            else:
                spaces.append(100 - x)
        assert sorted(100 - sum(held) for held, n in got for _ in range(n)) == sorted(spaces)


def test_words_end_at_punctuation_of_any_script():
    """Quotes, dashes, no-break spaces and CJK stops part words; marks and letters beyond ASCII don't."""
    text = "Say \u201cvile\u201d, \u00abr\u00f6tten\u00bb\u2014so\u00a0it\u3000is \u4eca\u5929\u3002\u660e\u5929 e\u0301t\u00e9 \U0001d4b3x\U0001f600y \u0939\u093f"
    plain = "say vile r\u00f6tten so it is \u4eca\u5929 \u660e\u5929 e\u0301t\u00e9 \U0001d4b3x y \u0939\u093f"
    found, want = (scan(pa.array(["", x, "\u3002", x[:3]])) for x in (text, plain))
    assert found.hashes.tolist() == want.hashes.tolist() and np.diff(found.of).tolist() == [0, 12, 0, 1]
    base = ["".join(chr(0x4E00 + x) for x in np.random.default_rng(k).integers(0, 5000, 9)) for k in range(60)]
    a, b = (minhash.bags(pa.array(["\u3002".join(t)]))[1:] for t in (base, [*base[:-1], "\u4eca"]))
    assert minhash.overlap(a, b) > 0.9


def classes_of(rows):
    out = defaultdict(set)
    for r in rows:
        out[r["class_id"]].add(r["doc_id"])
    return {frozenset(v) for v in out.values()}


def test_near_duplicates(docs, odd, none):
    assert classes_of(minhash.near_duplicates(docs).collect()) == {frozenset(x) for x in ({0}, {1, 2, 8}, {3}, {4, 5, 6}, {7}, {9}, {10})}
    assert minhash.near_duplicates(odd).count() == len(TEXTS) + 3
    assert minhash.near_duplicates(none).count() == 0
    kept = minhash.deduplicated(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {0, 1, 3, 4, 7, 9, 10}


def test_one_row_of_each_class_is_kept(spark, odd):
    """Repeated rows, null ids, near copies among null ids, and a repeated id with two texts."""
    near = [(None, words(300, 90)), (None, words(300, 90) + " end"), (4, words(300, 91)), (20, words(300, 91)), (20, words(300, 91))]
    more = odd.select("doc_id", "text").unionByName(spark.createDataFrame(near, "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in minhash.deduplicated(odd).collect()) == [0, 1, 3, 4, 7, 9, 10]
    kept = [(r["doc_id"], (r["text"] or "")[:20]) for r in minhash.deduplicated(more).collect()]
    assert sorted(-1 if k is None else k for k, _ in kept) == [-1, 0, 1, 3, 4, 4, 7, 9, 10]
    assert (4, words(300, 91)[:20]) in kept and (None, words(300, 90)[:20]) in kept
    rows = minhash.near_duplicates(more).collect()
    assert len(rows) == more.count() and sum(r["is_first"] for r in rows) == 9


def test_chains_and_bridges(spark):
    """A row of texts, each near the next only: one class, though its ends differ."""
    base = words(400, 1).split()
    rows = [(k, " ".join(f"x{j}" if j < 14 * k else w for j, w in enumerate(base))) for k in range(9)] + [(50 + k, words(300, 70 + k)) for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    held = [minhash.bags(pa.array([t]))[1:] for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if minhash.overlap(held[i], held[j]) >= 0.8:
                parent[root(i)] = root(j)
    want = defaultdict(set)
    for i, (d, _) in enumerate(rows):
        want[root(i)].add(d)
    assert classes_of(minhash.near_duplicates(df).collect()) == {frozenset(v) for v in want.values()}


def test_signatures_estimate_weighted_likeness():
    r = np.random.default_rng(3)
    a, b = r.integers(1, 9, 60), r.integers(1, 9, 60)
    item = np.arange(60).astype(np.uint64)
    s = minhash.bag_min_hash(np.repeat([0, 1], 60), np.r_[item, item], np.r_[a, b], 2, 4096)
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((s[0] == s[1]).mean() - true) < 0.03


def test_pattern_packing(docs, odd, none):
    encoder = bpe.word_encoder(WORD)
    for df in (docs, odd):
        rows = packing.packed(df, WORD, room=128).collect()
        at = defaultdict(list)
        for r in rows:
            at[r["sequence_id"]].append((r["offset"], r["length"]))
        for own in at.values():
            own.sort()
            assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 128
        assert len(at) == -(-sum(r["length"] for r in rows) // 128) or len(at) <= 1 + -(-sum(r["length"] for r in rows) // 128)
    ids = {d: [*encoder.encode([t or ""])[0].tolist(), 0] for d, t in TEXTS.items()}
    got = {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in packing.packed(docs, WORD, room=128).collect()}
    want = {(d, k): (128 * k, len(x[128 * k : 128 * k + 128]), zlib.crc32(np.array(x[128 * k : 128 * k + 128], "<u4"))) for d, x in ids.items() for k in range(-(-len(x) // 128))}
    assert got == want
    assert packing.packed(none, WORD).count() == 0


def test_plans_place_every_piece():
    r = np.random.default_rng(4)
    for counts in (r.integers(0, 30, 257), np.r_[np.zeros(256, int), 10**6], np.r_[0, 10**7, np.zeros(255, int)], np.r_[np.zeros(200, int), np.full(57, 10**5)]):
        counts = counts.copy()
        counts[0] = 0
        made = packing.plan(counts, 256)
        used = Counter()
        for held, n in made:
            assert sum(held) <= 256 and n > 0
            for x in held:
                used[x] += n
        assert [used[x] for x in range(257)] == counts.tolist()


def test_fingerprints(docs, odd, none, spark):
    rows = {r["doc_id"]: r for r in sketch.fingerprints(docs).collect()}
    order = sorted(TEXTS, reverse=True)
    for k, d in enumerate(order):
        own, following = TEXTS[d] or "", TEXTS[order[(k + 1) % len(order)]] or ""
        half = len(own) // 2
        edited = own[: len(own) - half] + following[:half]
        assert (rows[d]["n_chars"], rows[d]["edited_sha256"]) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= rows[d]["near_edited"] <= 1
    assert rows[4]["fingerprint"] == rows[5]["fingerprint"] and rows[5]["near_next"] == 1 and rows[1]["fingerprint"] == rows[2]["fingerprint"]
    assert sketch.fingerprints(odd).count() == len(TEXTS) + 3 and sketch.fingerprints(none).count() == 0
    assert sketch.fingerprints(docs.filter("doc_id = 0")).first()["near_next"] == 1
    many = spark.range(3000).select((F.col("id") * F.col("id")).alias("doc_id"), F.concat(F.lit("text of "), "id").alias("text"))
    got = {r["doc_id"]: r["edited_sha256"] for r in sketch.fingerprints(many).collect()}
    for i in range(3000):
        own, following = f"text of {i}", f"text of {(i - 1) % 3000}"
        half = len(own) // 2
        assert got[i * i] == hashlib.sha256((own[: len(own) - half] + following[:half]).encode()).hexdigest()


def test_sketch_estimates_and_merges(spark):
    a, b = words(4000, 1), words(4000, 1) + " " + words(12000, 2)
    df = sketch.with_sketch(sketch.with_sketch(spark.createDataFrame([(a, b)], "a string, b string"), "a", "sa"), "b", "sb")
    r = df.select(sketch.containment(F.col("sa"), F.col("sb")).alias("c"), sketch.resemblance(F.col("sa"), F.col("sb")).alias("j"), (sketch.merged(F.col("sa"), F.col("sb")) == F.col("sb")).alias("m")).first()
    assert r["c"] == 1 and abs(r["j"] - 0.25) < 0.04 and r["m"]


def test_rollup(spark, docs, odd, tmp_path):
    encoder = bpe.byte_encoder(BYTE)
    n = lambda t: len(encoder.encode([t or ""])[0])
    counted = rollup.with_counts(odd.select("doc_id", "source", "lang", F.lit("v1").alias("version"), F.col("text").alias("n_tokens"), F.upper("text").alias("n_new")), ["n_tokens", "n_new"], BYTE).cache()
    store = rollup.Rollup(spark, str(tmp_path / "rollup"))
    assert store.totals().count() == 0
    assert store.commit("b1", rollup.inserts(counted)) and not store.commit("b1", rollup.inserts(counted))
    every = [(d, TEXTS[d]) for d in (*TEXTS, 0, 4, 0)]
    assert store.totals().agg(F.sum("n_docs"), F.sum("n_tokens")).first() == (len(every), sum(n(t) for _, t in every))
    store.commit("b2", rollup.revisions(counted, "n_tokens", "n_new"))
    assert store.totals().agg(F.sum("n_docs"), F.sum("n_tokens")).first() == (len(every), sum(n((t or "").upper()) for _, t in every))
    store.commit("b3", rollup.deletes(counted.withColumn("n_tokens", F.col("n_new"))))
    assert store.totals().count() == 0 and store.batches() == ["b1", "b2", "b3"]
    with pytest.raises(ValueError, match="other changes"):
        store.commit("b1", rollup.inserts(counted.limit(1)))
    assert store.commit("_b4/x", rollup.inserts(counted)) and store.commit("b5", rollup.inserts(counted.limit(0))) and store.batches()[3:] == ["_b4/x", "b5"]
    # a writer that saw the log before another one committed starts again from the newer totals
    before, log = store.totals().agg(F.sum("n_docs")).first()[0], store.log()
    late, calls = rollup.Rollup(spark, store.root), []
    seen = late.log
    late.log = lambda: calls.append(1) or (log if len(calls) == 1 else seen())
    store.commit("b6", rollup.inserts(counted))
    assert late.commit("b7", rollup.inserts(counted)) and len(calls) == 2
    assert store.totals().agg(F.sum("n_docs")).first()[0] == before + 2 * len(every)


def test_quality(docs, odd, none, labels):
    for df, n in ((docs, len(TEXTS)), (odd, len(TEXTS) + 3), (none, 0)):
        rows = quality.classified(df, labels, "source", "lang").collect()
        assert len(rows) == n and all(0 <= r["posterior"] <= 1 for r in rows)
    kept = quality.accepted(docs, labels.filter("false"), "source", "lang")
    assert kept.columns == docs.columns and kept.count() == len(TEXTS)


def test_posteriors_shrink(spark):
    rows = [("a", "x", 0.9)] * 200 + [("b", "x", 0.1)] * 200 + [("c", "x", 0.9)]
    got = {r["host"]: r for r in quality.posteriors(spark.createDataFrame(rows, "host string, path string, p double")).collect()}
    assert got["a"]["path_posterior"] > got["c"]["path_posterior"] > got["c"]["global_mean"] > got["b"]["path_posterior"]


def test_cross_entropy(spark, docs, odd, none):
    target = spark.createDataFrame([(words(40, 9),)] * 5 + [(None,)], "text string")
    rows = {r["doc_id"]: r for r in lm.cross_entropy_difference(target, docs, vocabulary=100).collect()}
    assert rows[10]["difference"] < 0 < rows[4]["difference"] and rows[1]["target_loss"] is None and rows[8]["n_words"] == 0
    assert lm.cross_entropy_difference(target, odd).count() == len(TEXTS) + 3
    assert lm.cross_entropy_difference(none, none).count() == 0
    ids = [7, 7, 3]
    counts = spark.createDataFrame([(4 * 3 + 1, 2), (1 * 4 + 1, 3)], "pair int, n long")
    table = 2.0 ** -lm.losses(counts, 4, 5.0).reshape(4, 4).astype(float)
    assert np.allclose(table.sum(axis=1), 1) and ids


def test_cross_entropy_over_all_words(spark):
    """Exact bigram losses, also of words beyond any fixed vocabulary, with texts in many slices."""
    target = [words(6000, 21), words(300, 22) + " rare", None]
    background = [(k, words(700, 30 + k)) for k in range(12)] + [(12, words(50, 4) + " rare"), (13, words(50, 4) + " other"), (14, ""), (14, "w1 w2 w1 w2"), (None, "rare w1")]
    held = [[t.split() for t in texts if t] for texts in (target, [t for _, t in background])]
    distinct = len({w for texts in held for t in texts for w in t})
    models = [(Counter(p for t in texts for p in zip([None, *t], t)), Counter(w for t in texts for w in t), Counter(p for t in texts for p in [None, *t][:-1])) for texts in held]

    def loss(model, text):
        pair, word, before = model
        p1 = {w: (word[w] + 1) / (word.total() + distinct) for w in text}
        return -sum(np.log2((pair[p, w] + 200 * p1[w]) / (before[p] + 200)) for p, w in zip([None, *text], text)) / len(text)

    want = sorted((d or -1, len(t.split()), *(round(loss(m, t.split()), 6) if t else 0 for m in models)) for d, t in background)
    frames = spark.createDataFrame([(t,) for t in target], "text string"), spark.createDataFrame(background, "doc_id long, text string")
    assert distinct > 4000
    for limit in (2 << 20, 3000):
        rows = lm.cross_entropy_difference(*frames, limit=limit).collect()
        assert sorted((r["doc_id"] or -1, r["n_words"], round(r["target_loss"] or 0, 6), round(r["background_loss"] or 0, 6)) for r in rows) == want
    got = {r["doc_id"]: r["difference"] for r in rows}
    assert got[12] < got[13]


def test_cross_entropy_keeps_texts_apart(spark, monkeypatch):
    """No stored row holds a slice, buckets follow the bytes of the texts, and a slice may be read in parts."""
    background = spark.createDataFrame([(k, words(60 + k % 7, k % 90)) for k in range(300)] + [(300, ""), (301, None)], "doc_id long, text string").coalesce(1)
    target, kept, real = background.filter("doc_id < 20").select("text"), {}, lm.stored
    want = {r["doc_id"]: r for r in lm.cross_entropy_difference(target, background).collect()}
    monkeypatch.setattr(lm, "BUCKETS", 1)
    monkeypatch.setattr(lm, "BUCKET_BYTES", 20_000)
    for scattered in (False, True):
        monkeypatch.setattr(lm, "stored", lambda df, name: kept.setdefault(name, real(df.repartition(3) if scattered and name == "slices" else df, name)))
        kept.clear()
        assert {r["doc_id"]: r for r in lm.cross_entropy_difference(target, background, limit=9000).collect()} == want
        texts = kept["slices"]
        assert not any(kind.startswith("array") for _, kind in texts.dtypes) and sorted(r["doc_id"] for r in texts.collect()) == list(range(302))
        n_bytes, n_slices = texts.agg(F.sum(F.octet_length("text")), F.countDistinct("slice")).first()
        n_bytes += target.agg(F.sum(F.octet_length("text"))).first()[0]
        assert n_bytes > 100_000 and 10 < n_slices < 60
        asked = kept["answers"].agg(F.countDistinct("bucket"), F.count("slice"), F.countDistinct("slice", "bucket")).first()
        assert asked[0] == -(-n_bytes // 20_000) and n_slices <= asked[1] == asked[2] <= n_slices * asked[0]


def test_toxicity(spark, docs, odd, none, labels):
    r = np.random.default_rng(0)
    bad = ["vile", "rotten", "awful"]
    rows = []
    for i in range(600):
        text, toxic = words(30, 1000 + i), i % 5 == 0
        if toxic:
            text += " " + " ".join(r.choice(bad, 1 + i // 5 % 3, replace=False))
        rows.append((i, text, int(toxic)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = {x["doc_id"]: x for x in toxicity.classified(table.select("doc_id", "text"), table.filter("doc_id < 400").select("doc_id", "toxic")).collect()}
    assert all(got[i]["is_toxic"] == bool(t) for i, _, t in rows[400:])
    assert got[410]["p_severe"] >= 0 and toxicity.accepted(table, table).count() == 480
    for df, n in ((docs, len(TEXTS)), (odd, len(TEXTS) + 3), (none, 0)):
        assert toxicity.classified(df, labels).count() == n
    assert toxicity.accepted(docs, labels.filter("false")).columns == docs.columns


def test_a_later_category_rejects_too(spark, monkeypatch):
    chain = toxicity.Chain(("toxic", "severe"), np.zeros(0, np.uint64), (toxicity.Linear(np.zeros(1), -2.0), toxicity.Linear(np.zeros(2), 0.0)))
    monkeypatch.setattr(toxicity, "toxicity_chain", lambda *a: chain)
    df = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    row = toxicity.classified(df, df).first()
    assert row["p_toxic"] < 0.3 <= row["p_severe"] and row["is_toxic"] and toxicity.accepted(df, df).count() == 0


def test_byte_round_trip(docs, odd, none):
    encoder = bpe.byte_encoder(BYTE)
    for r in bytebpe.round_trip(docs, BYTE).collect():
        t = TEXTS[r["doc_id"]] or ""
        ids = encoder.encode([t])[0].tolist()
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(" ".join(map(str, ids))), sha(t))
    assert bytebpe.round_trip(odd, BYTE).count() == len(TEXTS) + 3 and bytebpe.round_trip(none, BYTE).count() == 0
    back = {r["doc_id"]: r["text"] for r in bytebpe.decoded(bytebpe.encoded(docs, BYTE), BYTE).collect()}
    assert back == {d: t or "" for d, t in TEXTS.items()}
    for r in bytebpe.encoded(docs, BYTE).collect():
        assert len(r["ids"]) == len(r["offsets"]) and (r["offsets"] or [0])[-1] == len((TEXTS[r["doc_id"]] or "").encode())


def test_fingerprints_by_brute_force(spark, docs):
    """Sketches, likeness of edited texts and of neighbours, recomputed in Python from shingle hashes that Spark gives."""
    import re

    rows = {r["doc_id"]: r for r in sketch.fingerprints(docs).collect()}
    order = sorted(TEXTS, reverse=True)

    def grams(text):
        w = [x for x in re.split(r"[\W_]+", text.lower()) if x]
        return [w[i : i + 5] for i in range(len(w) - 4)] if len(w) >= 5 else [w] if w else None

    edited = {}
    for k, d in enumerate(order):
        own, following = TEXTS[d] or "", TEXTS[order[(k + 1) % len(order)]] or ""
        edited[d] = own[: len(own) - len(own) // 2] + following[: len(own) // 2]
    texts = {(d, e): t for e, ts in ((0, {d: TEXTS[d] or "" for d in TEXTS}), (1, edited)) for d, t in ts.items()}
    wanted = [(k[0], k[1], g) for k, t in texts.items() for g in grams(t) or []] + [(k[0], k[1], None) for k, t in texts.items() if grams(t) is None]
    frame = spark.createDataFrame([(d, e, g, texts[d, e]) for d, e, g in wanted], "d long, e int, g array<string>, t string")
    found = defaultdict(set)
    for r in frame.select("d", "e", F.when(F.col("g").isNull(), F.xxhash64("t")).otherwise(F.xxhash64("g")).alias("h")).collect():
        found[r["d"], r["e"]].add(r["h"])
    least = -(2**63) + 2**64 // 8
    kept = {k: {h for h in hs if h < least} or {min(hs)} for k, hs in found.items()}
    shown = lambda hs: "".join(f"{h % 2**64:016x}" for h in sorted(hs))
    like = lambda a, b: len(a & b) / len(a | b)
    for k, d in enumerate(order):
        nxt = order[(k + 1) % len(order)]
        if d == 9 or nxt == 9:  # letters and marks of other scripts split as Java's classes do
            continue
        assert rows[d]["fingerprint"] == shown(kept[d, 0]) and rows[d]["edited_fingerprint"] == shown(kept[d, 1]), d
        assert rows[d]["near_edited"] == pytest.approx(like(kept[d, 0], kept[d, 1])) and rows[d]["near_next"] == pytest.approx(like(kept[d, 0], kept[nxt, 0]))


def test_quality_by_brute_force(spark, docs, labels):
    """Posteriors recomputed from the documents' own probabilities: shrunk means without the document itself."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    marked = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    got = quality.classified(rows, marked, "source", "lang").join(rows.select("doc_id", "source", "lang"), "doc_id").collect()
    p = {r["doc_id"]: r["p"] for r in got}
    groups, hosts = defaultdict(list), defaultdict(list)
    for r in got:
        groups[r["source"], r["lang"]].append(r["p"])
        hosts[r["source"]].append(r["p"])
    mean = sum(p.values()) / len(p)

    def strength(parts, centre):
        n = [len(x) for x in parts]
        m = [sum(x) / len(x) for x in parts]
        within = sum(sum(v * v for v in x) - sum(x) * k for x, k in zip(parts, m)) / max(1, sum(n) - len(n))
        between = (sum(a * (k - c) ** 2 for a, k, c in zip(n, m, centre)) - within * (len(n) - 1)) / max(1e-9, sum(n) - sum(a * a for a in n) / sum(n))
        return min(1e6, max(1.0, within / max(1e-9, between)))

    kh = strength(list(hosts.values()), [mean] * len(hosts))
    whole = {h: (kh * mean + sum(x)) / (kh + len(x)) for h, x in hosts.items()}
    kp = strength(list(groups.values()), [whole[h] for h, _ in groups])
    odds = lambda x: min(max(x, 1e-9), 1 - 1e-9) / (1 - min(max(x, 1e-9), 1 - 1e-9))
    for r in got:
        h, g = hosts[r["source"]], groups[r["source"], r["lang"]]
        host = (kh * mean + sum(h) - r["p"]) / (kh + len(h) - 1)
        path = (kp * host + sum(g) - r["p"]) / (kp + len(g) - 1)
        want = odds(r["p"]) * odds(path) / odds(mean)
        assert r["posterior"] == pytest.approx(want / (1 + want), rel=1e-6) and r["is_good"] == (r["posterior"] >= 0.5)
    good = {r["doc_id"]: r["quality"] for r in marked.collect()}
    known = [d for d in p if d in good]
    assert sum((p[d] >= 0.5) == bool(good[d]) for d in known) >= 0.85 * len(known)  # 87 labels train this model


def test_chain_by_brute_force():
    """Folds by id, out-of-fold probabilities for the second model and the choice of words, recomputed with dense matrices."""
    r = np.random.default_rng(7)
    n, width = 240, 12
    words_of = [sorted(set(r.integers(1, width + 1, 5).tolist())) for _ in range(n)]
    y = np.array([int(1 in w) for w in words_of])
    two = np.stack([y, np.array([int(1 in w and 2 in w) for w in words_of])], axis=1)
    ids = r.permutation(n) * 17
    held = pa.array([[w * 1000 for w in ws] for ws in words_of], pa.list_(pa.int64()))
    chain = toxicity.train_chain(ids, held, two, ("a", "b"), telling=2.0)
    seen = sorted({w for ws in words_of for w in ws})
    telling = []
    for w in seen:
        has = np.array([w in ws for ws in words_of])
        z = max(abs((two[has, k].sum() - has.sum() * two[:, k].mean())) / np.sqrt(has.sum() * two[:, k].mean() * (1 - two[:, k].mean()) + 1e-9) for k in (0, 1))
        telling += [w] if z >= 2.0 and has.sum() >= toxicity.MIN_DOCS else []
    assert chain.vocabulary.tolist() == [w * 1000 for w in telling]
    x = np.array([[float(w in ws) for w in telling] for ws in words_of])
    from cohortmill.llm.linear import fit
    from cohortmill.llm.pretok import mixed

    def dense(x, y):
        row, col = np.nonzero(np.ones_like(x))
        return fit(row, col, x[row, col], y.astype(float), x.shape[1], 0.1)

    proba = lambda m, x: 1 / (1 + np.exp(-(x @ m.weights[: x.shape[1]] + m.bias)))
    fold = (mixed(ids.astype(np.int64).view(np.uint64)) % np.uint64(5)).astype(int)
    out = np.zeros(n)
    for f in range(5):
        out[fold == f] = proba(dense(x[fold != f], two[fold != f, 0]), x[fold == f])
    second = dense(np.c_[x, out], two[:, 1])
    first = dense(x, two[:, 0])
    assert np.allclose(chain.models[0].predict(*np.nonzero(x), np.ones(int(x.sum())), n), proba(first, x), atol=1e-3)
    both = np.c_[x, out]
    row, col = np.nonzero(np.ones_like(both))
    assert np.allclose(chain.models[1].predict(row, col, both[row, col], n), proba(second, both), atol=1e-3)


def test_layout_changes_no_model(spark, docs, labels):
    again = docs.repartition(3).orderBy(F.desc("doc_id"))
    a, b = ({r["doc_id"]: (r["p_toxic"], r["p_severe"]) for r in toxicity.classified(x, labels).collect()} for x in (docs, again))
    assert a == b


def test_clashing_columns_stay(spark, docs, labels):
    clash = docs.withColumns({"p": F.lit(7), "_p": F.lit(8), "row": F.lit(9), "_row": F.lit(10), "ROW2": F.lit(11)})
    for kept in (toxicity.accepted(clash, labels.filter("false")), minhash.deduplicated(clash), quality.accepted(clash, labels.filter("false"), "source", "lang")):
        assert kept.columns == clash.columns
        first = kept.first()
        assert (first["p"], first["_p"], first["row"], first["_row"]) == (7, 8, 9, 10)


def test_all_pairs_of_the_documents_table(spark):
    """Every pair of the table with a likeness of 0.8 or more shares a class, and the classes are those of brute force."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    held = minhash.Held(pa.array([r["text"] or "" for r in rows]), 5)
    empty = np.diff(held.at) == 0
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    inverted, size = defaultdict(list), np.bincount(held.doc, held.count, held.n)
    for d, h, c in zip(held.doc.tolist(), held.item.tolist(), held.count.tolist()):
        inverted[h].append((d, c))
    both = Counter()
    for own in inverted.values():
        for i, (a, x) in enumerate(own):
            for b, y in own[:i]:
                both[a, b] += min(x, y)
    pairs = [(a, b) for (a, b), n in both.items() if n / (size[a] + size[b] - n) >= 0.8] + [(i, int(np.flatnonzero(empty)[0])) for i in np.flatnonzero(empty)]
    for a, b in pairs:
        parent[root(a)] = root(b)
    want = defaultdict(set)
    for i, r in enumerate(rows):
        want[root(i)].add(r["doc_id"])
    found = minhash.near_duplicates(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    assert len([1 for a, b in pairs if a != b]) > 50 and classes_of(found) == {frozenset(v) for v in want.values()}


def test_blocks_compare_exactly():
    """All likenesses of a block against pairs one by one, with counts above one and shared columns beyond a chunk."""
    r = np.random.default_rng(11)
    texts = [" ".join(f"w{x}" for x in r.integers(0, 40, r.integers(0, 400))) for _ in range(12)] + ["a b c d e a b c d e a b c d e", "a b c d e", ""]
    held = minhash.Held(pa.array(texts), 2)
    want = [[minhash.overlap(held.bag(i), held.bag(j)) if len(held.bag(i)[0]) or len(held.bag(j)[0]) else 0.0 for j in range(held.n)] for i in range(held.n)]
    others = ~np.eye(held.n, dtype=bool)  # a text is not held against itself
    for columns in (minhash.COLUMNS, 7):
        with mock.patch.object(minhash, "COLUMNS", columns):
            assert np.allclose(held.likenesses()[others], np.array(want)[others])


def test_packing_is_the_same_in_any_layout(docs):
    count = lambda df: sorted(r["n_tokens"] for r in tokens.sequences(df, BYTE, room=256).collect())
    assert count(docs) == count(docs.repartition(5)) == count(docs.coalesce(1))


def test_no_table_without_a_shared_folder(monkeypatch):
    import types

    from cohortmill.llm import shared

    conf = types.SimpleNamespace(get=lambda *a: None)
    unset = types.SimpleNamespace(isEmpty=lambda: True)
    sc = types.SimpleNamespace(master="spark://host:7077", _jsc=types.SimpleNamespace(sc=lambda: types.SimpleNamespace(getCheckpointDir=lambda: unset)))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_dir(types.SimpleNamespace(sparkContext=sc, conf=conf))
