"""Phrases, spelling variants and URL filters: odd rows, and brute force or SQL over whole tables."""

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortmill.llm import phrases, queries, urltree, variants

DATA = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def brute_phrases(texts, least=10, top=2000):
    counts, n, out = defaultdict(Counter), Counter(), []
    for lang, text in texts:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                counts[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    for lang, f in counts.items():
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {q for p, a in frequent.items() if len(p) == 3 for q in (p[:2], p[1:]) if 100 * a >= 50 * f[q]}
        ranked = []
        for p, a in frequent.items():
            if p not in gone:
                score, _, l, r = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), a, l, r))
        out += [(lang, i, p.decode(), a, l, r, n[lang], -s) for i, (s, _, p, a, l, r) in enumerate(sorted(ranked)[:top], 1)]
    return sorted(out, key=str)


def brute_variants(texts, length=6, least=5, ratio=5, damage=199):
    n = Counter()
    for i, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % damage == 0 else run] += 1
    n = {w: c for w, c in n.items() if len(w) >= length and c >= least}
    by, near = defaultdict(set), defaultdict(set)
    for w in n:
        for i in range(len(w)):
            by[i, w[:i] + w[i + 1 :]].add(w)
            if w[:i] + w[i + 1 :] in n:
                near[w].add(w[:i] + w[i + 1 :])
                near[w[:i] + w[i + 1 :]].add(w)
    for group in by.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, words of any length, clashing names."""
    r = np.random.default_rng(7)
    vocabulary = [f"wört{chr(97 + i % 26)}{chr(97 + i // 26)}ß" for i in range(40)] + ["colour", "color", "colours", "the", "of"]
    some = lambda n: " ".join(r.choice(vocabulary, n))
    texts = [some(400), None, "", some(3000).replace(" the ", ". The, ", 50), "Ab c. ab C, ab; c\n" * 12, "é" * 300, "é" * 299 + "à", "x y z " * 30, "\t\t  ..,,", some(300), "A" * 50 + " " + "aa " * 40]
    data = [(i, t, [None, "en", "und", ""][i % 4], 1, 1, 1, "s") for i, t in enumerate(texts)] * 6 + [(None, texts[0], "en", 1, 1, 1, "s")]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, rank int, n int, wid long, phrase string")


@pytest.mark.parametrize("limit", [300, 8 << 20])
def test_phrases(odd, limit):
    want = brute_phrases([(r.lang, r.text) for r in odd.collect()])
    got = phrases.collocations(odd, limit=limit)
    assert rows(got) == want and len(want) > 100
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_phrases_of_first_ranks(odd):
    texts = [(r.lang, r.text) for r in odd.collect()]
    assert rows(phrases.collocations(odd, least=3, top=7)) == brute_phrases(texts, 3, 7)


def test_products_beyond_64_bits(spark):
    df = spark.createDataFrame([(5 * 10**12, 6 * 10**12, 7 * 10**12)], "a long, l long, r long")
    assert df.select(F.expr(phrases.score("l", "r"))).first()[0] == 10**6 * 25 // 42


def test_windows_hold_every_ngram_once():
    text = np.frombuffer(b"a bb ccc. " + b"x" * 500 + b" d e, f g h i j k" * 9, np.uint8)
    whole = Counter()
    for a, b, skip in phrases.windows(text, 40):
        w = [(m.start(), m.group()) for m in re.finditer(rb"[^ .,]+", text[a:b].tobytes())]
        whole.update((a + s, x) for s, x in w[skip:])
    assert whole == Counter((m.start(), m.group()) for m in re.finditer(rb"[^ .,]+", text.tobytes()))


def test_equal_states_are_kept_once():
    """Sharing makes a transducer smaller and changes no count."""
    text = b". ".join(b"pre%d mid%d end" % (i, i) for i in range(300))
    data = np.frombuffer(text, np.uint8)
    import pyarrow as pa

    trie = phrases.counted(data, np.array([0, len(data)]), np.zeros(1, np.int64), pa.array(["en"]), np.full(128, 255, np.uint8))
    ((_, blob),) = phrases.transducers(trie, phrases.Ring.of(trie.symbols, 1))
    assert len(phrases.load(blob, 13)[11]) == 1 and len(trie.c3) == 300
    back = phrases.united([phrases.unfolded(blob)])
    assert (len(back.c1), len(back.c2), len(back.c3)) == (300, 300, 300) and back.c3.sum() == trie.c3.sum() == 300
    none = phrases.counted(data, np.array([0, len(data)]), np.zeros(1, np.int64), pa.array(["en"]), np.zeros(128, np.uint8))
    assert not len(none.c3)


def test_states_with_label_and_count_exchanged_differ():
    """Signatures tell (label a, count b) from (label c, count d), whatever these are."""
    n = 40
    label, weight = (x.ravel() for x in np.meshgrid(np.arange(n), np.arange(1, n + 1)))
    states = np.arange(len(label))
    number, arcs, sizes = phrases.registered(states, np.zeros(len(label), np.int64), label, weight, np.zeros(len(label), np.int64), len(label))
    assert len(set(number)) == len(arcs) == len(label) and set(sizes) == {1}


def test_variants(odd):
    want = brute_variants([(r.doc_id, r.text) for r in odd.collect()])
    assert rows(variants.grouped(odd)) == want
    assert any(w[1] for w in want) and any(len(w[0]) > 64 and w[4] for w in want)


def test_variants_in_chains(spark):
    """Roots lie several forms away; ties go to the first word."""
    chain = ["aaaaaa", "aaaaab", "aaaabb", "aaabbb", "aabbbb", "abbbbb"]
    text = " ".join(w for k, w in enumerate(chain) for _ in range(2 * 2 ** (k + 1))) + " " + "zzzzzy zzzzzx " * 40 + "zzzzzz " * 4
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = {r.word: r for r in variants.grouped(df, least=1, ratio=2, damage=10**12).collect()}
    assert got["aaaaaa"].root == "abbbbb" and got["aaaaaa"].form == "aaaaab" and got["zzzzzz"].form == "zzzzzx" and got["zzzzzz"].n_near == 2
    assert rows(variants.grouped(df, least=1, ratio=2, damage=3)) == brute_variants([(1, text)], least=1, ratio=2, damage=3)
    with pytest.raises(ValueError):
        variants.grouped(df, ratio=1)


def test_scan_across_batches(spark):
    """A range that two batches share is one range."""
    import pyarrow as pa

    key = ["a", "b", "b", "b", "c", "c", "d"]
    data = [pa.array(key), pa.array(range(7), pa.int64()), pa.array([9, 8, 7, 6, 5, 4, 3], pa.int64()), pa.array([1, 0, 2, 1, 1, 1, 2], pa.int32())]
    whole = pa.RecordBatch.from_arrays(data, ["key", "wid", "n", "kind"])
    got = [r for size in (1, 2, 7) for r in [sorted(tuple(x.values()) for b in variants.scanned(iter([whole.slice(i, size) for i in range(0, 7, size)])) for x in b.to_pylist())]]
    assert got[0] == got[1] == got[2] == [(1, 1, 7, 2), (2, 2, 8, 1), (3, 1, 7, 2), (4, 1, 4, 5), (5, 1, 5, 4)]


def page_rows(df, columns="page_id, host, path, rule, verdict, template"):
    return sorted(map(str, map(tuple, df.selectExpr(*columns.split(", ")).collect())))


@pytest.fixture(scope="module")
def pages(spark):
    urls = [None, "", "no scheme/en/1", "http://", "http://COM", "HTTP://Www.Example.COM/en/1?x=/es/", "http://a.net#/es/1", "http://x.net/es/1", "http://net/fr", "http://net/fr/", "http://xnet/fr/2", "ftp://example.com/en/", "http://b.org//a//b/"]
    urls += [f"http://shop.org/{a}/item-{i}.html" for a in ("ads", "ads2", "news") for i in range(30)] + ["http://one.org/x"] * 5 + [f"http://many.org/{chr(97 + i % 26)}{chr(97 + i // 26)}/p" for i in range(200)]
    urls += ["http://deep.org/" + "a/" * 2000]
    return spark.createDataFrame([(i, u, "<p>", "h", 1) for i, u in enumerate(urls)] + [(None, "http://b.org/", "", "h", 1)] * 2, "page_id long, url string, html string, host string, n int")


def test_urls_by_sql(spark, pages):
    con = duckdb.connect()
    held = pages.select("page_id", "url").toArrow()
    con.register("pages", held)
    want = con.execute(queries.ORACLES["op13_path_template_filter"]).fetchall()
    got = page_rows(urltree.verdicts(pages, queries.URL_RULES))
    assert got == sorted(map(str, want)) and len(got) == pages.count()


def test_templates(spark):
    """Branches that are rejected alike are one; unlabelled ones are left alone; a mixed branch stands apart from a bad one."""
    rule = [("bad.org", "/ads/", "block"), ("bad.org", "/spam/", "block"), ("bad.org", "/news/ok", "allow")]
    urls = [f"http://bad.org/{a}/{i}" for a in ("ads", "spam", "talk", "blog") for i in range(40)] + [f"http://bad.org/news/ok{i}" for i in range(40)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {(r.template, r.verdict) for r in urltree.verdicts(pages, rule).collect() if r.rule is None}
    assert got == {("/blog|talk/*", "allow")}
    said = urltree.judged(pages, rule)
    count = lambda c: F.count(F.when(c, True))
    addresses = said.groupBy("host", "path").agg(F.count("*").alias("n"), count(F.col("says").isNotNull()).alias("labelled"), count(F.col("says") == "block").alias("rejected"))
    tree = {r.template: (r.n, r.verdict) for r in urltree.template_tree(urltree.templates(addresses)).collect()}
    assert tree["/ads|spam/*"] == (80, "block") and tree["/blog|talk/*"] == (80, "allow") and tree["/news/*"] == (40, "allow")


def test_no_rows(spark, odd, pages):
    assert phrases.collocations(odd.filter("false")).count() == 0
    assert variants.grouped(odd.filter("false")).count() == 0
    assert urltree.verdicts(pages.filter("false"), queries.URL_RULES).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    found = con.execute(queries.ORACLES[name])
    columns = [c[0] for c in found.description]
    df = queries.QUERIES[name](spark, DATA)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(str(tuple(r[c] for c in columns)) for r in df.collect()) == sorted(map(str, found.fetchall()))


def test_variants_of_documents(spark):
    docs = queries.table(spark, DATA, "documents")
    assert rows(queries.op12_permuterm_variants(spark, DATA)) == brute_variants([(r.doc_id, r.text) for r in docs.collect()])
