"""Keywords in condition names: within words, the longest first, else the most alike; against brute force."""

import random

import pytest

from cohortmill.functions.fuzzy import best_of, indel_ratio, token_set_ratio
from cohortmill.operators import links

ONTOLOGY = {"Neuro": {"Widget": ["widget"], "Short": ["a-b", "x"]}, "Metabolic": {"Diabetes": ["diabet", "Type 2 Diabetes"], "Same length": ["mellit"]}, "Other kind": {"Again": ["widget"], "Two words": ["heart failure"]}}


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = [0] + [0] * len(b) if not b else row
        before = 0
        for j, y in enumerate(b, 1):
            keep, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
            before = keep
    return row[-1]


def test_ratio_by_brute_force():
    r = random.Random(5)
    for _ in range(400):
        a, b = ("".join(r.choice("abcd é") for _ in range(r.randint(0, 90))) for _ in "ab")
        want = 200.0 * common(a, b) / (len(a) + len(b)) if a or b else 100.0
        assert indel_ratio(a, b) == want
    words = ["".join(r.choice("abc") for _ in range(r.randint(0, 12))) for _ in range(60)]
    for t in words[:20] + ["abcabcabc"]:
        assert best_of(t, sorted((len(w), w) for w in words[20:])) == max((indel_ratio(t, w), w) for w in words[20:])


def test_keywords(spark):
    rows = links.keyword_rows(ONTOLOGY)
    assert ("widget", "Other kind", "Again", 0) in rows
    keywords = spark.createDataFrame(rows, "keyword string, primary string, secondary string, position int")
    texts = ["blue Widgets, of steel", "type 2 DIABETES mellitus", "diabetes mellitus", "failure, heart", "failure of the heart", None, "", "  ", "...", "zzz", "a-b", "fox", "prediabetic " * 400, "Heart   failure"]
    got = {r.t: (r.primary, r.secondary) for r in links.longest_keyword(spark.createDataFrame([(t, 1) for t in texts], "t string, n int"), "t", keywords).collect()}
    plain = lambda t: " ".join("".join(c if c.isalnum() or c in "_-/ " else " " for c in t.lower()).split())
    order = sorted(rows, key=lambda k: -len(k[0]))
    for t in texts:
        hit = next((k for k in order if t and plain(t) and k[0] in plain(t)), None)
        if hit is None and t and plain(t):
            score, _, near = max((token_set_ratio(plain(t), k[0]), -i, k) for i, k in enumerate(order))
            hit = near if score >= 85 else None
        assert got[t] == (hit[1:3] if hit else ("Other", "Uncategorized")), t
    assert got["blue Widgets, of steel"] == ("Other kind", "Again") and got["type 2 DIABETES mellitus"] == ("Metabolic", "Diabetes") and got["failure, heart"] == ("Other kind", "Two words")


def test_too_many_keywords(spark, monkeypatch):
    monkeypatch.setattr(links, "MOST_KEYWORDS", 2)
    keywords = spark.createDataFrame(links.keyword_rows(ONTOLOGY), "keyword string, primary string, secondary string, position int")
    with pytest.raises(ValueError):
        links.longest_keyword(spark.createDataFrame([("a",)], "t string"), "t", keywords)
