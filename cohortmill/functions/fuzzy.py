"""Likeness of short texts, for the distinct labels that no rule reads: an indel ratio, and the same over sets of words."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .labels import label_key


def places(text: str) -> dict[str, int]:
    """For every letter the bits of its places."""
    masks: dict[str, int] = {}
    for i, x in enumerate(text):
        masks[x] = masks.get(x, 0) | 1 << i
    return masks


def common_length(masks: dict[str, int], n: int, other: str) -> int:
    """The length of the longest common subsequence, all places of the first text (n letters) at once for each letter of the other."""
    whole = (1 << n) - 1
    open_ones = whole
    for x in other:
        hit = open_ones & masks.get(x, 0)
        open_ones = ((open_ones + hit) | (open_ones - hit)) & whole
    return n - open_ones.bit_count()


def indel_ratio(a: str, b: str) -> float:
    """200 * common subsequence / total length."""
    if not a and not b:
        return 100.0
    return 200.0 * common_length(places(a), len(a), b) / (len(a) + len(b))


def token_set_ratio(a: str, b: str) -> float:
    """The best indel ratio among the words both have, and those with either's other words behind them; 100 where one's words are all the other's."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and not (left and right):
        return 100.0
    one, two = f"{both} {left}".strip(), f"{both} {right}".strip()
    return max(indel_ratio(one, two), indel_ratio(both, one) if both else 0.0, indel_ratio(both, two) if both else 0.0)


def best_of(text: str, words: list[tuple[int, str]]) -> tuple[float, str]:
    """The highest indel ratio and its word. words: by length. Lengths bound the ratio, so words of other lengths need no look once one is close."""
    masks, n, best = places(text), len(text), (-1.0, "")
    for size, word in words:
        total = n + size
        most = 100.0 if not total else 200.0 * min(n, size) / total
        if most >= best[0]:
            ratio = 100.0 if not total else 200.0 * common_length(masks, n, word) / total
            best = max(best, (ratio, word))
    return best


def closest(labels: DataFrame, column: str, words: list[tuple[str, str]], least: float, text: Column | None = None, ratio: Callable[[str, str], float] = indel_ratio, rank: dict[str, int] | None = None) -> DataFrame:
    """(column, outcome, ratio) of every distinct label: the outcome of the closest word if that is close enough; ties go to the later word by alphabet,
    or to the word of the highest rank. text: what is compared, by default the label in lower case without footnote marks."""
    outcomes = dict(words)
    sized = sorted((len(w), w) for w in outcomes)

    @F.pandas_udf("struct<outcome string, ratio double>")
    def nearest(texts: pd.Series) -> pd.DataFrame:
        found = []
        for t in texts:
            if ratio is indel_ratio and rank is None:
                score, word = best_of(t, sized)
            else:
                score, _, word = max((ratio(t, w), rank[w] if rank else 0, w) for w in outcomes)
            found.append((outcomes[word] if score >= least else None, score))
        return pd.DataFrame(found, columns=["outcome", "ratio"])

    text = label_key(F.col(column)) if text is None else text
    # called not deterministic, lest Spark move a condition on the outcome, and the comparing with it, before distinct() to every row;
    # spread by number: the texts are few bytes and much work, and Spark would take them to one task by their size
    known = labels.select(column).distinct().repartition(int(labels.sparkSession.conf.get("spark.sql.shuffle.partitions")), column)
    return known.select(column, nearest.asNondeterministic()(F.coalesce(text, F.lit(""))).alias("x")).select(column, "x.*")
