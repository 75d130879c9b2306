"""What tables that belong together must agree on: keys, references, vocabularies, published totals. Each table is read once, and all rules are one aggregate."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Total(NamedTuple):
    """A figure that a row publishes about the rows of another table that refer to it."""

    stated: Column
    table: str
    reference: str
    number: str | None = None  #: the column that is summed; without one rows are counted


class Terms(NamedTuple):
    """What is declared of one table. Conditions are Columns over its own columns."""

    key: Column
    holds: dict[str, Column] = {}  #: must be true of every row; null is not
    references: dict[str, tuple[str, Column]] = {}  #: the table referred to and the key there; null refers to nothing
    totals: dict[str, Total] = {}  #: null publishes nothing


NUMBER = "decimal(38,6)"


def breaches(tables: dict[str, DataFrame], terms: dict[str, Terms]) -> DataFrame:
    """(table, key, rule, n): every key that breaks a rule, and by how many rows (for a total: how many rows refer to it).

    key_missing and key_repeated; the name of a condition that fails; not_found:<table>.<reference>, under the table that lacks the key; the name of a
    total that its parts do not give, where the key is not repeated (no parts give 0). Keys are compared as strings. Every row becomes a fact
    of its own key and one of each key that it refers to; those of a key meet in one shuffle, added up before it: a hot key costs no more than others. Values stay exact to six decimals."""
    facts, rules, sums = [], {t: {} for t in terms}, {}
    for name, t in terms.items():
        for total, x in t.totals.items():
            if x.reference not in terms[x.table].references or terms[x.table].references[x.reference][0] != name:
                raise ValueError(f"{name}.{total}: {x.table}.{x.reference} does not refer to {name}")
            sums[f"{name}.{total}"] = (x.table, x.reference, x.number)
    # what is told of a table's keys, each in a column of its number; tables share the columns
    told = {t: [] for t in terms}
    for name, t in terms.items():
        told[name] += ["own", *[f"holds:{rule}" for rule in t.holds]]
        for ref, (to, _) in t.references.items():
            told[to].append(f"found:{name}.{ref}")
    valued = {name: list(t.totals) for name, t in terms.items()}
    ns, vs = max(map(len, told.values())), 2 * max(map(len, valued.values()))
    for name, t in terms.items():

        def fact(to: str, key: Column, n: dict[str, Column], values: dict[str, Column]) -> Column:
            columns = [n.get(w, F.lit(None)).cast("bigint") for w in told[to]] + [F.lit(None).cast("bigint")] * (ns - len(told[to]))
            numbers = [values.get(f"{side}:{x}", F.lit(None)).cast(NUMBER) for x in valued[to] for side in ("stated", "parts")]
            numbers += [F.lit(None).cast(NUMBER)] * (vs - len(numbers))
            return F.struct(F.lit(to).alias("table"), key.cast("string").alias("key"), *[c.alias(f"n{i}") for i, c in enumerate(columns)], *[c.alias(f"v{i}") for i, c in enumerate(numbers)])

        broken = {f"holds:{rule}": F.when(~F.coalesce(ok, F.lit(False)), 1) for rule, ok in t.holds.items()}
        own = [fact(name, t.key, {"own": F.lit(1), **broken}, {f"stated:{total}": x.stated for total, x in t.totals.items()})]
        for ref, (to, key) in t.references.items():
            parts = {f"parts:{full.split('.', 1)[1]}": F.coalesce(F.col(number), F.lit(0)) if number else F.lit(1) for full, (child, by, number) in sums.items() if (child, by) == (name, ref)}
            own.append(F.when(key.isNotNull(), fact(to, key, {f"found:{name}.{ref}": F.lit(1)}, parts)))
        facts.append(tables[name].select(F.explode(F.array_compact(F.array(*own))).alias("f")).select("f.*"))
    every = facts[0]
    for one in facts[1:]:
        every = every.unionByName(one)
    met = every.groupBy("table", "key").agg(*[F.sum(c).alias(c) for c in every.columns[2:]])
    broken = lambda when, rule, rows: F.when(when, F.struct(F.lit(rule).alias("rule"), rows.alias("n")))
    for name, t in terms.items():
        n = lambda what, name=name: F.coalesce(f"n{told[name].index(what)}", F.lit(0))
        value = lambda side, x, name=name: F.col(f"v{2 * valued[name].index(x) + (side == 'parts')}")
        here, there = F.col("table") == name, F.col("key").isNotNull()
        found = [broken(here & ~there & (n("own") > 0), "key_missing", n("own")), broken(here & there & (n("own") > 1), "key_repeated", n("own"))]
        found += [broken(here & (n(f"holds:{rule}") > 0), rule, n(f"holds:{rule}")) for rule in t.holds]
        found += [broken(here & (n("own") == 0) & (n(f"found:{c}.{r}") > 0), f"not_found:{c}.{r}", n(f"found:{c}.{r}")) for c, u in terms.items() for r, (to, _) in u.references.items() if to == name]
        found += [broken(here & there & (n("own") == 1) & (value("stated", x) != F.coalesce(value("parts", x), F.lit(0).cast(NUMBER))), x, n(f"found:{total.table}.{total.reference}")) for x, total in t.totals.items()]
        rules[name] = found
    return met.select("table", "key", F.explode(F.array_compact(F.array(*[x for found in rules.values() for x in found]))).alias("b")).select("table", "key", "b.rule", "b.n")
