"""Which tables count: the written rules on single trials, and against a second telling of them, one trial at a time, on random ones."""

import random

from pyspark.sql import functions as F

from cohortmill.operators.counted import UNKNOWN, counted_block, posted_tables, select_counted

CATEGORIES = ["white", "asian", "other", UNKNOWN]
SPECIFIC = ["white", "asian"]
SCHEMA = "t int, position int, line int, label string, category string, subcategory string, n long, negates boolean, flags array<string>, analyzed long, population string, extra string"


def blocks(spark, trials):
    """trials: {id: (total, [(analyzed, population, [(category, subcategory, n) or (category, subcategory, n, negates)])])}"""
    rows = [(t, p, i, f"{c}", c, s, n, bool(x and x[0]), ["seen"] if c == "other" else None, analyzed, population, "x")
            for t, (_, tables) in trials.items() for p, (analyzed, population, posted) in enumerate(tables) for i, (c, s, n, *x) in enumerate(posted)]
    size = spark.createDataFrame([(t, total) for t, (total, _) in trials.items()], "t int, total long")
    tables = posted_tables(spark.createDataFrame(rows, SCHEMA), "t", SPECIFIC).join(size, "t")
    chosen = select_counted(tables, "t", "total").cache()
    block = counted_block(chosen, size, "t", "total", "race", CATEGORIES)
    roles = {t: [] for t in trials}
    for r in chosen.orderBy("t", "position").collect():
        roles[r.t].append((r.position, r.counted, r.partitioned))
    return roles, {r.t: r for r in block.collect()}


def test_written_rules(spark):
    w, a, u, o = (lambda n, s=None: ("white", s, n)), (lambda n, s=None: ("asian", s, n)), (lambda n: (UNKNOWN, None, n)), (lambda n: ("other", None, n))
    trials = {
        1: (40, [(20, "Mothers", [w(12), a(8)]), (20, "children ", [w(12), a(8)])]),  # parts told apart by their description
        2: (40, [(20, None, [w(12), a(8)]), (20, " ", [w(12), a(8)])]),  # the same table twice
        3: (40, [(30, None, [w(30)]), (10, None, [u(10)])]),  # a part without specific categories is one all the same
        4: (40, [(None, None, [w(30), a(5)]), (None, None, [w(30), a(5), u(5)]), (10, None, [w(10)])]),  # the fullest of the whole population
        5: (25, [(None, None, [a(25)]), (None, None, [a(25, "east_asian")])]),  # posted again in more detail
        6: (25, [(None, None, [u(8), a(5)]), (None, None, [o(8), a(5, "east_asian")])]),  # a tie with another category: the first
        7: (25, [(None, None, [u(25)]), (None, None, [w(3)])]),  # only one places people
        8: (None, [(None, None, [w(3)]), (5, None, [w(4)])]),  # no population known
        9: (10, [(None, None, [w(0), a(0)])]), 10: (10, []),  # zeros only; nothing posted
        11: (30, [(None, None, [w(20), (None, None, 10)])]), 12: (30, [(None, None, [w(20), (None, None, 10, True)])]), 13: (30, [(None, None, [w(20), u(4), (None, None, 9)])]),  # rows kept apart
        14: (30, [(None, None, [w(20), w(20)])]), 15: (30, [(None, None, [(None, None, 30)])]), 16: (30, [(None, None, [w(None), a(30)])]),  # over the population; other rows only; a null
        17: (40, [(None, None, [u(2)]), (25, None, [w(25)]), (15, None, [a(15)])]),  # parts among those that place people
        18: (40, [(25, None, [w(26)]), (15, None, [a(14)])]),  # a part counts more than it has
    }
    roles, b = blocks(spark, trials)
    counted = {t: [p for p, c, _ in r if c] for t, r in roles.items()}
    assert counted == {1: [0, 1], 2: [0], 3: [0, 1], 4: [1], 5: [1], 6: [0], 7: [1], 8: [1], 9: [0], 10: [], 11: [0], 12: [0], 13: [0], 14: [0], 15: [0], 16: [0], 17: [1, 2], 18: [0]}
    assert b[1].totals == {"white": 24, "asian": 16, "other": 0, UNKNOWN: 0} and b[1].flags == ["multiple_race_tables_2", "race_tables_partitioned", "race_tables_partitioned_by_description"]
    assert b[2].totals[UNKNOWN] == 20 and b[2].unknown_inferred == 20 and b[2].flags == ["denominator_balanced", "multiple_race_tables_2", "race_table_superseded"]
    assert (b[3].n_counted, b[3].unknown_explicit, b[3].flags) == (2, 10, ["multiple_race_tables_2", "race_tables_partitioned"])
    assert b[5].subtotals == {"asian_east_asian": 25} and b[4].totals == {"white": 30, "asian": 5, "other": 0, UNKNOWN: 5}
    assert (b[8].totals["white"], b[8].unknown_inferred) == (4, 0)
    assert not b[9].reported and b[9].flags == ["all_zero_rejection"] and not b[10].reported and b[10].flags == [] and b[10].n_tables == 0
    assert (b[11].unknown_elsewhere, b[11].unknown_inferred) == (10, 0) and b[11].flags == ["denominator_balanced", "other_rows_skipped", "shortfall_is_other_rows"]
    assert (b[12].unknown_elsewhere, b[12].unknown_inferred) == (0, 10) and (b[13].unknown_explicit, b[13].unknown_inferred, b[13].totals[UNKNOWN]) == (4, 6, 10)
    assert b[14].totals["white"] == 40 and b[14].unknown_inferred == 0 and b[16].n_posted == 30
    assert not b[15].reported and b[15].flags == ["all_zero_rejection", "other_rows_skipped"]


def told_again(total, tables):
    """The positions that count, by the rules as sentences."""
    def sums(posted):
        out = {}
        for c, _, n in posted:
            out[c] = out.get(c, 0) + n
        return {c: n for c, n in out.items() if n}

    def score(i):
        return sum(n for c, _, n in tables[i][2] if c in SPECIFIC), sum(n for _, _, n in tables[i][2])

    def best(among):
        top = max(map(score, among))
        tied = [i for i in among if score(i) == top]
        tied = [i for i in tied if sums(tables[i][2]) == sums(tables[tied[0]][2])]
        return [max(tied, key=lambda i: (sum(n for _, s, n in tables[i][2] if s), -i))]

    def parts(among):
        own = [tables[i][0] for i in among]
        seen = {(tables[i][0], tuple(sorted(sums(tables[i][2]).items())), tables[i][1]) for i in among}
        return total is not None and None not in own and max(own) < total == sum(own) and len(seen) == len(among) and all(score(i)[1] <= tables[i][0] for i in among)

    every = list(range(len(tables)))
    told = [i for i in every if score(i)[0] > 0]
    if len(every) <= 1 or parts(every):
        return every
    if len(told) < 2 or total is None:
        return best(told or every)
    whole = [i for i in told if tables[i][0] is None or tables[i][0] >= total]
    return best(whole) if whole else told if parts(told) else best(told)


def test_random_trials(spark):
    r = random.Random(7)
    trials = {}
    for t in range(600):
        total = r.choice([None, 4, 4, 6, 6, 8])
        tables = [(r.choice([None, 2, 2, 3, 4, 6]), r.choice([None, "a", "b"]), [(r.choice(CATEGORIES), r.choice([None, None, "x"]), r.randrange(3)) for _ in range(r.randrange(1, 4))]) for _ in range(r.randrange(1, 4))]
        trials[t] = (total, tables)
    roles, b = blocks(spark, trials)
    for t, (total, tables) in trials.items():
        want = told_again(total, tables)
        assert [p for p, c, _ in roles[t] if c] == want, (t, total, tables)
        n = sum(n for i in want for _, _, n in tables[i][2])
        assert b[t].n_posted == n and sum(b[t].totals.values()) == (max(n, total or 0) if n else 0)
    assert sum(any(p for *_, p in r) for r in roles.values()) > 5


def test_sums_say_what_rows_say(spark):
    """With the categories given, no rows are collected: the same tables count, and the block is the same."""
    r = random.Random(11)
    rows = [(t, p, i, "x", r.choice([*CATEGORIES, None]), r.choice([None, "x"]), r.choice([None, 0, 1, 2, 3]), r.random() < 0.2, r.choice([None, [], ["seen"]]), r.choice([None, 2, 4, 6]), r.choice([None, "a", "b"]), "x")
            for t in range(300) for p in range(r.randrange(1, 4)) for i in range(r.randrange(1, 4))]
    df, size = spark.createDataFrame(rows, SCHEMA), spark.range(310).selectExpr("cast(id as int) t", "nullif(id % 9, 0) total")
    held, found = F.col("line") + F.col("t") % 4 != 3, []
    for given in (None, CATEGORIES):
        tables = posted_tables(df, "t", SPECIFIC, held, given, given and 3).join(size, "t")
        chosen = select_counted(tables, "t", "total").cache()
        assert ("rows" in chosen.columns) == (given is None)
        block = counted_block(chosen, size, "t", "total", "race", CATEGORIES)
        found.append(([tuple(x) for x in chosen.select("t", "position", "n_rows", "posted_n", "counted_n", "apart_n", "denied_n", "counted", "partitioned", "by_description").orderBy("t", "position").collect()], [x.asDict() for x in block.drop("kept_apart").orderBy("t").collect()]))
        if given is None:
            assert all(x.n_apart == sum(y.n for y in x.kept_apart or []) for x in block.collect())
    assert found[0] == found[1] and len(found[0][1]) == 310
    bare = posted_tables(df.drop("subcategory", "flags", "analyzed", "population"), "t", SPECIFIC, held, CATEGORIES).join(size, "t")
    block = counted_block(select_counted(bare, "t", "total"), size, "t", "total", "race", CATEGORIES)
    assert all(x.subtotals == {} and sum(x.totals.values()) == (max(x.n_posted, x.total or 0) if x.reported else 0) for x in block.collect())


def test_one_shuffle(spark):
    rows = spark.range(50).selectExpr("cast(id % 9 as int) t", "cast(id % 2 as int) position", "1 line", "'x' label", "'white' category", "cast(null as string) subcategory", "id n", "false negates", "cast(null as array<string>) flags", "cast(null as long) analyzed", "cast(null as string) population")
    t = select_counted(posted_tables(rows, "t", SPECIFIC).selectExpr("*", "10L as total"), "t", "total")
    assert t._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning") == 1
