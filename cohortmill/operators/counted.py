"""Which of a trial's tables of one dimension count, and the block that they make: nobody is counted twice.

All steps keep the partitioning by trial; one shuffle serves them. A trial's tables stand in an array, which is as long as what it posts; tables
are gathered once a trial and chosen where they stand, with no window and no join. What a table's rows add up to is summed while they are
grouped: a block reads numbers of tables, and asks no function of their single rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import bound

UNKNOWN = "unknown_not_reported"

#: What a block reads of a table.
_READ = ("counted_n", "apart_n", "denied_n", "counts", "fine", "said")


def _total(items: Column, read) -> Column:
    return F.aggregate(items, F.lit(0).cast("bigint"), lambda a, x: a + read(x))


def _summed(pairs: Column, name: str) -> Column:
    """array<struct<name, n>> with each name once, in the order of names. Pairs whose names differ are sorted and no more."""
    names = pairs[name]
    again = bound(F.sort_array(F.array_distinct(names)), lambda keys: F.transform(keys, lambda k: F.struct(k.alias(name), _total(pairs, lambda r: F.when(r[name] == k, r["n"]).otherwise(0)).alias("n"))))
    return F.when(F.size(F.array_distinct(names)) == F.size(names), F.sort_array(pairs)).otherwise(again)


def posted_tables(rows: DataFrame, by: str, specific: list[str], held: Column | None = None, categories: list[str] | None = None, parts: int | None = None) -> DataFrame:
    """One row a table. rows: by, position (of the table), line, label, category (null: a row of another dimension, kept apart), subcategory,
    n (null counts 0), negates (a row kept apart that denies what it names), flags, analyzed (the table's own number, null where it posts
    none), population (its description); of these subcategory, flags, analyzed and population may be absent. Rows that are not held only tell that their trial is
    there: n_rows, the number of the others, is 0 in a table of such rows alone.
    specific_n, detailed_n: people in specific categories, in subcategories; posted_n: what all rows add up to (null where none has a number); apart_n, denied_n: people in
    rows kept apart, and in those of them that deny; counts: its categories with people, sorted; fine: its subcategories ('category_subcategory');
    said: the flags of its own rows; rows: all that is held.

    categories: all that rows may have. With them no rows are collected: counts holds a number for each of them, in their order, and all else are sums, too.
    parts: how many partitions hold the rows (Spark's choice, if not given): the sums of one stand in memory."""
    absent = {"subcategory": "string", "flags": "array<string>", "analyzed": "bigint", "population": "string"}
    there_is = lambda c: c in rows.columns
    col = lambda c: F.col(c) if there_is(c) else F.lit(None).cast(absent[c])
    number, there = F.coalesce(F.col("n"), F.lit(0)).cast("bigint"), F.lit(True) if held is None else held
    own, apart, denies = there & F.col("category").isNotNull(), there & F.col("category").isNull(), F.coalesce("negates", F.lit(False))
    n = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("bigint")
    sums = {"n_rows": F.count_if(there), "posted_n": F.sum(F.when(there, F.col("n"))).cast("bigint"), "counted_n": n(own), "specific_n": n(own & F.col("category").isin(*specific)), "apart_n": n(apart), "denied_n": n(apart & denies)}
    sums |= {"detailed_n": n(own & F.col("subcategory").isNotNull())} if there_is("subcategory") else {}
    sums |= {"analyzed": F.max("analyzed").cast("bigint")} if there_is("analyzed") else {}
    sums |= {"population": F.nullif(F.trim(F.regexp_replace(F.lower(F.max("population")), r"\s+", " ")), F.lit(""))} if there_is("population") else {}
    if categories is None:
        row = F.struct(F.col("line").cast("bigint").alias("line"), "label", "category", col("subcategory").alias("subcategory"), number.alias("n"), denies.alias("negates"), F.coalesce(col("flags"), F.array().cast("array<string>")).alias("flags"))
        sums |= {"rows": F.sort_array(F.collect_list(F.when(there, row))), "counts": F.collect_list(F.when(own & (F.col("n") != 0), F.struct("category", number.alias("n"))))}
    else:
        sums |= {f"_n{k}": n(there & (F.col("category") == c)) for k, c in enumerate(categories)}
    if there_is("subcategory"):
        sums["fine"] = F.collect_list(F.when(own & F.col("subcategory").isNotNull(), F.struct(F.concat_ws("_", "category", "subcategory").alias("name"), number.alias("n"))))
    if there_is("flags"):
        sums["said"] = F.flatten(F.collect_list(F.when(own & (F.size("flags") > 0), F.col("flags"))))
    t = (rows.repartition(parts, by) if parts else rows.repartition(by)).groupBy(by, "position").agg(*[c.alias(name) for name, c in sums.items()])
    left = {"analyzed": F.lit(None).cast("bigint"), "population": F.lit(None).cast("string"), "detailed_n": F.lit(0).cast("bigint")}
    t = t.withColumns({c: value for c, value in left.items() if c not in sums})
    if "fine" in sums:
        t = t.withColumn("fine", _summed(F.col("fine"), "name"))
    held_n = [f"_n{k}" for k in range(len(categories or []))]
    return t.withColumn("counts", F.array(*held_n) if categories else _summed(F.col("counts"), "category")).drop(*held_n)


def _are_parts(tables: Column, total: Column) -> Column:
    """Each has a number of its own below the total and counts no more than it, together they are the total, none is posted twice."""
    fits = F.forall(tables, lambda t: F.coalesce((t["analyzed"] < total) & (t["counted_n"] <= t["analyzed"]), F.lit(False)))
    alone = F.size(F.array_distinct(F.transform(tables, lambda t: F.struct(t["analyzed"], t["counts"], t["population"])))) == F.size(tables)
    return F.coalesce((F.size(tables) > 1) & fits & (_total(tables, lambda t: t["analyzed"]) == total) & alone, F.lit(False))


def gathered(tables: DataFrame, by: str, posted: Column | None = None, **more: Column) -> DataFrame:
    """(by, tables, more): a trial's tables (those that are posted) in one array, by position, and further aggregates of them."""
    one = F.struct("position", *[c for c in tables.columns if c not in (by, "position")])
    return tables.groupBy(by).agg(F.sort_array(F.collect_list(one if posted is None else F.when(posted, one))).alias("tables"), *[c.alias(name) for name, c in more.items()])


def chosen(trials: DataFrame, total: str, allow_parts: Column | None = None) -> DataFrame:
    """trials: tables as from gathered(), total. Adds n_tables, counted (the tables that count), partitioned and by_description, as told in select_counted()."""
    size, may = F.col(total), F.lit(True) if allow_parts is None else F.coalesce(allow_parts, F.lit(False))
    told = lambda t: t["specific_n"] > 0
    whole = lambda t: told(t) & F.coalesce(t["analyzed"] >= size, F.lit(True))
    # a trial with one table, as many have, is asked none of this
    x = trials.withColumn("n_tables", F.size("tables").cast("bigint"))
    several = F.col("n_tables") > 1
    x = x.withColumn("_told", F.when(several, F.filter("tables", told)).otherwise(F.col("tables")))
    x = x.withColumns({"_k": F.size("_told"), "_whole": F.when(several, F.filter("_told", whole)).otherwise(F.col("tables")), "_parts": several & may & _are_parts(F.col("tables"), size)})
    every, some = ~several | F.col("_parts") | (F.col("_k") == 0), (F.col("_k") == 1) | size.isNull() | (F.size("_whole") == 0)
    parts = several & (F.col("_parts") | ((F.col("_k") > 1) & size.isNotNull() & (F.size("_whole") == 0) & may & _are_parts(F.col("_told"), size)))
    x = x.withColumns({"_pool": F.when(every, F.col("tables")).when(some, F.col("_told")).otherwise(F.col("_whole")), "partitioned": parts})
    # the last of structs that end in the negative place: of equal ones the first
    top = F.array_max(F.transform("_pool", lambda t, i: F.struct(t["specific_n"].alias("s"), t["counted_n"].alias("c"), (-i).alias("i"), t["counts"].alias("counts"))))
    x = x.withColumn("_top", F.when(~F.col("partitioned") & (F.size("_pool") > 1), top))
    twins = F.filter("_pool", lambda t: (t["specific_n"] == F.col("_top.s")) & (t["counted_n"] == F.col("_top.c")) & (t["counts"] == F.col("_top.counts")))
    best = F.array_max(F.transform(twins, lambda t, i: F.struct(t["detailed_n"].alias("d"), (-i).alias("i"), t.alias("t"))))["t"]
    x = x.withColumn("counted", F.when(F.col("_parts"), F.col("tables")).when(F.col("partitioned"), F.col("_told")).when(F.col("_top").isNotNull(), F.array(best)).otherwise(F.col("_pool")))
    alike = F.size(F.array_distinct(F.transform("counted", lambda t: F.struct(t["analyzed"], t["counts"])))) < F.size("counted")
    return x.withColumn("by_description", F.col("partitioned") & alike).drop("_told", "_k", "_whole", "_parts", "_pool", "_top")


def select_counted(tables: DataFrame, by: str, total: str, allow_parts: Column | None = None) -> DataFrame:
    """Adds counted, partitioned (the counted ones are disjoint parts) and by_description (two parts differ by their description only).
    allow_parts: whether a trial's tables may be read as parts, on each of them.

    All tables that are proven parts of the population count. Else those that place people in specific categories are looked at: the only
    one; the fullest of those on the whole population; all if they are parts; the fullest. Fullest: most people in specific categories,
    then most counted, then first; of those that post the same counts, the one with most people in subcategories."""
    may = F.lit(True) if allow_parts is None else allow_parts
    trials = chosen(gathered(tables, by, _size=F.max(total), _may=F.every(may)), "_size", F.col("_may"))
    counts = lambda t: F.exists("counted", lambda c: c["position"].eqNullSafe(t["position"]))
    flagged = F.transform("tables", lambda t: F.struct(t.alias("_t"), counts(t).alias("_c")))
    out = trials.select(by, "partitioned", "by_description", F.inline(flagged))
    return out.select(*[c if c == by else f"_t.{c}" for c in tables.columns], F.col("_c").alias("counted"), "partitioned", "by_description")


def counted_block(selected: DataFrame, trials: DataFrame, by: str, total: str, name: str, categories: list[str]) -> DataFrame:
    """block_of() each of trials (by, total), whose tables, if any, are the rows of selected."""
    read = [c for c in ("rows", *_READ) if c in selected.columns]
    per = selected.groupBy(by).agg(F.count("*").alias("n_tables"), F.collect_list(F.when(F.col("counted"), F.struct(*read))).alias("counted"), *[F.bool_or(c).alias(c) for c in ("partitioned", "by_description")])
    return block_of(trials.select(by, total).join(per, by, "left"), by, total, name, categories)


def block_of(trials: DataFrame, by: str, total: str, name: str, categories: list[str]) -> DataFrame:
    """One row for each of trials (by, total, n_tables, counted: its tables that count, partitioned, by_description): what its counted tables say.
    categories: those of posted_tables(), in their order, if it was given any.

    totals (all categories, 0 where nobody is), subtotals ('category_subcategory'), n_apart (people in counted tables' rows of other dimensions) and,
    where tables hold their rows, kept_apart (those rows),
    unknown_explicit (posted), unknown_elsewhere (the shortfall to total, where the rows kept apart add up to exactly it and none negates),
    unknown_inferred (a shortfall with no row behind it), flags (sorted; name says what the tables are of). totals holds the shortfall as
    unknown. Tables of zeros only are not reported, and a trial without tables has no rows."""
    held = trials.schema["counted"].dataType
    kinds = {f.name: f.dataType for f in held.elementType.fields}
    zero, no, no_fine = F.lit(0).cast("bigint"), F.array().cast("array<string>"), F.array().cast("array<struct<name: string, n: bigint>>")
    one, n = F.get("counted", F.lit(0)), F.size("counted")
    of = lambda read: F.when(n == 1, read(one)).otherwise(_total(F.col("counted"), read))
    every = lambda c, none: F.flatten(F.col(f"counted.{c}")) if c in kinds else none
    summed = kinds["counts"].elementType.typeName() == "long"  # a number for each category
    each = {f"_in{k}": of(lambda t, k=k: F.get(t["counts"], F.lit(k))) for k in range(len(categories))} if summed else {"_counts": every("counts", None)}
    kept = {"kept_apart": F.filter(every("rows", None), lambda r: r["category"].isNull())} if "rows" in kinds else {}
    b = trials.withColumn("counted", F.coalesce("counted", F.array().cast(held))).select(
        by, F.col(total).cast("bigint").alias(total), F.coalesce("n_tables", zero).alias("n_tables"), n.cast("bigint").alias("n_counted"), "partitioned", "by_description",
        *[of(lambda t, c=c: t[c]).alias(name) for name, c in (("n_posted", "counted_n"), ("n_apart", "apart_n"), ("_denied", "denied_n"))],
        every("fine", no_fine).alias("_fine"), every("said", no).alias("_said"), *[c.alias(name) for name, c in (each | kept).items()],
    )
    b = b.withColumn("reported", F.col("n_posted") > 0)
    reported = F.col("reported")
    short = F.when(reported, F.greatest(F.col(total) - F.col("n_posted"), F.lit(0)))
    b = b.withColumns({"_short": F.coalesce(short, F.lit(0)).cast("bigint"), "_fine": F.when(reported, F.col("_fine")).otherwise(no_fine)})
    b = b.withColumn("_elsewhere", (F.col("_short") > 0) & (F.col("n_apart") == F.col("_short")) & (F.col("_denied") == 0))
    elsewhere = F.col("_elsewhere")
    if not summed:
        b = b.withColumn("_in", F.map_from_entries(_summed(F.col("_counts"), "category")))
        b = b.withColumns({f"_in{k}": F.coalesce(F.try_element_at("_in", F.lit(c)), zero) for k, c in enumerate(categories)})
    posted = {c: F.when(reported, F.col(f"_in{k}")).otherwise(zero) for k, c in enumerate(categories)}
    totals = F.map_from_arrays(F.array(*map(F.lit, categories)), F.array(*[posted[c] + F.col("_short") if c == UNKNOWN else posted[c] for c in categories]))
    flag = lambda cond, text: F.when(cond, F.lit(text) if isinstance(text, str) else text)
    stated = F.array_compact(F.array(
        flag(F.col("n_counted") < F.col("n_tables"), f"{name}_table_superseded"), flag(F.col("partitioned"), f"{name}_tables_partitioned"), flag(F.col("by_description"), f"{name}_tables_partitioned_by_description"),
        flag(F.col("n_tables") > 1, F.concat(F.lit(f"multiple_{name}_tables_"), F.col("n_tables").cast("string"))), flag(F.col("_short") > 0, "denominator_balanced"), flag(elsewhere, "shortfall_is_other_rows"),
    ))
    rejected = F.when(F.col("n_tables") > 0, F.array(F.lit("all_zero_rejection"))).otherwise(no)
    flags = F.when(reported, F.concat(stated, F.col("_said"))).otherwise(rejected)
    apart = F.when(F.col("n_apart") > 0, F.array(F.lit("other_rows_skipped"))).otherwise(no)
    return b.select(
        by, total, "reported", "n_posted", "n_tables", "n_counted", totals.alias("totals"), F.map_from_entries(_summed(F.col("_fine"), "name")).alias("subtotals"), "n_apart", *kept,
        posted.get(UNKNOWN, zero).alias("unknown_explicit"), F.when(elsewhere, F.col("_short")).otherwise(zero).alias("unknown_elsewhere"), F.when(elsewhere, zero).otherwise(F.col("_short")).alias("unknown_inferred"),
        F.sort_array(F.array_distinct(F.concat(flags, apart))).alias("flags"),
    )
