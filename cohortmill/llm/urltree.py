"""URL filters: rules first, then a tree of path templates for each host. Spark's own functions only.

A path's segments are typed (a number, a hexadecimal name, mixed with digits, a slug, a word). At each node of a host's tree,
which is a depth under segments of given types, a word stays as it is if at least 1/LITERALS of the node's pages have it, so
a node has LITERALS branches at most; every other segment is variable and becomes a wildcard. Branches whose labelled pages
are rejected at rates that do not differ significantly are merged, in order of their rates; branches without labels are
merged with one another and never with labelled ones. A template is rejected where its smoothed share of rejected labels,
(rejected + 1) / (labelled + 2), reaches PURITY: what nobody labelled is allowed, whatever lies beside it. Pages that
rules judge are the labelled ones.

A null url, and one without `://`, has an empty host and path. Repeated rows and null ids stay. Rules of equal length go by
host and path. Of words equally frequent at a node all stay or none. Paths of any length are whole. An empty table gives no
rows. Columns other than page_id and url are ignored. Joins with hosts' nodes and templates read written tables, so that
Spark splits the keys of hot hosts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

LITERALS, PURITY, SIGNIFICANT = 64, 0.8, 3.84
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
Rule = tuple[str, str, str]  # host, path, verdict


def located(url: Column) -> tuple[Column, Column]:
    """Host and path of an address."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.translate(host, UPPER, SMALL), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, like `net/`, and its verdict. A rule fits its host and all hosts below it."""
    rule = verdict = None
    for at, start, says in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0], r[1])):
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(start)
        rule = F.when(fits, F.lit(at + start)) if rule is None else rule.when(fits, F.lit(at + start))
        verdict = F.when(fits, F.lit(says)) if verdict is None else verdict.when(fits, F.lit(says))
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def kind(segment: Column) -> Column:
    """A segment's type; an ending like .html does not count."""
    name = F.regexp_replace(segment, r"\.[A-Za-z]{2,5}$", "")
    return (
        F.when(name.rlike(r"^[0-9][0-9_.-]*$"), F.lit("number"))
        .when(name.rlike(r"^[0-9a-fA-F-]{8,}$"), F.lit("hex"))
        .when(name.rlike(r"[0-9]"), F.lit("mixed"))
        .when(name.rlike(r"[^-_]+[-_][^-_]+[-_][^-_]+[-_]"), F.lit("slug"))
        .otherwise(F.lit("word"))
    )


def judged(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, host, path, rule, says."""
    host, path = located(F.col("url"))
    at = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, says = longest_rule(F.col("host"), F.col("path"), rules)
    return at.select("*", rule.alias("rule"), says.alias("says"))


def steps(addresses: DataFrame) -> DataFrame:
    """A row for each segment of a path: depth, segment, and its node: the types of the segments up to it. A path without segments has none."""
    names = F.filter(F.split("path", "/"), lambda x: x != "")
    return (
        addresses.select("*", names.alias("names"))
        .select("*", F.transform("names", kind).alias("kinds"))
        .select("*", F.posexplode("names").alias("depth", "segment"))
        .select("*", F.array_join(F.slice("kinds", F.lit(1), F.col("depth") + 1), "/").alias("node"), F.element_at("kinds", F.col("depth") + 1).alias("kind"))
        .drop("names", "kinds")
    )


def branches(addresses: DataFrame) -> DataFrame:
    """host, node, branches: which words stay at a node, and the branch that each belongs to."""
    counts = ["n", "labelled", "rejected"]
    words = steps(addresses).filter("kind = 'word'").groupBy("host", "node", "segment").agg(*[F.sum(c).alias(c) for c in counts])
    words = stored(words, "segments")
    totals = words.groupBy("host", "node").agg(F.sum("n").alias("total"))
    # A word with its share of the pages is among the first LITERALS, so no node's rows are gathered beyond those.
    place = F.row_number().over(Window.partitionBy("host", "node").orderBy(F.desc("n"), "segment"))
    kept = words.withColumn("place", place).filter(F.col("place") <= LITERALS).join(totals, ["host", "node"]).filter(F.col("n") * LITERALS >= F.col("total"))
    rate = F.try_divide(F.col("rejected"), F.col("labelled"))
    by_rate = Window.partitionBy("host", "node").orderBy(rate, "segment")
    before = lambda c: F.lag(c).over(by_rate)
    both = F.try_divide(F.col("rejected") + F.col("r0"), F.col("labelled") + F.col("l0"))
    gap = F.pow(F.col("rate") - F.try_divide(F.col("r0"), F.col("l0")), F.lit(2))
    differs = gap >= SIGNIFICANT * both * (1 - both) * (F.try_divide(F.lit(1), F.col("labelled")) + F.try_divide(F.lit(1), F.col("l0")))
    apart = F.when(F.col("l0").isNull(), True).when((F.col("labelled") == 0) & (F.col("l0") == 0), False).when((F.col("labelled") == 0) | (F.col("l0") == 0), True).otherwise(differs & (both > 0) & (both < 1))
    kept = kept.select("*", rate.alias("rate"), before("labelled").alias("l0"), before("rejected").alias("r0"))
    kept = kept.withColumn("group", F.sum(apart.cast("int")).over(Window.partitionBy("host", "node").orderBy("rate", "segment").rowsBetween(Window.unboundedPreceding, 0)))
    named = kept.groupBy("host", "node", "group").agg(F.array_sort(F.collect_list("segment")).alias("words"))
    return named.groupBy("host", "node").agg(F.collect_list("words").alias("branches"))


def templates(addresses: DataFrame) -> DataFrame:
    """Adds `template` to written addresses: variable segments as *, merged branches as a|b."""
    tree = stored(branches(addresses), "tree")
    each = steps(addresses).select("host", "path", "depth", "segment", "node").join(tree, ["host", "node"], "left")
    mine = F.get(F.filter("branches", lambda b: F.array_contains(b, F.col("segment"))), F.lit(0))
    each = each.select("host", "path", F.struct("depth", F.coalesce(F.array_join(mine, "|"), F.lit("*")).alias("name")).alias("step"))
    made = each.groupBy("host", "path").agg(F.array_sort(F.collect_list("step")).alias("steps"))
    made = made.select("host", "path", F.concat(F.lit("/"), F.array_join(F.col("steps.name"), "/")).alias("template"))
    return addresses.join(made, ["host", "path"], "left").withColumn("template", F.coalesce("template", F.lit("/")))


def template_tree(addresses: DataFrame, purity: float = PURITY) -> DataFrame:
    """host, template, n, labelled, rejected, purity, verdict of addresses with templates."""
    made = addresses.groupBy("host", "template").agg(*[F.sum(c).alias(c) for c in ("n", "labelled", "rejected")])
    share = (F.col("rejected") + 1) / (F.col("labelled") + 2)
    return made.select("*", share.alias("purity"), F.when(share >= purity, F.lit("block")).otherwise(F.lit("allow")).alias("verdict"))


def verdicts(pages: DataFrame, rules: list[Rule], purity: float = PURITY) -> DataFrame:
    """page_id, host, path, rule, verdict, template of every page; the template is null where a rule judges."""
    rows = stored(judged(pages, rules), "judged")
    count = lambda c: F.count(F.when(c, True))
    addresses = rows.groupBy("host", "path").agg(F.count("*").alias("n"), count(F.col("says").isNotNull()).alias("labelled"), count(F.col("says") == "block").alias("rejected"))
    addresses = stored(templates(stored(addresses, "addresses")), "templates")
    found = stored(template_tree(addresses, purity).select("host", "template", "verdict"), "verdicts")
    # An address has a rule or has none, so only those without one need their template's verdict.
    open_ones = addresses.filter("labelled = 0").select("host", "path", "template").join(found, ["host", "template"])
    open_ones = stored(open_ones, "open")
    left = rows.filter("rule is null").join(open_ones, ["host", "path"]).select("page_id", "host", "path", "rule", "verdict", "template")
    return rows.filter("rule is not null").select("page_id", "host", "path", "rule", F.col("says").alias("verdict"), F.lit(None).cast("string").alias("template")).unionByName(left)
