"""Sponsors to companies: rules decide literals, literals make the bridge, the bridge is counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import sponsor_key, subsidiary
from ..functions.numbers import bound
from ..sources.folders import kept

RULE_TYPES = {"exact_literal": "name", "exact_normalized": "norm", "subsidiary_of": "parent_norm"}


def rule_problems(rules: DataFrame) -> DataFrame:
    """Rows that break the rule table's contract, each with what is wrong: closed vocabularies, notes, repeated keys, and chains (a
    rule that leads to a company which another rule of its kind leads on to a third)."""
    checks = {
        "unknown_rule_type": ~F.col("rule_type").isin(*RULE_TYPES), "unknown_status": ~F.col("status").isin("attribute", "exclude"),
        "unknown_shared": ~F.col("shared").isin("yes", "no"), "empty_note": F.trim(F.coalesce("note", F.lit(""))) == "",
        "repeated_key": F.col("n_same") > 1, "leads_to_another_rule": F.col("onward").isNotNull(),
    }
    same = rules.groupBy("canonical", "rule_type", "pattern").agg(F.count("*").alias("n_same"))
    onward = rules.groupBy(F.col("rule_type").alias("t"), F.col("pattern").alias("key")).agg(F.min("canonical").alias("onward"))
    key = sponsor_key(F.col("canonical"))
    seen = rules.join(same, ["canonical", "rule_type", "pattern"]).withColumn("key", key)
    seen = seen.join(onward, (F.col("t") == F.col("rule_type")) & (onward["key"] == seen["key"]) & (F.col("onward") != F.col("canonical")), "left")
    found = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(k not in ("repeated_key", "leads_to_another_rule"))), F.lit(k)) for k, c in checks.items()]))
    return seen.select(*[rules[c] for c in rules.columns], F.explode(found).alias("problem"))


def literals(sponsors: DataFrame) -> DataFrame:
    """Distinct names with the forms that rules match on."""
    entity, parent = subsidiary(F.col("name"))
    return sponsors.filter("name is not null").select("name").distinct().select("name", sponsor_key(F.col("name")).alias("norm"), parent.alias("parent_norm"), entity.alias("entity"))


def rule_hits(names: DataFrame, rules: DataFrame) -> DataFrame:
    """(name, entity, canonical, rule_type, shared, status): one equi-join for each kind of rule."""
    hits = [names.join(rules.filter(F.col("rule_type") == kind), F.col(form) == F.col("pattern")) for kind, form in RULE_TYPES.items()]
    out = hits[0]
    for h in hits[1:]:
        out = out.unionByName(h)
    return out.select("name", "entity", "canonical", "rule_type", "shared", "status")


def claims(hits: DataFrame) -> DataFrame:
    """One attributing rule per (name, canonical): the first kind that reached it."""
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(RULE_TYPES) for x in (k, i)])[F.col("rule_type")]
    best = Window.partitionBy("name", "canonical").orderBy(rank, "shared")
    first = hits.filter("status = 'attribute'").withColumn("nth", F.row_number().over(best)).filter("nth = 1")
    return first.select("name", "entity", "canonical", F.col("rule_type").alias("match_rule"), "shared")


def conflicts(hits: DataFrame) -> DataFrame:
    """(name, n_companies, is_excluded): literals that go to several companies by rules that are not all shared, or that are both attributed and excluded."""
    attributed = claims(hits).groupBy("name").agg(F.count("*").alias("n_companies"), F.every(F.col("shared") == "yes").alias("all_shared"))
    excluded = hits.filter("status = 'exclude'").select("name").distinct().withColumn("is_excluded", F.lit(True))
    both = attributed.join(excluded, "name", "left").withColumn("is_excluded", F.coalesce("is_excluded", F.lit(False)))
    return both.filter("(n_companies > 1 and not all_shared) or is_excluded").select("name", "n_companies", "is_excluded")


def matched(names: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per (name, canonical): the first kind of rule that reached it. Conflicting rules are refused."""
    hits = kept(rule_hits(names, rules), "rule-hits")
    if bad := conflicts(hits).limit(3).collect():
        raise ValueError(f"conflicting rules for {[r['name'] for r in bad]}: mark every claiming rule shared, or remove one")
    return claims(hits)


def bridge(sponsors: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per trial, company, entity and role; of several literals the least stays. Written once."""
    found = sponsors.join(matched(kept(literals(sponsors), "literals"), rules), "name")
    # rows meet by trial before they are sorted, once: few fall to one group, so that sorting them before the shuffle too would gain nothing
    found = found.repartition("nct_id").groupBy("nct_id", "canonical", "entity", "role").agg(F.min(F.struct("name", "agency_class", "match_rule", "shared")).alias("x"))
    return kept(found.select("nct_id", "canonical", "entity", "role", F.col("x.name").alias("literal_name"), "x.agency_class", "x.match_rule", "x.shared"), "bridge")


def company_trials(index: DataFrame, who: Column) -> DataFrame:
    """One row per trial of a company or entity: its roles, and whether it leads or collaborates."""
    roles = F.array_join(F.array_sort(F.collect_set("role")), ",")
    return index.filter(who).groupBy("nct_id").agg(roles.alias("roles"), F.bool_or(F.col("role") == "lead").alias("is_lead"), F.bool_or(F.col("role") == "collaborator").alias("is_collaborator"))


def entity_counts(index: DataFrame, by: str = "entity") -> DataFrame:
    """Distinct trials in any role, as lead, as collaborator. Counts over companies do not add up: partnerships count for each."""
    role = lambda r: F.count_distinct(F.when(F.col("role") == r, F.col("nct_id")))
    return index.groupBy("canonical", *([by] if by != "canonical" else [])).agg(F.count_distinct("nct_id").alias("n_trials"), role("lead").alias("n_lead"), role("collaborator").alias("n_collab"))


def company_flags(index: DataFrame, companies: list[str]) -> DataFrame:
    """One row per trial of any company, with a flag for each company and scope; absence is false."""
    flags = []
    for c in companies:
        ours = F.col("canonical") == c
        slug = "".join(ch if ch.isalnum() else "_" for ch in c.lower()).strip("_")
        for scope, cond in (("any", ours), ("lead", ours & (F.col("role") == "lead")), ("collab", ours & (F.col("role") == "collaborator"))):
            flags.append(F.bool_or(cond).alias(f"{slug}_{scope}"))
    return index.filter(F.col("canonical").isin(companies)).groupBy("nct_id").agg(*flags)


def literal_states(names: DataFrame, rules: DataFrame) -> DataFrame:
    """Every literal is attributed, reviewed_excluded or unreviewed."""
    hits = rule_hits(names, rules).groupBy("name").agg(F.bool_or(F.col("status") == "attribute").alias("a"))
    return names.select("name").join(hits, "name", "left").select("name", F.when(F.col("a"), "attributed").when(F.col("a").isNotNull(), "reviewed_excluded").otherwise("unreviewed").alias("state"))


def uncovered_rules(names: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules that reach no literal."""
    forms = names.select(F.explode(F.array(*[F.struct(F.lit(k).alias("rule_type"), F.col(f).alias("pattern")) for k, f in RULE_TYPES.items()])).alias("x")).select("x.*").filter("pattern is not null").distinct()
    return rules.join(forms, ["rule_type", "pattern"], "left_anti")


def pairs(index: DataFrame) -> DataFrame:
    """(nct_id, canonical, role) with the least literal that stands behind it."""
    return index.groupBy("nct_id", "canonical", "role").agg(F.min("literal_name").alias("literal"))


def concordance(left: DataFrame, right: DataFrame, left_trials: DataFrame, right_trials: DataFrame) -> DataFrame:
    """Pairs of two indexes on the trials that both sides hold (nct_id): agree, left_only or right_only, the latter two with a cause:
    the other side lacks the literal in that trial, has it in another role, or gives it to another company."""
    trials = left_trials.select("nct_id", F.lit(1).alias("side")).unionByName(right_trials.select("nct_id", F.lit(2).alias("side")))
    shared = trials.groupBy("nct_id").agg(F.bit_or("side").alias("sides")).filter("sides = 3").select("nct_id")
    # both indexes meet in one shuffle by trial; a trial's rows of either side stand in arrays, sorted, so that the first of a pair has its least literal
    rows = lambda x, side: x.select("nct_id", F.lit(side).alias("side"), F.struct("canonical", "role", F.col("literal_name").alias("literal")).alias("x"))
    of_side = lambda side: F.sort_array(F.collect_list(F.when(F.col("side") == side, F.col("x"))))
    per = rows(left, 1).unionByName(rows(right, 2)).repartition("nct_id").groupBy("nct_id").agg(of_side(1).alias("left"), of_side(2).alias("right")).join(shared, "nct_id", "left_semi")

    def firsts(side: str) -> Column:
        before = lambda i: F.get(F.col(side), i - 1)
        return F.filter(side, lambda x, i: (i == 0) | ~(x["canonical"].eqNullSafe(before(i)["canonical"]) & x["role"].eqNullSafe(before(i)["role"])))

    per = per.withColumns({"left_pairs": firsts("left"), "right_pairs": firsts("right")})
    held = lambda side, cond: F.coalesce(F.exists(side, cond), F.lit(False))
    agrees = lambda x, side: held(f"{side}_pairs", lambda o: (o["canonical"] == x["canonical"]) & (o["role"] == x["role"]))

    def judged(x: Column, there: str, state: Column) -> Column:
        literal = lambda o: o["literal"] == x["literal"]
        cause = F.when(~held(there, literal), "literal_absent").when(held(there, lambda o: literal(o) & (o["role"] == x["role"])), "canonical_differs").otherwise("role_differs")
        return bound(state, lambda s: F.struct(x["canonical"].alias("canonical"), x["role"].alias("role"), s.alias("state"), F.when(s != "agree", cause).alias("cause")))

    ours = F.transform("left_pairs", lambda x: judged(x, "right", F.when(agrees(x, "right"), "agree").otherwise("left_only")))
    theirs = F.transform(F.filter("right_pairs", lambda x: ~agrees(x, "left")), lambda x: judged(x, "left", F.lit("right_only")))
    return per.select("nct_id", F.inline(F.concat(ours, theirs)))


def company_lists(found: DataFrame) -> DataFrame:
    """(name, canonicals) of matched literals: their companies in order, joined."""
    return found.groupBy("name").agg(F.array_join(F.array_sort(F.collect_set("canonical")), "|").alias("canonicals"))


def match_changes(before: DataFrame, now: DataFrame, names_before: DataFrame, names_now: DataFrame, rules_changed: bool | None) -> DataFrame:
    """Literals whose companies differ from the week before, with the cause: before and now as from matched(), and all literals of both weeks."""
    a, b = company_lists(before).withColumnRenamed("canonicals", "before"), company_lists(now).withColumnRenamed("canonicals", "after")
    both = a.join(b, "name", "full").filter(~F.col("before").eqNullSafe(F.col("after")))
    change = F.when(F.col("after").isNull(), "dropped_match").when(F.col("before").isNull(), "new_match").otherwise("canonicals_changed")
    for side, names in (("was", names_before), ("is", names_now)):
        both = both.join(names.select("name").distinct().withColumn(side, F.lit(True)), "name", "left")
    moved, rules = ~F.col("was").eqNullSafe(F.col("is")), F.lit(rules_changed)
    cause = F.when(rules.isNull(), "unknown_no_prior").when(moved & rules, "both").when(moved, "registry_edit").when(rules, "rules_change").otherwise("unknown")
    return both.select(F.col("name").alias("literal_name"), change.alias("change"), cause.alias("cause"), "before", "after")


def pair_changes(before: DataFrame, now: DataFrame, sponsors_before: DataFrame, sponsors_now: DataFrame, rules_changed: bool) -> DataFrame:
    """(nct_id, canonical, role) added to or removed from the bridge, each with its literal and cause: a registry edit where the other
    week's trial lacks the literal in that role, else a change of rules if there was one."""

    key = ["nct_id", "canonical", "role"]
    both = pairs(before).withColumnRenamed("literal", "was").join(pairs(now).withColumnRenamed("literal", "is"), key, "full")
    # both weeks meet once; what differs is written, so that Spark knows how little it is
    changed = kept(both.filter("was is null or is is null"), "pair-changes")

    def one_way(here: str, there: str, sponsors_there: DataFrame, change: str) -> DataFrame:
        only = changed.filter(F.col(there).isNull()).select(*key, F.col(here).alias("literal"))
        had = sponsors_there.select("nct_id", "role", F.col("name").alias("literal")).distinct().withColumn("had", F.lit(True))
        cause = F.when(F.col("had").isNull(), "registry_edit").when(F.lit(rules_changed), "rules_change").otherwise("unknown")
        return only.join(had, ["nct_id", "role", "literal"], "left").select(*key, F.lit(change).alias("change"), "literal", cause.alias("cause"))

    return one_way("is", "was", sponsors_before, "added").unionByName(one_way("was", "is", sponsors_now, "removed"))


def curation_batch(sponsors: DataFrame, unreviewed: DataFrame, industry: Column, top: int = 100) -> DataFrame:
    """The unreviewed literals that lead most trials of the class, ranked, each with the rule line that a curator would complete. A report of the first `top`."""
    leads = sponsors.filter((F.col("role") == "lead") & industry).join(unreviewed.select("name"), "name", "left_semi").groupBy("name").agg(F.count_distinct("nct_id").alias("n_lead_trials"))
    best = leads.orderBy(F.desc("n_lead_trials"), "name").limit(top)
    every = sponsors.join(F.broadcast(best.select("name")), "name").groupBy("name").agg(F.count_distinct("nct_id").alias("n_any_trials"), F.array_join(F.array_sort(F.collect_set("role")), ",").alias("roles"))
    entity, parent = subsidiary(F.col("name"))
    line = F.concat(F.lit('<canonical>,exact_normalized,"'), F.col("normalized_pattern"), F.lit('",attribute,no,"<initials> <date>: <why>"'))
    ranked = best.join(every, "name").withColumns({"rank": F.row_number().over(Window.orderBy(F.desc("n_lead_trials"), "name")), "normalized_pattern": sponsor_key(F.col("name")), "parsed_parent": F.coalesce(parent, F.lit(""))})
    return ranked.select("rank", "name", "n_lead_trials", "n_any_trials", "roles", "normalized_pattern", "parsed_parent", line.alias("draft_rule_line"))


def with_acquisitions(index: DataFrame, acquisitions: DataFrame) -> DataFrame:
    """The bridge with effective dates by (entity, canonical); acquisitions: entity, canonical, effective_date, source. Refused while every
    date is blank, or if a dated row names no source."""
    c = acquisitions.agg(F.count("effective_date").alias("dated"), F.count_if(F.col("effective_date").isNotNull() & (F.trim(F.coalesce("source", F.lit(""))) == "")).alias("unsourced")).first()
    if not c["dated"]:
        raise ValueError("every effective_date is blank")
    if c["unsourced"]:
        raise ValueError(f"{c['unsourced']} dated rows have no source")
    dates = acquisitions.select(sponsor_key(F.col("entity")).alias("entity"), "canonical", "effective_date").distinct()
    return index.join(dates, ["entity", "canonical"], "left")
