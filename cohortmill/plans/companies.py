"""Queries over sponsors and their companies."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.names import sponsor_key, subsidiary
from ..operators import sponsors as S
from ..sources.folders import kept
from .bindings import SPONSORS, sponsors, table
from .registry import query


def rules(spark, sf_dir, below=30, renamed=False):
    """A rule table that Spark derives from the literals: even holdings are exact, odd ones normalised, those below `below` claimed by
    subsidiaries too; some are reviewed and excluded. renamed: seventies go to another company."""
    k = table(spark, sf_dir, "customer").select(F.right("c_name", F.lit(2)).alias("k")).distinct()
    n = F.col("k").cast("int")
    company = F.when(F.lit(renamed) & n.between(70, 79), "Group 8").otherwise(F.concat(F.lit("Group "), F.left("k", F.lit(1))))
    key = F.concat(F.lit("holding "), "k")
    rule = lambda when, kind, pattern, status: F.when(when, F.struct(company.alias("canonical"), F.lit(kind).alias("rule_type"), pattern.alias("pattern"), F.lit(status).alias("status")))
    each = [
        rule(n < 80, "exact_normalized", key, "attribute"), rule(n < below, "subsidiary_of", key, "attribute"),
        rule((n < 80) & (n % 2 == 0), "exact_literal", F.concat(F.lit("Holding "), "k", F.lit(", Inc.")), "attribute"), rule(n.between(80, 89), "exact_normalized", key, "exclude"),
    ]
    return k.select(F.inline(F.array_compact(F.array(*each)))).withColumns({"shared": F.lit("no"), "note": F.lit("derived")})


def _bridge_sql(x, sponsors_table, below, company):
    """The same by formula: lits, named, matched and bridge, their names ending in x."""
    return f"""lits{x} AS (SELECT DISTINCT name, name LIKE 'Unit%' AS is_unit, CASE WHEN name LIKE 'Unit%' THEN 'unit ' || substr(name, 6, 3) ELSE 'holding ' || substr(name, 9, 2) END AS entity,
  CASE WHEN name LIKE 'Unit%' THEN substr(name, length(name) - 7, 2) ELSE substr(name, 9, 2) END AS k FROM {sponsors_table}),
  named{x} AS (SELECT l.*, known.k IS NOT NULL AS has_rule, {company} AS canonical, CAST(l.k AS INT) AS n,
    CASE WHEN known.k IS NULL THEN NULL WHEN is_unit AND CAST(l.k AS INT) < {below} THEN 'subsidiary_of' WHEN is_unit THEN NULL WHEN CAST(l.k AS INT) % 2 = 0 AND name LIKE 'Holding%' AND CAST(l.k AS INT) < 80 THEN 'exact_literal' WHEN CAST(l.k AS INT) < 80 THEN 'exact_normalized' END AS match_rule
    FROM lits{x} l LEFT JOIN known ON l.k = known.k),
  matched{x} AS (SELECT name, entity, canonical, match_rule FROM named{x} WHERE match_rule IS NOT NULL),
  bridge{x} AS (SELECT nct_id, canonical, entity, role, min(name) AS literal_name FROM {sponsors_table} JOIN matched{x} USING (name) GROUP BY 1, 2, 3, 4)"""


KEYED = f"WITH {SPONSORS}, known AS (SELECT DISTINCT right(c_name, 2) AS k FROM customer), " + _bridge_sql("", "sponsors", 30, "'Group ' || left(l.k, 1)")
#: The week before: a fifth of the trials lack their collaborators, a ninth have one more, fewer subsidiaries have rules, and the seventies went elsewhere.
PRIOR = KEYED + """, sponsors_p AS (SELECT * FROM sponsors WHERE NOT (role = 'collaborator' AND CAST(substr(nct_id, 4) AS INT) % 5 = 0)
  UNION ALL SELECT nct_id, 'OTHER', 'collaborator', 'HOLDING 05 Co., Ltd.' FROM studies WHERE CAST(substr(nct_id, 4) AS INT) % 9 = 0), """ + _bridge_sql("_p", "sponsors_p", 20, "CASE WHEN CAST(l.k AS INT) BETWEEN 70 AND 79 THEN 'Group 8' ELSE 'Group ' || left(l.k, 1) END")


def bridged(spark, sf_dir):
    return S.bridge(kept(sponsors(spark, sf_dir), "sponsors"), rules(spark, sf_dir))


def both_weeks(spark, sf_dir):
    """The sponsors of this week, written once, and those of the week before, which are read from them: every trial has one lead."""
    now = kept(sponsors(spark, sf_dir), "sponsors")
    number, collaborates = F.substring("nct_id", 4, 8).cast("int"), F.col("role") == "collaborator"
    more = now.filter(~collaborates & (number % 9 == 0)).select("nct_id", F.lit("OTHER").alias("agency_class"), F.lit("collaborator").alias("role"), F.lit("HOLDING 05 Co., Ltd.").alias("name"))
    return now, kept(now.filter(~(collaborates & (number % 5 == 0))).unionByName(more), "prior-sponsors")


def prior_rules(spark, sf_dir):
    return rules(spark, sf_dir, 20, True)


@query("PRJ-24", KEYED + " SELECT name, CASE WHEN is_unit THEN 'unit ' || substr(name, 6, 3) || ' a wholly owned subsidiary of holding ' || k ELSE entity END AS key FROM lits")
def sponsor_keys(spark, sf_dir):
    return sponsors(spark, sf_dir).select("name").distinct().select("name", sponsor_key(F.col("name")).alias("key"))


@query("PRJ-25", KEYED + " SELECT name, entity, CASE WHEN is_unit THEN 'holding ' || k END AS parent FROM lits")
def subsidiaries(spark, sf_dir):
    entity, parent = subsidiary(F.col("name"))
    return sponsors(spark, sf_dir).select("name").distinct().select("name", entity.alias("entity"), parent.alias("parent"))


@query("SRC-6", """WITH k AS (SELECT DISTINCT CAST(right(c_name, 2) AS INT) AS n FROM customer) SELECT 'Group ' || n AS canonical, unnest(list_filter([CASE WHEN n % 10 = 0 THEN 'unknown_rule_type' END, CASE WHEN n % 10 IN (1, 9) THEN 'unknown_status' END,
  CASE WHEN n % 10 = 2 THEN 'unknown_shared' END, CASE WHEN n % 10 IN (3, 9) THEN 'empty_note' END, CASE WHEN n % 10 = 4 THEN 'repeated_key' END, CASE WHEN n % 10 = 5 THEN 'leads_to_another_rule' END], lambda x: x IS NOT NULL)) AS problem FROM (SELECT n FROM k UNION ALL SELECT n FROM k WHERE n % 10 = 4)""")
def rule_violations(spark, sf_dir):
    """A rule table with planted faults by the last digit; a rule whose company another rule renames is a chain."""
    k = table(spark, sf_dir, "customer").select(F.right("c_name", F.lit(2)).cast("int").alias("n")).distinct()
    d, name = F.col("n") % 10, F.concat(F.lit("Group "), F.col("n").cast("string"))
    one = k.select(name.alias("canonical"), F.when(d == 0, "sounds_like").otherwise("exact_normalized").alias("rule_type"), F.concat(F.lit("holding "), F.col("n").cast("string")).alias("pattern"), F.when(d.isin(1, 9), "maybe").otherwise("attribute").alias("status"), F.when(d == 2, "perhaps").otherwise("no").alias("shared"), F.when(d == 3, " ").when(d != 9, "why").alias("note"))
    onward = k.filter(d == 5).select(F.lit("Another").alias("canonical"), F.lit("exact_normalized").alias("rule_type"), F.lower(name).alias("pattern"), F.lit("attribute").alias("status"), F.lit("no").alias("shared"), F.lit("why").alias("note"))
    return S.rule_problems(one.unionByName(one.filter("pattern like '%4'")).unionByName(onward)).select("canonical", "problem")


@query("JN-1-conflicts", KEYED + " SELECT name, CASE WHEN n < 10 AND NOT is_unit THEN 2 ELSE 1 END AS n_companies, n BETWEEN 10 AND 19 AND NOT is_unit AS is_excluded FROM named WHERE match_rule IS NOT NULL AND NOT is_unit AND n < 20")
def rule_conflicts(spark, sf_dir):
    """Planted rules: literals below 10 are claimed for a second company (shared by one rule only), those from 10 to 19 are excluded too."""
    r = rules(spark, sf_dir)
    low = r.filter("rule_type = 'exact_normalized' and substring(pattern, 9, 1) = '0'").withColumns({"canonical": F.lit("Second"), "shared": F.lit("yes")})
    out = r.filter("rule_type = 'exact_normalized' and substring(pattern, 9, 1) = '1'").withColumn("status", F.lit("exclude"))
    return S.conflicts(S.rule_hits(S.literals(sponsors(spark, sf_dir)), r.unionByName(low).unionByName(out)))


@query("JN-1", KEYED + " SELECT name, canonical, match_rule FROM matched")
def matched_literals(spark, sf_dir):
    return S.matched(S.literals(sponsors(spark, sf_dir)), rules(spark, sf_dir)).select("name", "canonical", "match_rule")


@query("JN-2", KEYED + " SELECT * FROM bridge")
def sponsor_bridge(spark, sf_dir):
    return bridged(spark, sf_dir).select("nct_id", "canonical", "entity", "role", "literal_name")


@query("SET-1", KEYED + " SELECT CASE WHEN m.name IS NOT NULL THEN 'attributed' WHEN n BETWEEN 80 AND 89 AND NOT is_unit AND has_rule THEN 'reviewed_excluded' ELSE 'unreviewed' END AS state, count(*) AS n_literals FROM named LEFT JOIN matched m USING (name) GROUP BY 1")
def literal_states(spark, sf_dir):
    return S.literal_states(S.literals(sponsors(spark, sf_dir)), rules(spark, sf_dir)).groupBy("state").agg(F.count("*").alias("n_literals"))


@query("SET-2", KEYED + " SELECT name, CASE WHEN m.canonical = 'Group 1' THEN 'attributed' WHEN m.name IS NOT NULL THEN 'attributed_elsewhere' WHEN n BETWEEN 80 AND 89 AND NOT is_unit AND has_rule THEN 'reviewed_excluded' ELSE 'unreviewed' END AS frame FROM named LEFT JOIN matched m USING (name) WHERE contains(lower(name), 'unit') OR m.canonical = 'Group 1'")
def company_audit(spark, sf_dir):
    names = S.literals(sponsors(spark, sf_dir))
    found = S.literal_states(names, rules(spark, sf_dir)).join(S.matched(names, rules(spark, sf_dir)).select("name", "canonical"), "name", "left")
    ours = F.coalesce(F.col("canonical") == "Group 1", F.lit(False))
    return found.filter(F.lower("name").contains("unit") | ours).select("name", F.when(ours, "attributed").when(F.col("state") == "attributed", "attributed_elsewhere").otherwise(F.col("state")).alias("frame"))


@query("SET-5", KEYED + ", r AS (SELECT DISTINCT right(lead, 2) AS k FROM studies WHERE CAST(right(lead, 2) AS INT) < 30) SELECT 'holding ' || k AS pattern FROM r WHERE k NOT IN (SELECT k FROM lits WHERE is_unit)")
def uncovered(spark, sf_dir):
    return S.uncovered_rules(S.literals(sponsors(spark, sf_dir)), rules(spark, sf_dir)).select("pattern")


@query("JN-8", PRIOR + """, sh AS (SELECT nct_id FROM sponsors INTERSECT SELECT nct_id FROM sponsors_p), a AS (SELECT nct_id, canonical, role, min(literal_name) AS lit FROM bridge WHERE nct_id IN (SELECT nct_id FROM sh) GROUP BY 1, 2, 3), b AS (SELECT nct_id, canonical, role, min(literal_name) AS lit FROM bridge_p WHERE nct_id IN (SELECT nct_id FROM sh) GROUP BY 1, 2, 3),
  j AS (SELECT coalesce(a.nct_id, b.nct_id) AS nct_id, coalesce(a.canonical, b.canonical) AS canonical, coalesce(a.role, b.role) AS role, CASE WHEN a.nct_id IS NULL THEN 'right_only' WHEN b.nct_id IS NULL THEN 'left_only' ELSE 'agree' END AS state, coalesce(a.lit, b.lit) AS lit FROM a FULL JOIN b ON a.nct_id = b.nct_id AND a.canonical = b.canonical AND a.role = b.role),
  o AS (SELECT 'right_only' AS state, nct_id, literal_name AS lit, list(role) AS roles FROM bridge GROUP BY ALL UNION ALL SELECT 'left_only', nct_id, literal_name, list(role) FROM bridge_p GROUP BY ALL)
  SELECT nct_id, canonical, role, state, CASE WHEN state <> 'agree' THEN CASE WHEN roles IS NULL THEN 'literal_absent' WHEN list_contains(roles, role) THEN 'canonical_differs' ELSE 'role_differs' END END AS cause FROM j LEFT JOIN o USING (state, nct_id, lit)""")
def concordance(spark, sf_dir):
    """This week's index against the one of the week before, on the trials of both."""
    now, before = both_weeks(spark, sf_dir)
    return S.concordance(S.bridge(now, rules(spark, sf_dir)), S.bridge(before, prior_rules(spark, sf_dir)), now, before)


@query("JN-9", PRIOR + """, u AS (SELECT DISTINCT name FROM sponsors), up AS (SELECT DISTINCT name FROM sponsors_p) SELECT coalesce(a.name, b.name) AS literal_name, CASE WHEN b.name IS NULL THEN 'dropped_match' WHEN a.name IS NULL THEN 'new_match' ELSE 'canonicals_changed' END AS change,
  CASE WHEN (coalesce(a.name, b.name) IN (SELECT name FROM u)) <> (coalesce(a.name, b.name) IN (SELECT name FROM up)) THEN 'both' ELSE 'rules_change' END AS cause, a.canonical AS before, b.canonical AS after FROM matched_p a FULL JOIN matched b ON a.name = b.name WHERE a.canonical IS DISTINCT FROM b.canonical""")
def match_changes(spark, sf_dir):
    now, before = both_weeks(spark, sf_dir)
    a, b = (kept(S.literals(x), "literals") for x in (before, now))
    return S.match_changes(S.matched(a, prior_rules(spark, sf_dir)), S.matched(b, rules(spark, sf_dir)), a, b, True)


@query("JN-10", PRIOR + """, a AS (SELECT nct_id, canonical, role, min(literal_name) AS literal FROM bridge GROUP BY 1, 2, 3), b AS (SELECT nct_id, canonical, role, min(literal_name) AS literal FROM bridge_p GROUP BY 1, 2, 3)
  SELECT a.*, 'added' AS change, CASE WHEN (nct_id, role, literal) IN (SELECT (nct_id, role, name) FROM sponsors_p) THEN 'rules_change' ELSE 'registry_edit' END AS cause FROM a ANTI JOIN b USING (nct_id, canonical, role)
  UNION ALL SELECT b.*, 'removed', CASE WHEN (nct_id, role, literal) IN (SELECT (nct_id, role, name) FROM sponsors) THEN 'rules_change' ELSE 'registry_edit' END FROM b ANTI JOIN a USING (nct_id, canonical, role)""")
def pair_changes(spark, sf_dir):
    now, before = both_weeks(spark, sf_dir)
    return S.pair_changes(S.bridge(before, prior_rules(spark, sf_dir)), S.bridge(now, rules(spark, sf_dir)), before, now, True)


@query("AGG-11", f"WITH {SPONSORS} SELECT name, count(DISTINCT nct_id) AS n_trials, array_to_string(list_sort(list(DISTINCT role)), ',') AS roles, min(agency_class) AS first_class FROM sponsors GROUP BY 1")
def literal_summary(spark, sf_dir):
    return sponsors(spark, sf_dir).groupBy("name").agg(F.count_distinct("nct_id").alias("n_trials"), F.array_join(F.array_sort(F.collect_set("role")), ",").alias("roles"), F.min("agency_class").alias("first_class"))


@query("AGG-12", KEYED + " SELECT nct_id, array_to_string(list_sort(list(DISTINCT role)), ',') AS roles, bool_or(role = 'lead') AS is_lead, bool_or(role = 'collaborator') AS is_collaborator FROM bridge WHERE canonical = 'Group 2' GROUP BY 1")
def company_trials(spark, sf_dir):
    return S.company_trials(bridged(spark, sf_dir), F.col("canonical") == "Group 2")


@query("AGG-13", KEYED + " SELECT canonical, entity, count(DISTINCT nct_id) AS n_trials, count(DISTINCT CASE WHEN role = 'lead' THEN nct_id END) AS n_lead, count(DISTINCT CASE WHEN role = 'collaborator' THEN nct_id END) AS n_collab FROM bridge GROUP BY 1, 2")
def entity_counts(spark, sf_dir):
    return S.entity_counts(bridged(spark, sf_dir))


COMPANIES = ["Group 1", "Group 2", "Group 5"]
FLAGS = ", ".join(f"bool_or(canonical = '{c}'{also}) AS {c.lower().replace(' ', '_')}_{scope}" for c in COMPANIES for scope, also in (("any", ""), ("lead", " AND role = 'lead'"), ("collab", " AND role = 'collaborator'")))


@query("AGG-14", KEYED + f" SELECT nct_id, {FLAGS} FROM bridge WHERE canonical IN ('Group 1', 'Group 2', 'Group 5') GROUP BY 1")
def company_flags(spark, sf_dir):
    return S.company_flags(bridged(spark, sf_dir), COMPANIES)


@query("AGG-16", KEYED + " SELECT canonical, role, count(*) AS n_rows, count(DISTINCT nct_id) AS n_trials FROM bridge GROUP BY GROUPING SETS ((canonical, role), (canonical), ())")
def bridge_block(spark, sf_dir):
    b = bridged(spark, sf_dir)
    return b.groupingSets([["canonical", "role"], ["canonical"], []], "canonical", "role").agg(F.count("*").alias("n_rows"), F.count_distinct("nct_id").alias("n_trials"))


@query("AGG-35", KEYED + " SELECT canonical, count(DISTINCT nct_id) AS n_trials, count(DISTINCT CASE WHEN role = 'lead' THEN nct_id END) AS n_lead, count(DISTINCT CASE WHEN role = 'collaborator' THEN nct_id END) AS n_collab FROM bridge GROUP BY 1")
def cohort_counts(spark, sf_dir):
    return S.entity_counts(bridged(spark, sf_dir), "canonical")


@query("AGG-15", f"WITH {SPONSORS} SELECT role, agency_class, count(*) AS n, count_if(trim(name) = '') AS n_empty FROM sponsors GROUP BY 1, 2")
def adapter_counts(spark, sf_dir):
    return sponsors(spark, sf_dir).groupBy("role", "agency_class").agg(F.count("*").alias("n"), F.count_if(F.trim("name") == "").alias("n_empty"))


@query("WIN-4", KEYED + """, un AS (SELECT name FROM named WHERE match_rule IS NULL AND NOT (NOT is_unit AND has_rule AND n BETWEEN 80 AND 89)), l AS (SELECT name, count(DISTINCT nct_id) AS n_lead_trials FROM sponsors WHERE role = 'lead' AND agency_class IN ('BUILDING', 'MACHINERY') AND name IN (SELECT name FROM un) GROUP BY 1),
  t AS (SELECT CAST(row_number() OVER (ORDER BY n_lead_trials DESC, name) AS INT) AS rank, * FROM l), e AS (SELECT name, count(DISTINCT nct_id) AS n_any_trials, array_to_string(list_sort(list(DISTINCT role)), ',') AS roles FROM sponsors GROUP BY 1)
  SELECT rank, name, n_lead_trials, n_any_trials, roles, 'holding ' || substr(name, 9, 2) AS normalized_pattern, '' AS parsed_parent, '<canonical>,exact_normalized,"holding ' || substr(name, 9, 2) || '",attribute,no,"<initials> <date>: <why>"' AS draft_rule_line FROM t JOIN e USING (name) WHERE rank <= 100""")
def curation_batch(spark, sf_dir):
    who = sponsors(spark, sf_dir)
    states = S.literal_states(S.literals(who), rules(spark, sf_dir))
    return S.curation_batch(who, states.filter("state = 'unreviewed'"), F.col("agency_class").isin("BUILDING", "MACHINERY"))
