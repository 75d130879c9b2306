"""The by-year mart, adjusted contrasts of sponsors, and whether posted sections can be used."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import records as U
from ..functions import race as E
from ..functions.evidence import APART, MINORITIES, gender_detail
from ..operators import marts as M
from ..operators import selection as S
from ..operators import stats as T
from ..sources.folders import kept
from .bindings import cells, table
from .dimensions import ETHNIC_LABELS, RACE, _sql, block
from .registry import query
from .trials import PARSED, finished


def nct(column: str):
    return F.concat(F.lit("NCT"), F.lpad(F.col(column).cast("string"), 8, "0"))


NCT = "'NCT' || lpad(CAST(l_orderkey AS VARCHAR), 8, '0')"


def _sums(dimension: str, column: str, names: dict[str, str] | None = None) -> str:
    categories = M.DIMENSIONS[dimension][1]
    return ", ".join(f"sum(CASE WHEN {column} = '{(names or {}).get(c, c)}' THEN value ELSE 0 END) AS {short}" for c, short in categories.items())


IDENTITIES = {"Women": "woman", "Male ": "man", "Non-binary": "nonbinary", "Transgender female*": "transgender", "Unknown or Not Reported": "unknown"}


def _measures() -> str:
    out = []
    for d, (x, categories, shared) in M.DIMENSIONS.items():
        whole = " + ".join(f"{x}.{s}" for s in categories.values() if s not in M.OUTSIDE.get(d, ()))
        out += [f"sum(coalesce({x}.\"{s}\", 0)) AS {x}_{s}" for s in categories.values()]
        whole = " + ".join(f'{x}."{s}"' for s in categories.values() if s not in M.OUTSIDE.get(d, ()))
        out.append(f"count_if({whole} > 0) AS {x}n_count")
        out += [f'round(coalesce(sum(CASE WHEN {whole} > 0 THEN {x}."{s}" / ({whole}) END), 0), 6) AS {x}n_{s}' for s in shared]
    return ", ".join(out)


MART = PARSED + f""", {RACE}, r AS (SELECT {NCT} AS nct_id, {_sums("race", "category").replace(" AS as", ' AS "as"')} FROM race WHERE category IS NOT NULL GROUP BY 1),
  el{_sql(ETHNIC_LABELS, ("i", "label", "category"))}, e AS (SELECT {NCT} AS nct_id, {_sums("ethnicity", "category")} FROM (SELECT l_orderkey, category, l_quantity AS value FROM lineitem JOIN el ON l_suppkey % 5 = i) WHERE category IS NOT NULL GROUP BY 1),
  s AS (SELECT nct_id, coalesce(n_female, 0) AS f, coalesce(n_male, 0) AS m, coalesce(n_unknown, 0) AS u FROM done WHERE reported_sex),
  g AS (SELECT nct_id, {_sums("gender", "label", {v: k for k, v in IDENTITIES.items()})} FROM cells WHERE title = 'Sex/Gender, Customized' GROUP BY 1)
  SELECT d.year, count(*) AS total, sum(coalesce(d.enrollment, 0)) AS enrollment, sum(coalesce(d.enrollment, 0)) AS fd_enrollment, count(r.nct_id) AS race_reported, count(e.nct_id) AS eth_reported, count(s.nct_id) AS sex_reported, count(g.nct_id) AS gender_reported,
  count_if(r.nct_id IS NOT NULL AND e.nct_id IS NOT NULL) AS both_reported, count_if(reported_sex) AS sg_sex_reported, count_if(reported_gender) AS sg_gender_reported, count_if(reported_sex AND reported_gender) AS sg_sex_gender_reported, count_if(reported_sex AND reported_gender AND r.nct_id IS NOT NULL AND e.nct_id IS NOT NULL) AS all_four_reported, {_measures()}
  FROM done d LEFT JOIN r USING (nct_id) LEFT JOIN e USING (nct_id) LEFT JOIN s USING (nct_id) LEFT JOIN g USING (nct_id) GROUP BY 1"""


@query("AGG-4", MART)
def yearly_mart(spark, sf_dir):
    done = kept(finished(spark, sf_dir).select("nct_id", "year", "enrollment", "reported_sex", "reported_gender", *[f"n_{b}" for b in M.SEX]), "done")
    totals = lambda rows, by, category: rows.filter(F.col(category).isNotNull()).groupBy(by, category).agg(F.sum("value").alias("n")).groupBy(by).agg(F.map_from_entries(F.collect_list(F.struct(category, "n"))).alias("totals"))
    race = block(spark, sf_dir).filter("reported").select(nct("l_orderkey").alias("nct_id"), "totals")
    labels = F.array(*[F.lit(x[0]) for x in ETHNIC_LABELS])
    eth = table(spark, sf_dir, "lineitem").select(nct("l_orderkey").alias("nct_id"), F.get(labels, (F.col("l_suppkey") % 5).cast("int")).alias("label"), F.col("l_quantity").alias("value"))
    eth = totals(S.classify_distinct(eth, "label", "category", E.ethnicity), "nct_id", "category")
    sex = done.filter("reported_sex").select("nct_id", F.create_map(*[x for b in M.SEX for x in (F.lit(b), F.coalesce(f"n_{b}", F.lit(0.0)))]).alias("totals"))
    known = F.create_map(*[F.lit(x) for kv in IDENTITIES.items() for x in kv])
    posted = cells(spark, sf_dir).filter("title = 'Sex/Gender, Customized'").withColumn("category", F.coalesce(F.try_element_at(known, F.col("label")), F.lit("none")))
    rows = M.yearly(done.select("nct_id", "year", "enrollment"), {"race": race, "ethnicity": eth, "sex": sex, "gender": totals(posted, "nct_id", "category")}, done.select("nct_id", "reported_sex", "reported_gender"))
    return rows.select(*[F.round(c, 6).alias(c) if "n_" in c and c[1:3] == "n_" and not c.endswith("count") else F.col(c) for c in rows.columns])


DETAILS = """, w AS (SELECT nct_id, title, sum(CASE WHEN label = 'Non-binary' THEN value END) AS nb, sum(CASE WHEN label LIKE 'Trans%' THEN value END) AS tr, sum(CASE WHEN label LIKE 'Unknown%' THEN value END) AS un, bool_or(label = 'Non-binary' OR label LIKE 'Trans%') AS hi, bool_or(bucket IN ('female', 'male')) AS bin, bool_or(unit <> 'Participants') AS np FROM rows GROUP BY 1, 2),
  p AS (SELECT nct_id, max(nb) AS nb, max(tr) AS tr, max(un) AS un, bool_or(hi) AS posts, bool_or(hi AND bin) AS two, count_if(hi) > 1 AS dbl, bool_or(hi AND np) AS notp FROM w GROUP BY 1),
  q AS (SELECT d.nct_id, enrollment, coalesce(reported_gender AND posts, FALSE) AS ok, nb, tr, un, two, dbl, is_participant_count IS NOT DISTINCT FROM FALSE OR notp AS units, CASE WHEN nb IS NOT NULL OR tr IS NOT NULL THEN coalesce(nb, 0) + coalesce(tr, 0) END AS d3 FROM done d LEFT JOIN p USING (nct_id))"""


@query("SEL-13", PARSED + DETAILS + """ SELECT nct_id, CASE WHEN NOT ok THEN 'not_applicable' WHEN units OR coalesce(d3 > enrollment * 1.1, FALSE) THEN 'excluded' ELSE 'derived' END AS status, CASE WHEN ok AND units THEN 'non_participant_units' WHEN ok AND d3 > enrollment * 1.1 THEN 'sum_exceeds_enrollment_10pct' END AS exclusion,
  CASE WHEN ok THEN nb END AS nonbinary_gender_expansive, CASE WHEN ok THEN tr END AS transgender_with_sex_term, CASE WHEN ok THEN un END AS explicit_unknown_declined, CASE WHEN ok THEN d3 END AS d3_total, CASE WHEN ok THEN d3 END AS d5_strict, CASE WHEN ok THEN two END AS two_question_table, CASE WHEN ok THEN dbl END AS possible_double_count FROM q""")
def gender_categories(spark, sf_dir):
    rows = S.gender_categories(cells(spark, sf_dir), finished(spark, sf_dir), gender_detail, MINORITIES, APART)
    return rows.select("nct_id", "status", "exclusion", "nonbinary_gender_expansive", "transgender_with_sex_term", "explicit_unknown_declined", "d3_total", "d5_strict", "two_question_table", "possible_double_count")


@query("AGG-8", PARSED + DETAILS + """, st AS (SELECT *, CASE WHEN NOT ok THEN 'not_applicable' WHEN units OR coalesce(d3 > enrollment * 1.1, FALSE) THEN 'excluded' ELSE 'derived' END AS gs FROM q), j AS (SELECT done.*, gs, d3 FROM done JOIN st USING (nct_id)),
  m AS (SELECT count(*) AS trials, count_if(reported_sex AND reported_gender) AS both_, count_if(reported_sex AND NOT reported_gender) AS sex_only, count_if(reported_gender AND NOT reported_sex) AS gender_only, count_if(NOT reported_sex AND NOT reported_gender) AS neither,
  count_if(NOT reported_sex AND NOT reported_gender AND status = 'explicit_unknown_only') AS r1, count_if(NOT reported_sex AND NOT reported_gender AND status = 'not_reported') AS r2, count_if(NOT reported_sex AND NOT reported_gender AND status = 'uninformative') AS r3, count_if(reported_sex AND coalesce(is_participant_count, FALSE)) AS eligible,
  count_if(gs = 'derived') AS g1, count_if(gs = 'not_applicable') AS g2, count_if(gs = 'excluded') AS g3, sum(CASE WHEN gs = 'derived' THEN d3 END) AS d3, count(CASE WHEN gs = 'derived' THEN d3 END) AS d3n FROM j)
  SELECT unnest(['trials', 'dimension_both', 'dimension_sex_only', 'dimension_gender_only', 'dimension_neither', 'explicit_unknown_or_not_collected', 'measure_absent', 'measure_present_no_usable_breakdown', 'composition_eligible', 'categories_derived', 'categories_not_applicable', 'categories_excluded', 'd3_participants', 'd3_trials', 'd5_participants', 'd5_trials']) AS metric,
  unnest([trials, both_, sex_only, gender_only, neither, r1, r2, r3, eligible, g1, g2, g3, d3, d3n, d3, d3n]) AS value FROM m""")
def analysis_summary(spark, sf_dir):
    """Counts over the analysis blocks; a sum of participants is null where no trial contributes, and its trials are its denominator."""
    done = finished(spark, sf_dir)
    g = S.gender_categories(cells(spark, sf_dir), done, gender_detail, MINORITIES, APART).select("nct_id", F.col("status").alias("gs"), "d3_total", "d5_strict")
    rows = done.select("nct_id", S.reporting_dimension().alias("d"), S.neither_reason().alias("r"), S.composition_reason().alias("c")).join(g, "nct_id")
    derived = lambda c: F.when(F.col("gs") == "derived", F.col(c))
    metrics = {
        "trials": F.count("*"), **{f"dimension_{x}": F.count_if(F.col("d") == x) for x in ("both", "sex_only", "gender_only", "neither")},
        **{x: F.count_if(F.col("r") == x) for x in ("explicit_unknown_or_not_collected", "measure_absent", "measure_present_no_usable_breakdown")}, "composition_eligible": F.count_if(F.col("c").isNull()),
        **{f"categories_{x}": F.count_if(F.col("gs") == x) for x in ("derived", "not_applicable", "excluded")},
        "d3_participants": F.sum(derived("d3_total")), "d3_trials": F.count(derived("d3_total")), "d5_participants": F.sum(derived("d5_strict")), "d5_trials": F.count(derived("d5_strict")),
    }
    one = rows.agg(*[m.cast("double").alias(k) for k, m in metrics.items()])
    return one.selectExpr(f"stack({len(metrics)}, " + ", ".join(f"'{k}', {k}" for k in metrics) + ") as (metric, value)")


@query("AGG-26")
def bootstrap(spark, sf_dir):
    """Resampled by hashes, which SQL can't restate: the tests hold means exactly, intervals by coverage and against another partitioning."""
    rows = finished(spark, sf_dir).filter("percent_female is not null").withColumn("fm", F.coalesce("n_female", F.lit(0.0)) + F.coalesce("n_male", F.lit(0.0)))
    return T.bootstrap_mean(rows.select("nct_id", "class", "percent_female", "fm"), "class", "percent_female", "fm", "nct_id", floor=50)


REGRESSORS = ["phase_2", "phase_3", "phase_4", "year_c", "log_enrollment", "n_lines", "is_area"]
FITTED = PARSED + """, x AS (SELECT nct_id, CASE WHEN class IN ('BUILDING', 'MACHINERY') THEN class ELSE 'Other Industry' END AS bucket, percent_female AS y, CAST(left(phase, 1) = '2' AS DOUBLE) AS phase_2, CAST(left(phase, 1) = '3' AS DOUBLE) AS phase_3, CAST(left(phase, 1) = '4' AS DOUBLE) AS phase_4, CAST(d.year - 1995 AS DOUBLE) AS year_c, ln(d.enrollment) AS log_enrollment, CAST(n_rows AS DOUBLE) AS n_lines, CAST(nation % 5 = 0 AS DOUBLE) AS is_area
  FROM done d JOIN (SELECT nct_id, phase, nation FROM studies) USING (nct_id) JOIN (SELECT nct_id, count(*) AS n_rows FROM cells GROUP BY 1) USING (nct_id) WHERE percent_female IS NOT NULL AND d.enrollment > 0)"""


def fit_rows(spark, sf_dir):
    done = finished(spark, sf_dir).filter("percent_female is not null and enrollment > 0")
    lines = cells(spark, sf_dir).groupBy("nct_id").agg(F.count("*").cast("double").alias("n_lines"))
    p = F.left("phase", F.lit(1))
    return done.join(lines, "nct_id").select(
        "nct_id", F.when(F.col("class").isin("BUILDING", "MACHINERY"), F.col("class")).otherwise("Other Industry").alias("bucket"), F.col("percent_female").alias("y"),
        *[(p == k).cast("double").alias(f"phase_{k}") for k in "234"], (F.col("year") - 1995).cast("double").alias("year_c"), F.log("enrollment").alias("log_enrollment"), "n_lines", (F.col("nation") % 5 == 0).cast("double").alias("is_area"),
    )


def _swept(columns: list[str], by: str, source: str) -> str:
    """Tables that take out of every later column what the earlier ones explain, one after another."""
    out, last = [], source
    for i, c in enumerate(columns):
        rest = columns[i + 1 :]
        share = lambda r, c=c: f"CASE WHEN sum({c} * {c}) OVER ({by}) > 1e-9 THEN sum({c} * {r}) OVER ({by}) / sum({c} * {c}) OVER ({by}) ELSE 0 END"
        name = f"t{i}"
        out.append(f"{name} AS (SELECT {'g, ' if by else ''}{', '.join([*columns[: i + 1], *(f'{r} - {c} * ({share(r)}) AS {r}' for r in rest)])} FROM {last})")
        last = name
    return ", ".join(out)


@query("AGG-27", FITTED + f""", u AS (SELECT b.bucket AS g, 1.0 AS one, {", ".join(REGRESSORS)}, CAST(x.bucket = b.bucket AS DOUBLE) AS v, y FROM x JOIN (SELECT DISTINCT bucket FROM x WHERE bucket <> 'Other Industry') b ON x.bucket IN (b.bucket, 'Other Industry')),
  {_swept(["one", *REGRESSORS, "v", "y"], "PARTITION BY g", "u")}, z AS (SELECT g, count(*) AS n, sum(v * t7.y) / sum(v * v) AS beta, sum(v * v) AS vv, {" + ".join(f"CAST(sum({c} * {c}) > 1e-9 AS INT)" for c in ["one", *REGRESSORS, "v"])} AS rank FROM t7 GROUP BY 1),
  e AS (SELECT z.*, sqrt((SELECT sum(power(t7.y - z.beta * t7.v, 2)) FROM t7 WHERE t7.g = z.g) / (n - rank) / vv) AS se FROM z) SELECT g AS sponsor, n, round(beta, 4) AS beta, round(beta - 1.96 * se, 4) AS lo, round(beta + 1.96 * se, 4) AS hi, round(beta / se, 4) AS z FROM e WHERE n >= 50""")
def sponsor_contrasts(spark, sf_dir):
    """Each class against the rest, adjusted for phase, year, size, lines and area. The operator's normal p is left out here, as DuckDB has no error function."""
    found = T.contrasts(fit_rows(spark, sf_dir), "bucket", "Other Industry", "y", REGRESSORS)
    return found.select(F.col("bucket").alias("sponsor"), "n", *[F.round(c, 4).alias(c) for c in ("beta", "lo", "hi", "z")])


SPONSOR_FLAGS = ["is_building", "is_machinery"]


@query("AGG-28", FITTED + f""", u AS (SELECT 1.0 AS one, {", ".join(REGRESSORS)}, CAST(bucket = 'BUILDING' AS DOUBLE) AS is_building, CAST(bucket = 'MACHINERY' AS DOUBLE) AS is_machinery, y FROM x), {_swept(["one", *REGRESSORS, *SPONSOR_FLAGS, "y"], "", "u")}
  SELECT count(*) AS n, round(1 - sum(y * y) / (SELECT var_pop(y) * count(*) FROM u), 6) AS r2, round(1 - sum(y * y) / (SELECT var_pop(y) * count(*) FROM u) * (count(*) - 1) / (count(*) - {len(REGRESSORS) + 3}), 6) AS adj_r2 FROM t{len(REGRESSORS) + 2}""")
def pooled_fit(spark, sf_dir):
    rows = fit_rows(spark, sf_dir).withColumns({f"is_{b.lower()}": (F.col("bucket") == b).cast("double") for b in ("BUILDING", "MACHINERY")})
    return T.fit_quality(rows, "y", [*REGRESSORS, *SPONSOR_FLAGS]).select("n", F.round("r2", 6).alias("r2"), F.round("adj_r2", 6).alias("adj_r2"))


GROUPED = "gl AS (SELECT DISTINCT l_orderkey, l_linenumber AS g FROM lineitem)"
POSTED = "CASE WHEN l_discount = 0.07 THEN NULL WHEN l_discount = 0.03 THEN 'NA' WHEN l_discount = 0.01 THEN '0' ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END"


#: One row for each order, flag and line number, which the table repeats here and there.
LINES = f"x AS (SELECT l_orderkey, l_returnflag, l_linenumber, max({POSTED}) AS n, max(l_tax) AS l_tax, min(l_suppkey) AS mode FROM lineitem GROUP BY 1, 2, 3)"


def posted_lines(spark, sf_dir):
    d = F.round("l_discount", 2)
    n = F.when(d == 0.07, None).when(d == 0.03, "NA").when(d == 0.01, "0").otherwise(F.col("l_quantity").cast("int").cast("string"))
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_returnflag", "l_linenumber").agg(F.max(n).alias("n"), F.max("l_tax").alias("l_tax"), F.min("l_suppkey").alias("mode"))


def group_ids(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_linenumber")).alias("groups"))


@query("FLT-15-flow", f"""WITH {GROUPED}, {LINES}, c AS (SELECT l_orderkey, l_returnflag AS period, l_linenumber % 2 = 0 OR l_tax < 0.06 AS has_done, l_linenumber AS g, n FROM x), k AS (SELECT l_orderkey, count(*) AS n_groups FROM gl GROUP BY 1),
  p AS (SELECT l_orderkey, period, bool_and(has_done) AS completed, count(DISTINCT CASE WHEN try_cast(n AS DOUBLE) IS NOT NULL THEN g END) AS ok, bool_or(coalesce(try_cast(n AS DOUBLE) > 0, FALSE)) AS any_one FROM c WHERE period <> 'A' GROUP BY 1, 2),
  o AS (SELECT k.l_orderkey, bool_or(completed AND ok = n_groups AND any_one) AS usable, count(period) > 0 AS st, bool_or(completed) AS co FROM k LEFT JOIN p USING (l_orderkey) GROUP BY 1)
  SELECT l_orderkey, coalesce(usable, FALSE) AS usable, CASE WHEN coalesce(usable, FALSE) THEN 'ok' WHEN NOT st THEN 'no_STARTED_milestone' WHEN NOT co THEN 'no_COMPLETED_milestone' ELSE 'counts_missing_for_a_group_or_all_zero' END AS reason FROM o""")
def usable_flow(spark, sf_dir):
    """Periods by return flag (returned lines post none); a period whose lines all qualify posts who completed, the same numbers again."""
    lines = posted_lines(spark, sf_dir).filter("l_returnflag <> 'A'")
    counts = F.map_from_entries(F.collect_list(F.struct("l_linenumber", "n")))
    completed = F.every((F.col("l_linenumber") % 2 == 0) | (F.col("l_tax") < 0.06))
    p = lines.groupBy("l_orderkey", "l_returnflag").agg(counts.alias("started"), completed.alias("c")).groupBy("l_orderkey").agg(F.collect_list(F.struct("started", F.when(F.col("c"), F.col("started")).alias("completed"))).alias("periods"))
    rows = group_ids(spark, sf_dir).join(p, "l_orderkey", "left").withColumn("periods", F.coalesce("periods", F.array().cast(p.schema["periods"].dataType)))
    return rows.select("l_orderkey", U.flow_usable(F.col("groups"), F.col("periods")).alias("x")).select("l_orderkey", "x.usable", "x.reason")


@query("FLT-15-outcome", f"""WITH {LINES}, m AS (SELECT l_orderkey, l_returnflag AS measure, CASE WHEN min(l_tax) < 0.01 THEN ' ' ELSE 'people' END AS unit, max(l_tax) > 0.06 AS classes, min(l_tax) > 0.07 AS no_row, count(*) AS k, count(try_cast(n AS DOUBLE)) AS k_num, count_if(try_cast(n AS DOUBLE) > 0) AS k_pos, count_if(try_cast(n AS DOUBLE) > 0 AND mode % 7 <> 0) AS k_val FROM x GROUP BY 1, 2),
  r AS (SELECT *, CASE WHEN trim(unit) = '' THEN CASE WHEN classes THEN 'no_unit' ELSE 'no_data_table' END WHEN no_row THEN 'no_number_analysed' WHEN k_num < k THEN 'number_analysed_missing_for_a_group' WHEN k_pos = 0 THEN 'zero_analysed_in_every_group' WHEN k_val < k_pos THEN 'no_numeric_value_for_an_analysed_group' ELSE 'ok' END AS reason FROM m)
  SELECT l_orderkey, measure, reason = 'ok' AS usable, reason = 'ok' AND k_pos = k AS strict, reason FROM r""")
def usable_outcomes(spark, sf_dir):
    """A measure for each return flag, its lines the groups; those of every seventh supplier post no value."""
    m = posted_lines(spark, sf_dir).groupBy("l_orderkey", F.col("l_returnflag").alias("measure")).agg(
        F.when(F.min("l_tax") < 0.01, " ").otherwise("people").alias("unit"), (F.max("l_tax") > 0.06).alias("classes"), F.array_sort(F.collect_list("l_linenumber")).alias("groups"),
        F.when(F.min("l_tax") <= 0.07, F.map_from_entries(F.collect_list(F.struct("l_linenumber", "n")))).alias("analysed"), F.collect_list(F.when(F.col("mode") % 7 != 0, F.col("l_linenumber"))).alias("valued"),
    )
    rows = m.select("l_orderkey", "measure", U.outcome_usable(F.col("unit"), F.col("classes"), F.col("groups"), F.col("analysed"), F.col("valued")).alias("x"))
    return rows.select("l_orderkey", "measure", "x.usable", "x.strict", "x.reason")


@query("FLT-15-events", f"""WITH {LINES}, c AS (SELECT o_orderkey, o_orderstatus AS s, count(l_orderkey) AS k, count_if(try_cast(n AS DOUBLE) IS NULL) AS bad, count_if(try_cast(n AS DOUBLE) > 0) AS pos, count_if(l_tax > 0.07) AS ev, count_if(mode % 5 = 0) AS nototal, count_if(l_linenumber > 2) AS affected FROM orders LEFT JOIN x ON o_orderkey = l_orderkey GROUP BY 1, 2),
  r AS (SELECT *, CASE WHEN s = 'P' THEN 'module_absent' WHEN k = 0 THEN 'no_event_groups' WHEN bad > 0 THEN 'numbers_at_risk_missing_for_a_group' WHEN pos = 0 THEN 'zero_at_risk_in_every_group' WHEN ev = 0 AND nototal > 0 THEN 'no_event_rows_and_no_group_totals' ELSE 'ok' END AS reason FROM c)
  SELECT o_orderkey, reason = 'ok' AS usable, reason, CASE WHEN s <> 'P' AND k > 0 THEN ev = 0 AND nototal = 0 AND affected = 0 END AS explicit_zero_only FROM r""")
def usable_events(spark, sf_dir):
    """The lines of an order are its event groups, pending orders have no module; those of every fifth supplier post no totals, the first two lines post zero."""
    total = F.when(F.col("mode") % 5 == 0, None).otherwise((F.col("l_linenumber") > 2).cast("int").cast("string"))
    g = posted_lines(spark, sf_dir).groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("n").alias("serious_at_risk"), F.col("n").alias("other_at_risk"), total.alias("serious_affected"), total.alias("other_affected"))).alias("groups"), F.count_if(F.col("l_tax") > 0.07).alias("event_rows"))
    rows = table(spark, sf_dir, "orders").join(g, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    groups = F.when(F.col("o_orderstatus") != "P", F.coalesce("groups", F.array().cast(g.schema["groups"].dataType)))
    return rows.select("o_orderkey", U.events_usable(groups, F.coalesce("event_rows", F.lit(0))).alias("x")).select("o_orderkey", "x.usable", "x.reason", "x.explicit_zero_only")


CHECKS = ["reported_any_ge_reported_sex", "reported_any_ge_reported_gender", "reported_both_le_min", "status_counts_sum_to_rows", "every_row_has_one_status", "is_participant_count_matches_parser_rule", "count_of_units_never_participant_count", "parse_error_rows_have_none_outcomes",
  "explicit_unknown_only_rows_are_unknown_only", "not_reported_rows_have_no_measure", "percent_female_only_in_denominator_set", "single_parser_rules_version"]


def checked_rows(spark, sf_dir):
    rows = finished(spark, sf_dir).withColumns({"raw_present": F.col("measure_title").isNotNull(), "parse_ok": F.lit(True), "param_type": F.lit(None).cast("string"), "parser_version": F.lit("1")})
    return rows.withColumn("k", F.substring("nct_id", 4, 8).cast("int"))


@query("DQ-2", "SELECT unnest([" + ", ".join(f"'{c}'" for c in CHECKS) + "]) AS check_name, CAST(0 AS BIGINT) AS n_bad, TRUE AS pass FROM (SELECT count(*) FROM lineitem)")
def structural_checks(spark, sf_dir):
    """All twelve hold on the parsed table; DQ-2-planted shows that each would not."""
    return S.structural_checks(checked_rows(spark, sf_dir), "1")


@query("DQ-2-planted", PARSED + """, k AS (SELECT *, CAST(substr(nct_id, 4) AS INT) AS k FROM done), c AS (SELECT
  count_if(coalesce(reported_sex, FALSE)) AS s, count_if(coalesce(reported_gender, FALSE)) AS g, count(*) AS n, count_if(k % 50 = 1) AS bad_status, count_if(measure_title IS NOT NULL AND k % 50 = 2 AND is_participant_count) AS flipped, count_if(measure_title IS NOT NULL AND k % 50 = 2 AND NOT is_participant_count) AS flipped2,
  count_if(k % 50 = 3 AND coalesce(is_participant_count, TRUE)) AS units, count_if(k % 50 = 3 AND is_participant_count AND measure_title IS NOT NULL) AS units_rule, count_if(k % 50 = 4 AND NOT (k % 50 = 1)) AS pe, count_if(k % 50 = 5 AND NOT (coalesce(n_unknown, 0) > 0 AND coalesce(n_female, 0) + coalesce(n_male, 0) + coalesce(n_gender_diverse, 0) + coalesce(n_ambiguous, 0) = 0)) AS eu, count_if(k % 50 = 6 AND measure_title IS NOT NULL) AS nr,
  count_if(k % 50 = 7 AND NOT (coalesce(reported_sex, FALSE) AND coalesce(is_participant_count, FALSE))) + count_if(k % 50 = 2 AND percent_female IS NOT NULL) AS pf, count_if(k % 50 = 8) AS v FROM k)
  SELECT unnest([""" + ", ".join(f"'{c}'" for c in CHECKS) + """]) AS check_name, unnest([s, g, 0, bad_status, bad_status, flipped + flipped2 + units_rule, units, pe, eu, nr, pf, v]) AS n_bad FROM c""")
def planted_faults(spark, sf_dir):
    """Trials by their number modulo 50: another status, turned units, counts of units, errors with outcomes, and so on; nothing reported at all."""
    r = checked_rows(spark, sf_dir)
    k = lambda i: F.col("k") % 50 == i
    status = F.when(k(1), "lost").when(k(4), "parse_error").when(k(5), "explicit_unknown_only").when(k(6), "not_reported").otherwise(F.col("status"))
    faults = {
        "status": status, "is_participant_count": F.when(k(2), ~F.col("is_participant_count")).otherwise(F.col("is_participant_count")), "param_type": F.when(k(3), "COUNT_OF_UNITS"), "reported_any": F.lit(False), "reported_both": F.lit(False),
        "percent_female": F.when(k(7), 50.0).otherwise(F.col("percent_female")), "parser_version": F.when(k(8), "0").otherwise(F.col("parser_version")),
    }
    return S.structural_checks(r.withColumns(faults), "1").select("check_name", "n_bad")
