"""Queries over trials and their baseline tables: scalars, predicates, labels, selection, marts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import labels as L
from ..functions import numbers as N
from ..functions import names as M
from ..operators import selection as S
from .bindings import CELLS, LABELS, STUDIES, cells, registered, studies, table
from .registry import query


def date_text():
    return F.when(F.col("status") == "F", F.date_format("results_date", "yyyy-MM-dd")).when(F.col("status") == "O", F.date_format("results_date", "yyyy-MM")).otherwise(F.date_format("results_date", "yyyy"))


DATED = f"""WITH {STUDIES}, dated AS (SELECT *, CASE status WHEN 'F' THEN strftime(results_date, '%Y-%m-%d') WHEN 'O' THEN strftime(results_date, '%Y-%m') ELSE strftime(results_date, '%Y') END AS text,
  CASE status WHEN 'P' THEN make_date(CAST(year AS INT), 1, 1) WHEN 'O' THEN CAST(date_trunc('month', results_date) AS DATE) ELSE results_date END AS lo,
  CASE status WHEN 'P' THEN make_date(CAST(year AS INT), 12, 31) WHEN 'O' THEN last_day(results_date) ELSE results_date END AS hi FROM studies)"""


def dated(spark, sf_dir):
    return registered(spark, sf_dir).withColumn("text", date_text())


@query("PRJ-5", DATED + " SELECT nct_id, CAST(date_diff('day', lo, DATE '2001-03-01') AS INTEGER) AS days FROM dated")
def days_between(spark, sf_dir):
    return dated(spark, sf_dir).select("nct_id", D.days_between(F.col("text"), F.lit("2001-03")).alias("days"))


@query("PRJ-6", DATED + " SELECT nct_id, CASE status WHEN 'F' THEN 'day' WHEN 'O' THEN 'month' ELSE 'year' END AS precision, lo AS starts, hi AS ends, CAST(hi + INTERVAL 1 YEAR AS DATE) AS due FROM dated")
def partial_dates(spark, sf_dir):
    t = F.col("text")
    return dated(spark, sf_dir).select("nct_id", D.precision(t).alias("precision"), D.period_start(t).alias("starts"), D.period_end(t).alias("ends"), D.add_years(D.period_end(t), 1).alias("due"))


@query("PRJ-7", DATED + " SELECT nct_id, CASE WHEN status <> 'P' THEN lo END AS lo, CASE WHEN status <> 'P' THEN hi END AS hi FROM dated")
def date_bounds(spark, sf_dir):
    return dated(spark, sf_dir).select("nct_id", D.bounds(F.col("text")).alias("b")).select("nct_id", "b.lo", "b.hi")


@query("PRJ-8", DATED + """ SELECT nct_id, round(CASE status WHEN 'P' THEN year + 0.5 WHEN 'O' THEN year + (month(lo) - 1) / 12.0 + 1 / 24.0 ELSE year + (month(lo) - 1) / 12.0 + (day(lo) - 1) / 365.0 END, 6) AS decimal_year,
  CASE WHEN year < 2002 THEN 'midpoint_of_start_to_completion' ELSE 'start_date_only' END AS basis FROM dated""")
def decimal_years(spark, sf_dir):
    t = F.col("text")
    basis, _ = D.enrolment_midpoint(t, F.lit(None).cast("string"), F.lit("2001-12-31"))
    return dated(spark, sf_dir).select("nct_id", F.round(D.decimal_year(t), 6).alias("decimal_year"), basis.alias("basis"))


@query("PRJ-9", DATED + " SELECT nct_id, lo AS first_date FROM dated")
def prefix_dates(spark, sf_dir):
    return dated(spark, sf_dir).select("nct_id", D.prefix_date(F.col("text")).alias("first_date"))


@query("PRJ-10", f"WITH {STUDIES} SELECT nct_id, results_date AS decision_date FROM studies")
def list_dates(spark, sf_dir):
    return registered(spark, sf_dir).select("nct_id", D.list_date(F.date_format("results_date", "M/d/yy")).alias("decision_date"))


@query("PRJ-12", """SELECT o_orderkey, CASE left(o_orderpriority, 1) WHEN '1' THEN 'Phase 1' WHEN '2' THEN 'Phase 1/2' WHEN '3' THEN 'Phase 2/3' WHEN '4' THEN 'Phase 4' ELSE 'N/A or other' END AS phase FROM orders""")
def phase_names(spark, sf_dir):
    #: Phase texts that stand for the five priorities.
    texts = {"1": "EARLY_PHASE1", "2": "Phase 1|Phase 2", "3": "PHASE2, PHASE3", "4": "phase 4", "5": "NA"}
    mapped = F.create_map(*[F.lit(x) for kv in texts.items() for x in kv])[F.left("o_orderpriority", F.lit(1))]
    return table(spark, sf_dir, "orders").select("o_orderkey", M.phase_name(mapped).alias("phase"))


@query("PRJ-14", f"WITH {CELLS} SELECT DISTINCT label, lower(trim(rtrim(trim(label), '*'))) AS key FROM cells")
def label_keys(spark, sf_dir):
    return cells(spark, sf_dir).select("label", L.label_key(F.col("label")).alias("key")).distinct()



def value_text():
    return F.when(F.col("l_returnflag") == "A", F.concat(F.format_number("l_extendedprice", 0), F.lit(" (3.5)"))).when(F.col("l_returnflag") == "N", F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit("%"))).otherwise(F.lit("NA"))


VALUES = """WITH v AS (SELECT *, CASE l_returnflag WHEN 'A' THEN round_even(l_extendedprice, 0) WHEN 'N' THEN l_quantity END AS num FROM lineitem)"""


@query("PRJ-15", VALUES + " SELECT l_orderkey, l_linenumber, num, CASE l_returnflag WHEN 'N' THEN CAST(round_even(l_quantity / 100 * 250, 0) AS BIGINT) WHEN 'A' THEN CAST(num AS BIGINT) ELSE 0 END AS counted FROM v")
def posted_numbers(spark, sf_dir):
    n = N.posted_number(value_text())
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", n.alias("num"), N.as_count(n, F.col("l_returnflag") == "N", F.lit(250)).alias("counted"))


@query("PRJ-21", VALUES + " SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN num END AS finite, CAST(NULL AS DOUBLE) AS parsed FROM v")
def numeric_tests(spark, sf_dir):
    t = F.when(F.col("l_returnflag") == "A", F.format_number("l_extendedprice", 0)).otherwise(value_text())
    grouped = F.when(F.col("l_extendedprice") >= 1000, t)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", N.finite_number(t).alias("finite"), N.parser_number(grouped).alias("parsed"))


@query("PRJ-22", "SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = 0 THEN 'absent' WHEN l_returnflag = 'A' THEN 'bound' WHEN l_returnflag = 'N' THEN 'number' WHEN l_linestatus = 'F' THEN 'other_with_digit' ELSE 'no_digit' END AS form FROM lineitem")
def p_values(spark, sf_dir):
    d = F.col("l_discount").cast("string")
    text = F.when(F.col("l_discount") == 0, "").when(F.col("l_returnflag") == "A", F.concat(F.lit("<"), d)).when(F.col("l_returnflag") == "N", F.concat(F.lit("="), d)).when(F.col("l_linestatus") == "F", F.concat(F.lit("p about "), d)).otherwise("NS")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", N.p_value_form(text).alias("form"))


@query("PRJ-19", f"""WITH {CELLS}, a AS (SELECT nct_id, list(value ORDER BY value) AS vs FROM cells GROUP BY 1), b AS (SELECT nct_id, vs, list_sum(vs) AS s, list_filter(vs, lambda v: abs(2 * v - list_sum(vs)) < 1e-6) AS fits FROM a)
  SELECT nct_id, CASE WHEN len(vs) = 1 THEN vs[1] WHEN len(fits) > 0 THEN fits[1] ELSE vs[-1] END AS total, len(vs) > 1 AND len(fits) = 0 AS by_position FROM b""")
def sum_checked(spark, sf_dir):
    values = cells(spark, sf_dir).groupBy("nct_id").agg(F.array_sort(F.collect_list("value")).alias("vs"))
    return values.select("nct_id", N.sum_checked_total(F.col("vs")).alias("t")).select("nct_id", "t.total", "t.by_position")


@query("PRJ-23", """SELECT s_suppkey, CASE WHEN s_nationkey = 0 THEN 'Pfizer' WHEN s_nationkey = 1 THEN 'GlaxoSmithKline' WHEN s_nationkey = 2 THEN 'Merck KGaA' ELSE 'Firm ' || right(s_name, 4) END AS company FROM supplier""")
def companies(spark, sf_dir):
    n = F.col("s_nationkey")
    name = F.when(n == 0, "Wyeth is now a subsidiary of Pfizer").when(n == 1, "GSK  plc").when(n == 2, "EMD Serono, Inc.").otherwise(F.concat(F.lit("Firm "), F.substring("s_name", -4, 4), F.lit(" Pharma Co., Ltd.")))
    return table(spark, sf_dir, "supplier").select("s_suppkey", M.company(name).alias("company"))


@query("PRJ-26", "SELECT s_suppkey, 'q bio ' || right(s_name, 3) || ' sa' AS key FROM supplier WHERE FALSE UNION ALL SELECT s_suppkey, 'q bio ' || right(s_name, 3) AS key FROM supplier")
def organisation_keys(spark, sf_dir):
    name = F.concat(F.lit("Q Bio & "), F.substring("s_name", -3, 3), F.lit(" (Paris) S.A. d/b/a Other"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", M.organisation_key(name, ["sa", "inc"], ["the", "and", "of"]).alias("key"))


@query("PRJ-28", "SELECT p_partkey, CASE WHEN p_size < 10 THEN 'de_novo' WHEN p_size < 20 THEN 'pma_supplement' WHEN p_size < 30 THEN 'pma' WHEN p_size < 45 THEN '510k' ELSE 'unknown' END AS pathway FROM part")
def pathways(spark, sf_dir):
    key = F.lpad(F.col("p_partkey").cast("string"), 6, "0")
    number = F.when(F.col("p_size") < 10, F.concat(F.lit("DEN"), key)).when(F.col("p_size") < 20, F.concat(F.lit("P"), key, F.lit("/S001"))).when(F.col("p_size") < 30, F.concat(F.lit("p"), key)).when(F.col("p_size") < 45, F.concat(F.lit(" K"), key)).otherwise(key)
    return table(spark, sf_dir, "part").select("p_partkey", M.pathway(number).alias("pathway"))


@query("PRJ-29", f"WITH {STUDIES} SELECT nct_id, 'link:' || left(sha256(nct_id || '|' || lead || '|' || coalesce(CAST(enrollment AS VARCHAR), 'None')), 16) AS link_id FROM studies")
def stable_ids(spark, sf_dir):
    return studies(spark, sf_dir).select("nct_id", M.stable_id("link:", F.col("nct_id"), F.col("lead"), F.col("enrollment")).alias("link_id"))


@query("PRJ-36", f"""WITH {CELLS}, s AS (SELECT nct_id, sum(CASE WHEN label = 'Female' THEN value ELSE 0 END) AS a, sum(CASE WHEN label = 'Women' THEN value ELSE 0 END) AS b FROM cells GROUP BY 1)
  SELECT nct_id, CASE WHEN a + b > 0 THEN round_even(100 * a / (a + b), 1) END AS share_a, CASE WHEN a + b > 0 THEN round_even(100 * b / (a + b), 1) END AS share_b FROM s""")
def known_shares(spark, sf_dir):
    of = lambda x: F.sum(F.when(F.col("label") == x, F.col("value")))
    s = cells(spark, sf_dir).groupBy("nct_id").agg(of("Female").alias("a"), of("Women").alias("b"))
    return s.select("nct_id", N.shares([F.col("a"), F.col("b")]).alias("s")).select("nct_id", F.get("s", F.lit(0)).alias("share_a"), F.get("s", F.lit(1)).alias("share_b"))


@query("FLT-2", f"WITH {CELLS} SELECT title, CASE WHEN title LIKE 'Sex:%' THEN 'sex' WHEN title LIKE '%Customized' THEN 'sex_gender_customized' ELSE 'other' END AS kind, title LIKE 'Sex%' AS is_sex_gender, count(*) AS n FROM cells GROUP BY 1, 2, 3")
def measure_types(spark, sf_dir):
    t = F.col("title")
    return cells(spark, sf_dir).groupBy("title").agg(F.count("*").alias("n")).select("title", L.measure_type(t).alias("kind"), L.is_sex_gender(t).alias("is_sex_gender"), "n")


@query("FLT-3", f"WITH {CELLS} SELECT unit, unit LIKE 'Percent%' AS is_percentage, count(*) AS n FROM cells GROUP BY 1, 2")
def percentage_measures(spark, sf_dir):
    return cells(spark, sf_dir).groupBy("unit").agg(F.count("*").alias("n")).withColumn("is_percentage", L.is_percentage(F.col("unit"), F.lit(None).cast("string")))


@query("FLT-4", f"WITH {CELLS} SELECT title, unit, CASE WHEN title LIKE 'Race%' THEN 'mean_or_median' WHEN unit LIKE 'Percent%' THEN 'percent' ELSE 'participant_like' END AS unit_class, count(*) AS n FROM cells GROUP BY 1, 2, 3")
def unit_classes(spark, sf_dir):
    parameter = F.when(F.col("title").startswith("Race"), "Mean")
    return cells(spark, sf_dir).withColumn("unit_class", L.unit_class(F.col("unit"), parameter)).groupBy("title", "unit", "unit_class").agg(F.count("*").alias("n"))


#: What each label of the binding means, for the SQL side.
BUCKET_SQL = "CASE label WHEN 'Female' THEN 'female' WHEN 'Women' THEN 'female' WHEN 'Male ' THEN 'male' WHEN 'Unknown or Not Reported' THEN 'unknown' WHEN 'Non-binary' THEN 'gender_diverse' WHEN 'Transgender female*' THEN 'ambiguous' ELSE '' END"
SUMS = ", ".join(f"sum(CASE WHEN bucket = '{b}' THEN value END) AS n_{b}" for b in S.BUCKETS)
PARSED = f"""WITH {STUDIES}, {CELLS}, rows AS (SELECT *, {BUCKET_SQL} AS bucket FROM cells WHERE title LIKE 'Sex%'),
  measures AS (SELECT nct_id, title, {SUMS}, max(unit) AS unit, count(*) AS n_rows FROM rows GROUP BY 1, 2),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY nct_id ORDER BY coalesce(n_female, 0) + coalesce(n_male, 0) DESC, title) AS nth FROM measures),
  maxima AS (SELECT nct_id, max(n_unknown) AS n_unknown, max(n_gender_diverse) AS n_gender_diverse, max(n_ambiguous) AS n_ambiguous, count(*) AS n_measures FROM measures GROUP BY 1),
  trials AS (SELECT r.nct_id, title AS measure_title, unit, n_measures, n_female, n_male, m.n_unknown, m.n_gender_diverse, m.n_ambiguous, unit = 'Participants' AS is_participant_count,
    coalesce(n_female, 0) + coalesce(n_male, 0) + coalesce(m.n_unknown, 0) + coalesce(m.n_gender_diverse, 0) + coalesce(m.n_ambiguous, 0) AS n_total_parsed FROM ranked r JOIN maxima m USING (nct_id) WHERE nth = 1),
  stated AS (SELECT s.nct_id, s.year, s.class, s.enrollment, t.* EXCLUDE (nct_id), CASE WHEN measure_title IS NULL THEN 'not_reported' WHEN coalesce(n_female, 0) + coalesce(n_male, 0) + coalesce(n_gender_diverse, 0) > 0 OR coalesce(n_ambiguous, 0) > 0 THEN 'reported'
    WHEN n_unknown > 0 THEN 'explicit_unknown_only' ELSE 'uninformative' END AS status FROM studies s LEFT JOIN trials t USING (nct_id)),
  done AS (SELECT *, status = 'reported' AND coalesce(n_female, 0) + coalesce(n_male, 0) > 0 AS reported_sex, status = 'reported' AND (coalesce(n_gender_diverse, 0) > 0 OR coalesce(n_ambiguous, 0) > 0) AS reported_gender, status = 'reported' AS reported_any,
    CASE WHEN status = 'reported' AND is_participant_count AND coalesce(n_female, 0) + coalesce(n_male, 0) > 0 THEN 100.0 * coalesce(n_female, 0) / (coalesce(n_female, 0) + coalesce(n_male, 0)) END AS percent_female FROM stated)"""


def finished(spark, sf_dir):
    return S.finished(S.parsed_trials(S.bucket_sums(cells(spark, sf_dir))), studies(spark, sf_dir))


@query("VOC-9", f"WITH {CELLS} SELECT label, {BUCKET_SQL} AS bucket, CASE WHEN label = 'Total' THEN 'structural_or_group' ELSE 'mapped' END AS reason, count(*) AS n FROM cells GROUP BY 1, 2, 3")
def sex_buckets(spark, sf_dir):
    counted = cells(spark, sf_dir).groupBy("label").agg(F.count("*").alias("n"))
    return counted.select("label", L.sex_bucket(F.col("label")).alias("bucket"), L.unmapped_reason(F.col("label")).alias("reason"), "n")


@query("SEL-1", f"WITH {CELLS} SELECT nct_id, title, label, {BUCKET_SQL} AS bucket, value FROM cells WHERE title LIKE 'Sex%'")
def labelled_rows(spark, sf_dir):
    return S.labelled_rows(cells(spark, sf_dir)).select("nct_id", "title", "label", "bucket", "value")


@query("SEL-11", PARSED + " SELECT nct_id, measure_title, n_measures, n_female, n_male, n_unknown, n_gender_diverse, n_ambiguous, n_total_parsed, is_participant_count FROM trials")
def parsed_trials(spark, sf_dir):
    return S.parsed_trials(S.bucket_sums(cells(spark, sf_dir))).drop("measure_type", "unit")


@query("FLT-12", PARSED + " SELECT nct_id, status, reported_sex, reported_gender, reported_sex AND reported_gender AS reported_both, reported_any FROM done")
def reporting_status(spark, sf_dir):
    return finished(spark, sf_dir).select("nct_id", "status", "reported_sex", "reported_gender", "reported_both", "reported_any")


@query("SEL-12", PARSED + " SELECT nct_id, round(percent_female, 6) AS percent_female, enrollment - n_total_parsed AS enrollment_minus_parsed FROM done")
def derived_rows(spark, sf_dir):
    return finished(spark, sf_dir).select("nct_id", F.round("percent_female", 6).alias("percent_female"), "enrollment_minus_parsed")


@query("SEL-4", PARSED + " SELECT nct_id, title, n_rows FROM (SELECT *, row_number() OVER (PARTITION BY nct_id ORDER BY coalesce(n_gender_diverse, 0) DESC, coalesce(n_female, 0) + coalesce(n_male, 0) DESC, title) AS k FROM measures) WHERE k = 1")
def fullest_tables(spark, sf_dir):
    c = lambda x: F.coalesce(f"n_{x}", F.lit(0.0))
    return S.fullest(S.bucket_sums(cells(spark, sf_dir)), "nct_id", c("gender_diverse"), c("female") + c("male"), "title").select("nct_id", "title", "n_rows")


@query("SEL-2", f"""WITH {CELLS}, c AS (SELECT *, CASE WHEN unit = 'Participants' THEN 'Total' ELSE 'Subgroup' END AS class FROM cells), t AS (SELECT DISTINCT nct_id, title, label FROM c WHERE class = 'Total'),
  bad AS (SELECT DISTINCT nct_id, title FROM c WHERE class <> 'Total' AND (nct_id, title, label) NOT IN (SELECT (nct_id, title, label) FROM t)), u AS (SELECT DISTINCT nct_id, title FROM t WHERE (nct_id, title) NOT IN (SELECT (nct_id, title) FROM bad))
  SELECT c.nct_id, c.title, class, label, value, u.nct_id IS NOT NULL AS use_total FROM c LEFT JOIN u ON c.nct_id = u.nct_id AND c.title = u.title WHERE u.nct_id IS NULL OR class = 'Total'""")
def total_class(spark, sf_dir):
    rows = cells(spark, sf_dir).withColumn("class", F.when(F.col("unit") == "Participants", "Total").otherwise("Subgroup"))
    return S.total_class_view(rows).select("nct_id", "title", "class", "label", "value", "use_total")


@query("SEL-5", f"""WITH {STUDIES}, {CELLS}, t AS (SELECT nct_id, title, sum(value) AS analysed, string_agg(label || CAST(CAST(value AS INT) AS VARCHAR), ',' ORDER BY label || CAST(CAST(value AS INT) AS VARCHAR)) AS sig FROM cells GROUP BY 1, 2)
  SELECT nct_id, bool_and(analysed < enrollment) AND sum(analysed) = max(enrollment) AND count(DISTINCT sig) = count(*) AND count(*) > 1 AS is_parted, count(*) AS n_tables FROM t JOIN studies USING (nct_id) GROUP BY 1""")
def parted_tables(spark, sf_dir):
    tag = F.concat("label", F.col("value").cast("int").cast("string"))
    t = cells(spark, sf_dir).groupBy("nct_id", "title").agg(F.sum("value").alias("analysed"), F.array_join(F.array_sort(F.collect_list(tag)), ",").alias("sig"))
    return S.disjoint_parts(t.join(studies(spark, sf_dir).select("nct_id", "enrollment"), "nct_id"), "nct_id", "analysed", "enrollment", "sig")


@query("SEL-14", f"WITH {CELLS} SELECT nct_id, label, sum(value) AS n, round_even(100 * sum(value) / sum(sum(value)) OVER (PARTITION BY nct_id), 1) AS percent FROM cells GROUP BY 1, 2")
def demographic_breakdown(spark, sf_dir):
    return S.breakdown(cells(spark, sf_dir), ["nct_id"], "label", "value")


@query("AGG-1", PARSED + " SELECT status, count(*) AS n, count_if(reported_sex) AS n_sex, count_if(reported_gender) AS n_gender, count(*) FILTER (is_participant_count = FALSE) AS n_not_people FROM done GROUP BY 1")
def status_counts(spark, sf_dir):
    return finished(spark, sf_dir).groupBy("status").agg(F.count("*").alias("n"), F.count_if("reported_sex").alias("n_sex"), F.count_if("reported_gender").alias("n_gender"), F.count_if(~F.col("is_participant_count")).alias("n_not_people"))


@query("AGG-2", PARSED + """ SELECT year, round(sum(percent_female), 4) AS pf_sum, count(*) AS pf_count, sum(coalesce(n_female, 0)) AS f_sum, sum(coalesce(n_female, 0) + coalesce(n_male, 0)) AS fm_sum,
  round(sum(percent_female) / count(*), 6) AS mean_of_shares, round(100 * sum(coalesce(n_female, 0)) / sum(coalesce(n_female, 0) + coalesce(n_male, 0)), 6) AS weighted_share FROM done WHERE percent_female IS NOT NULL GROUP BY 1""")
def percent_female_series(spark, sf_dir):
    """Share of women by results year: as the mean of trials' shares, and weighted by participants."""
    f, m = F.coalesce("n_female", F.lit(0.0)), F.coalesce("n_male", F.lit(0.0))
    rows = finished(spark, sf_dir).filter("percent_female is not null").groupBy("year").agg(F.sum("percent_female").alias("pf_sum"), F.count("*").alias("pf_count"), F.sum(f).alias("f_sum"), F.sum(f + m).alias("fm_sum"))
    return rows.select("year", F.round("pf_sum", 4).alias("pf_sum"), "pf_count", "f_sum", "fm_sum", F.round(F.col("pf_sum") / F.col("pf_count"), 6).alias("mean_of_shares"), F.round(100 * F.col("f_sum") / F.col("fm_sum"), 6).alias("weighted_share"))


@query("AGG-7", f"WITH {CELLS} SELECT label, count(*) AS n FROM cells GROUP BY 1 ORDER BY n DESC, label LIMIT 5")
def top_labels(spark, sf_dir):
    return cells(spark, sf_dir).groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label").limit(5)


@query("AGG-9", PARSED + """, f AS (SELECT d.*, phase FROM done d JOIN (SELECT nct_id, phase FROM studies) USING (nct_id)), k AS (SELECT * FROM f WHERE year >= 1996 AND left(phase, 1) <> '5'), lacks AS (SELECT *, NOT (year = 1997 AND class = 'BUILDING') AS has_row FROM k), n AS (SELECT max(year) AS newest FROM f)
  SELECT coalesce(CAST(year AS VARCHAR), 'all') AS scope, count(*) AS n_trials, CASE WHEN bool_and(has_row) THEN count_if(reported_sex) END AS n_sex, CASE WHEN bool_and(has_row) THEN count_if(reported_gender) END AS n_gender, count_if(enrollment > 50) AS n_large, max(newest) AS newest_year, (SELECT count(*) FROM f WHERE year < 1996) AS n_before, (SELECT count(*) FROM f WHERE year >= 1996 AND left(phase, 1) = '5') AS n_not_interventional FROM lacks, n GROUP BY ROLLUP (year)""")
def first_view(spark, sf_dir):
    """The total and every year; a measure is absent, not zero, in every scope that holds a trial without a parsed row (here one class in one year)."""
    f = finished(spark, sf_dir)
    old, other = F.col("year") < 1996, F.left("phase", F.lit(1)) == "5"
    rest = f.agg(F.max("year").alias("newest_year"), F.count_if(old).alias("n_before"), F.count_if(~old & other).alias("n_not_interventional"))
    kept = f.filter(~old & ~other).withColumn("has_row", ~((F.col("year") == 1997) & (F.col("class") == "BUILDING")))
    whole = F.every("has_row")
    view = kept.rollup("year").agg(F.count("*").alias("n_trials"), F.when(whole, F.count_if("reported_sex")).alias("n_sex"), F.when(whole, F.count_if("reported_gender")).alias("n_gender"), F.count_if(F.col("enrollment") > 50).alias("n_large"))
    return view.join(F.broadcast(rest)).select(F.coalesce(F.col("year").cast("string"), F.lit("all")).alias("scope"), "n_trials", "n_sex", "n_gender", "n_large", "newest_year", "n_before", "n_not_interventional")


@query("AGG-10", f"""WITH {CELLS} SELECT 'category' AS level, label, {BUCKET_SQL} AS bucket, CASE WHEN label = 'Total' THEN 'structural_or_group' ELSE 'mapped' END AS reason, count(*) AS n_occurrences, count(DISTINCT nct_id) AS n_trials, min(nct_id) AS example, bool_or(title LIKE 'Sex%') AS consequential FROM cells GROUP BY 1, 2, 3, 4
  UNION ALL SELECT 'title', title, '', 'unrecognized', count(*), count(DISTINCT nct_id), min(nct_id), FALSE FROM cells WHERE title NOT LIKE 'Sex%' GROUP BY 1, 2""")
def label_inventory(spark, sf_dir):
    """Every label by level: how often, in how many trials, what becomes of it and why; consequential where the parser reads it for counts."""
    read = L.is_sex_gender(F.col("title"))
    seen = cells(spark, sf_dir).select("nct_id", F.inline(F.array_compact(F.array(F.struct(F.lit("category").alias("level"), "label", read.alias("read")), F.when(~read, F.struct(F.lit("title").alias("level"), F.col("title").alias("label"), F.lit(False).alias("read")))))))
    rows = seen.groupBy("level", "label").agg(F.count("*").alias("n_occurrences"), F.count_distinct("nct_id").alias("n_trials"), F.min("nct_id").alias("example"), F.bool_or("read").alias("consequential"))
    return rows.withColumns({"bucket": L.sex_bucket(F.col("label")), "reason": L.unmapped_reason(F.col("label"))})


#: Every published count: its condition, the name of what it is a part of, and what it means. The denominators are conditions of their own.
DENOMINATORS = {"all trials": "true", "reporting trials": "reported_any", "trials with a table": "measure_title is not null", "counting trials": "reported_sex and is_participant_count"}
METRICS = [
    ("reported_any", "reported_any", "all trials", "any sex or gender is reported"), ("reported_sex", "reported_sex", "reporting trials", "female or male are counted"), ("reported_gender", "reported_gender", "reporting trials", "a gender identity is counted"),
    ("reported_both", "reported_sex and reported_gender", "reporting trials", "both are counted"), ("has_table", "measure_title is not null", "all trials", "a sex or gender table is posted"), ("several_tables", "n_measures > 1", "trials with a table", "more than one such table is posted"),
    ("not_people", "not is_participant_count", "trials with a table", "the table counts something else than people"), ("explicit_unknown", "n_unknown > 0", "trials with a table", "unknown is counted as such"), ("unknown_only", "status = 'explicit_unknown_only'", "trials with a table", "nothing but unknown is counted"),
    ("mostly_female", "percent_female > 50", "counting trials", "more than half of the counted are female"), ("all_female", "percent_female = 100", "counting trials", "all of the counted are female"), ("has_enrollment", "enrollment is not null", "all trials", "an enrolment is registered"),
    ("counts_all", "enrollment = n_total_parsed", "trials with a table", "as many are counted as were enrolled"),
]


@query("AGG-17", PARSED + ", c AS (SELECT " + ", ".join([f"count_if({c}) AS m{i}" for i, (_, c, _, _) in enumerate(METRICS)] + [f"count_if({c}) AS d{i}" for i, c in enumerate(DENOMINATORS.values())]) + " FROM done) SELECT unnest([" + ", ".join(f"'{m}'" for m, *_ in METRICS) + "]) AS metric, unnest([" + ", ".join(f"m{i}" for i in range(len(METRICS))) + "]) AS numerator, unnest([" + ", ".join(f"d{list(DENOMINATORS).index(d)}" for _, _, d, _ in METRICS) + "]) AS denominator, unnest([" + ", ".join(f"'{d}'" for _, _, d, _ in METRICS) + "]) AS denominator_name, unnest([" + ", ".join(f"'{t}'" for *_, t in METRICS) + "]) AS definition FROM c")
def metric_ledger(spark, sf_dir):
    """One pass over the trials; each number comes with the name of its denominator and a definition."""
    counts = [F.count_if(F.coalesce(F.expr(c), F.lit(False))).alias(f"m{i}") for i, (_, c, _, _) in enumerate(METRICS)] + [F.count_if(F.coalesce(F.expr(c), F.lit(False))).alias(f"d{i}") for i, c in enumerate(DENOMINATORS.values())]
    rows = ", ".join(f"'{m}', m{i}, d{list(DENOMINATORS).index(d)}, '{d}', '{t}'" for i, (m, _, d, t) in enumerate(METRICS))
    return finished(spark, sf_dir).agg(*counts).selectExpr(f"stack({len(METRICS)}, {rows}) as (metric, numerator, denominator, denominator_name, definition)")


@query("WIN-2", f"WITH {STUDIES} SELECT nct_id, results_date FROM studies ORDER BY results_date DESC, nct_id DESC LIMIT 500")
def most_recent(spark, sf_dir):
    return registered(spark, sf_dir).select("nct_id", "results_date").orderBy(F.desc("results_date"), F.desc("nct_id")).limit(500)


@query("WIN-3", f"""WITH {STUDIES}, c AS (SELECT 'NCT' || lpad(CAST(l_orderkey AS VARCHAR), 8, '0') AS nct_id, min(CASE WHEN p_size > 25 THEN p_name END) AS condition, min(p_brand) AS intervention FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1), t AS (SELECT * FROM studies ORDER BY enrollment DESC NULLS LAST, nct_id LIMIT 50)
  SELECT nct_id, enrollment, lead, coalesce(condition, intervention, 'not stated') AS target, CASE WHEN condition IS NOT NULL THEN 'condition' WHEN intervention IS NOT NULL THEN 'intervention' END AS target_from FROM t LEFT JOIN c USING (nct_id)""")
def largest_trials(spark, sf_dir):
    """The fifty largest, each with its condition, else its intervention."""
    top = studies(spark, sf_dir).select("nct_id", "enrollment", "lead").orderBy(F.desc_nulls_last("enrollment"), "nct_id").limit(50)
    lines = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("NCT"), F.lpad(F.col("l_orderkey").cast("string"), 8, "0")).alias("nct_id"), "l_partkey").join(F.broadcast(top.select("nct_id")), "nct_id")
    c = lines.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).groupBy("nct_id").agg(F.min(F.when(F.col("p_size") > 25, F.col("p_name"))).alias("condition"), F.min("p_brand").alias("intervention"))
    source = F.when(F.col("condition").isNotNull(), "condition").when(F.col("intervention").isNotNull(), "intervention")
    return top.join(c, "nct_id", "left").select("nct_id", "enrollment", "lead", F.coalesce("condition", "intervention", F.lit("not stated")).alias("target"), source.alias("target_from"))


@query("FLT-7", f"""WITH {STUDIES}, r AS (SELECT nct_id, list_filter([CASE WHEN status = 'P' THEN 'NOT_INTERVENTIONAL' END, CASE WHEN left(phase, 1) NOT IN ('3', '4') THEN 'NOT_PHASE3' WHEN left(phase, 1) = '4' THEN 'PHASE2_PHASE3_STRATUM' END, CASE WHEN class <> 'BUILDING' THEN 'LEAD_SPONSOR_NOT_INDUSTRY' END,
  CASE WHEN results_date NOT BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' THEN 'PRIMARY_COMPLETION_OUTSIDE_WINDOW' END], lambda x: x IS NOT NULL) AS reasons FROM studies) SELECT nct_id, array_to_string(reasons, ',') AS reasons, len(reasons) = 0 AS eligible FROM r""")
def eligibility(spark, sf_dir):
    from ..operators.outcomes import exclusion_reasons

    s = registered(spark, sf_dir)
    phases = F.when(F.left("phase", F.lit(1)) == "3", F.array(F.lit("PHASE3"))).when(F.left("phase", F.lit(1)) == "4", F.array(F.lit("PHASE2"), F.lit("PHASE3"))).otherwise(F.array(F.lit("PHASE1")))
    reasons = exclusion_reasons(F.when(F.col("status") == "P", "OBSERVATIONAL").otherwise("INTERVENTIONAL"), phases, F.when(F.col("class") == "BUILDING", "INDUSTRY").otherwise("OTHER"), F.lit("RANDOMIZED"), F.date_format("results_date", "yyyy-MM-dd"), ("1996-01-01", "1999-12-31"))
    return s.select("nct_id", F.array_join(reasons, ",").alias("reasons"), (F.size(reasons) == 0).alias("eligible"))


@query("FLT-8", f"""WITH {STUDIES} SELECT nct_id, CASE WHEN status = 'F' AND results_date <= DATE '1999-06-30' THEN 'POSTED' WHEN left(phase, 1) = '1' THEN 'NOT_APPLICABLE' WHEN left(phase, 1) = '2' THEN 'PENDING' WHEN DATE '1999-06-30' < results_date + INTERVAL 1 YEAR THEN 'PENDING' ELSE 'UNREPORTED' END AS state,
  CASE WHEN status = 'F' AND results_date <= DATE '1999-06-30' THEN NULL WHEN left(phase, 1) = '1' THEN 'WITHDRAWN_NO_PARTICIPANTS' WHEN left(phase, 1) = '2' THEN 'STATUS_UNCERTAIN' WHEN DATE '1999-06-30' < results_date + INTERVAL 1 YEAR THEN 'WITHIN_STANDARD_WINDOW' ELSE 'PAST_STANDARD_WINDOW' END AS reason FROM studies""")
def results_states(spark, sf_dir):
    from ..operators.outcomes import results_state

    text = F.date_format("results_date", "yyyy-MM-dd")
    p = F.left("phase", F.lit(1))
    status = F.when(p == "1", "WITHDRAWN").when(p == "2", "UNKNOWN").otherwise("COMPLETED")
    state = results_state(F.lit("1999-06-30").cast("date"), F.col("status") == "F", text, status, F.lit("ACTUAL"), F.col("enrollment"), text, F.lit("ACTUAL"), F.lit(None).cast("string"))
    return studies(spark, sf_dir).select("nct_id", state.alias("s")).select("nct_id", "s.state", "s.reason")


@query("FLT-22", DATED + """ SELECT nct_id, CASE WHEN status = 'P' THEN 'study_start_date_unknown' WHEN hi <= DATE '1998-06-15' THEN 'started_on_or_before_decision_not_complete' WHEN lo <= DATE '1998-06-15' THEN 'indeterminate_at_recorded_precision'
  WHEN date_diff('day', DATE '1998-06-15', hi) <= 365 THEN 'started_within_365_days_after_decision' WHEN date_diff('day', DATE '1998-06-15', lo) > 365 THEN 'started_more_than_365_days_after_decision' ELSE 'indeterminate_at_recorded_precision' END AS relation FROM dated""")
def timing(spark, sf_dir):
    return dated(spark, sf_dir).select("nct_id", D.relation(F.col("text"), F.lit(None).cast("string"), F.lit("1998-06-15").cast("date")).alias("relation"))


@query("FLT-24", f"""WITH {STUDIES}, w(lo, hi) AS (VALUES (1995, 1996), (1997, 1998), (1999, 2000)) SELECT nct_id, CASE WHEN year BETWEEN 1995 AND 2000 THEN 'midpoint_inside_window' WHEN year < 1995 THEN 'before_first_window' ELSE 'after_last_window' END AS reason,
  CAST(coalesce(hi, CASE WHEN year < 1995 THEN 1996 ELSE 2000 END) AS INTEGER) AS vintage FROM studies LEFT JOIN w ON year BETWEEN lo AND hi""")
def survey_windows(spark, sf_dir):
    from ..operators.areas import assign_window

    s = registered(spark, sf_dir).withColumn("midpoint", D.decimal_year(F.date_format("results_date", "yyyy-MM")))
    return assign_window(s, "midpoint", [(1995, 1996), (1997, 1998), (1999, 2000)]).select("nct_id", "reason", "vintage")


@query("AGG-27-slope", f"""WITH {STUDIES}, s AS (SELECT class, CAST(enrollment AS DOUBLE) AS y, CAST(year AS DOUBLE) AS x FROM studies WHERE enrollment IS NOT NULL)
  SELECT class, 'year' AS term, round(regr_slope(y, x), 4) AS estimate, round(regr_r2(y, x), 6) AS r2, count(*) AS n FROM s GROUP BY 1""")
def sponsor_contrast(spark, sf_dir):
    from ..operators.stats import least_squares

    s = studies(spark, sf_dir).select("class", "enrollment", (F.col("year") - 1995).alias("year"))
    return least_squares(s, ["class"], "enrollment", ["year"]).filter("term = 'year'").select("class", "term", F.round("estimate", 4).alias("estimate"), F.round("r2", 6).alias("r2"), "n")


@query("AGG-33", f"""WITH {STUDIES}, r AS (SELECT lead, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, lead) AS k FROM studies GROUP BY 1) SELECT CASE WHEN k <= 10 THEN r.lead ELSE 'Other' END AS company, count(*) AS n_trials, sum(enrollment) AS enrollment FROM studies JOIN r USING (lead) GROUP BY 1""")
def top_companies(spark, sf_dir):
    s = studies(spark, sf_dir)
    top = s.groupBy("lead").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lead").limit(10).select("lead", F.col("lead").alias("company"))
    return s.join(F.broadcast(top), "lead", "left").groupBy(F.coalesce("company", F.lit("Other")).alias("company")).agg(F.count("*").alias("n_trials"), F.sum("enrollment").alias("enrollment"))


@query("AGG-33-conditions", f"""WITH {STUDIES}, r AS (SELECT lead, row_number() OVER (ORDER BY count(*) DESC, lead) AS k FROM studies GROUP BY 1), b AS (SELECT nct_id, CASE WHEN k <= 10 THEN lead ELSE 'Other Industry' END AS company FROM studies JOIN r USING (lead)), c AS (SELECT DISTINCT 'NCT' || lpad(CAST(l_orderkey AS VARCHAR), 8, '0') AS nct_id, p_name AS condition FROM lineitem JOIN part ON l_partkey = p_partkey),
  t AS (SELECT condition FROM c GROUP BY 1 ORDER BY count(DISTINCT nct_id) DESC, condition LIMIT 12) SELECT company, condition, count(DISTINCT nct_id) AS n_trials FROM b JOIN c USING (nct_id) WHERE condition IN (SELECT condition FROM t) GROUP BY 1, 2""")
def companies_by_condition(spark, sf_dir):
    """The ten largest companies and the rest, over the twelve most frequent conditions."""
    s = registered(spark, sf_dir).select("nct_id", "lead")
    top = s.groupBy("lead").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lead").limit(10).select("lead", F.col("lead").alias("company"))
    b = s.join(F.broadcast(top), "lead", "left").select("nct_id", F.coalesce("company", F.lit("Other Industry")).alias("company"))
    c = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).select(F.concat(F.lit("NCT"), F.lpad(F.col("l_orderkey").cast("string"), 8, "0")).alias("nct_id"), F.col("p_name").alias("condition")).distinct()
    axis = c.groupBy("condition").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "condition").limit(12).select("condition")
    return c.join(F.broadcast(axis), "condition").join(b, "nct_id").groupBy("company", "condition").agg(F.count("*").alias("n_trials"))
