"""Queries over evidence: payload leaves, site phrases, device forms, analyses, acquisitions, exports and searches."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import evidence as V
from ..functions.dates import prefix_date
from ..operators import selection as S
from ..operators import sponsors as P
from ..sources import folders as R
from ..sources.inventory import read_inventory
from .bindings import CELLS, STUDIES, cells, registered, studies, table
from .companies import KEYED, bridged
from .dimensions import _sql
from .registry import query
from .trials import PARSED, finished


#: Labels that stand for the parts by number, with the category that the written rules give each.
GENDER_LABELS = [
    ("Intersex", "intersex"), ("Gender diverse", "combined_gender_minority"), ("Transgender/non-binary", "combined_gender_minority"), ("Non-binary/transgender", "combined_gender_minority"), ("Transgender, nonbinary", "combined_gender_minority"), ("Sexual or gender minority", "combined_gender_minority"),
    ("TGNCNB", "combined_gender_minority"), ("Transgender woman", "transgender_with_sex_term"), ("Trans-masculine", "transgender_no_sex_term"), ("Transgender", "transgender_no_sex_term"), ("Trandgender male", "transgender_with_sex_term"), ("Cisgender man", "cisgender_labeled"), ("Cis-woman", "cisgender_labeled"),
    ("Questioning", "questioning"), ("Genderqueer", "nonbinary_gender_expansive"), ("Non-conforming", "nonbinary_gender_expansive"), ("Two-Spirit", "nonbinary_gender_expansive"), ("More than one gender", "nonbinary_gender_expansive"), ("Agender", "nonbinary_gender_expansive"), ("Gender different from sex assigned at birth", "nonbinary_gender_expansive"),
    ("Other", "another_self_described"), ("Identify in another way", "another_self_described"), ("None of these", "another_self_described"), ("Prefer to self-describe", "another_self_described"), ("Something else", "another_self_described"), ("Do not identify as any", "another_self_described"), ("Diverse", "another_self_described"),
    ("Prefer not to answer", "explicit_unknown_declined"), ("Unknown", "explicit_unknown_declined"), ("Female", None), ("Men", None), ("Total", None), ("Bisexual", None), ("Cohort 3", None), ("", None),
]


@query("VOC-10", f"WITH gl{_sql(GENDER_LABELS, ('i', 'label', 'detail'))} SELECT label, detail, count(*) AS n FROM lineitem JOIN gl ON l_partkey % {len(GENDER_LABELS)} = i GROUP BY 1, 2")
def gender_details(spark, sf_dir):
    labels = F.array(*[F.lit(x[0]) for x in GENDER_LABELS])
    counted = table(spark, sf_dir, "lineitem").groupBy(F.get(labels, (F.col("l_partkey") % len(GENDER_LABELS)).cast("int")).alias("label")).agg(F.count("*").alias("n"))
    return counted.withColumn("detail", V.gender_detail(F.col("label")))


@query("FLT-10", "SELECT p_partkey, CASE WHEN p_size < 12 THEN 'self_described_single_site' WHEN p_size < 24 THEN 'text_indicates_multiple_sites' WHEN p_size < 36 THEN 'conflicting_text' ELSE 'one_listed_facility' END AS tier FROM part")
def site_tiers(spark, sf_dir):
    size = F.col("p_size")
    text = F.when(size < 12, F.concat(F.lit("A single-center study of "), "p_name")).when(size < 24, F.concat("p_name", F.lit(" at 12 participating sites"))).when(size < 36, "Single site arm of a multicentre trial").otherwise(F.concat(F.lit("injected at 2 sites: "), "p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", V.site_tier(text).alias("tier"))


@query("PRJ-34", "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN -1 ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k, event_id % 4 = 0 AS not_reported FROM events")
def payload_leaves(spark, sf_dir):
    """Some payloads wrap the value, some hold it bare, some say it was not reported."""
    k, m = F.get_json_object("props", "$.k"), F.col("event_id") % 4
    payload = F.when(m == 0, F.lit('{"k": {"value": "Not Reported"}}')).when(m == 1, F.concat(F.lit('{"k": {"value": '), k, F.lit(', "page": 3}}'))).otherwise(F.col("props"))
    value = V.leaf(payload, "$.k")
    return table(spark, sf_dir, "events").select("event_id", V.reported_count(value).alias("k"), V.is_not_reported(value).alias("not_reported"))


@query("FLT-25", "SELECT event_id, CASE event_id % 5 WHEN 0 THEN FALSE WHEN 1 THEN TRUE WHEN 2 THEN value <> 0 WHEN 3 THEN FALSE ELSE TRUE END AS reports, event_id % 5 = 1 AS strictly FROM events")
def overview_predicates(spark, sf_dir):
    m = F.col("event_id") % 5
    json = F.when(m == 0, "false").when(m == 1, "true").when(m == 2, F.col("value").cast("string")).when(m == 3, '""').otherwise("{}")
    return table(spark, sf_dir, "events").select("event_id", V.is_truthy(json).alias("reports"), (json == "true").alias("strictly"))


@query("PRJ-27", "SELECT p_partkey, p_name AS trimmed FROM part WHERE p_size < 25")
def device_forms(spark, sf_dir):
    name = F.when(F.col("p_size") < 25, F.concat("p_name", F.lit(" System (X-1) v2.1"))).otherwise(F.concat("p_brand", F.lit(" App")))
    full, trimmed = V.device_forms(name, F.regexp_replace("p_brand", "#", " "))
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(trimmed).alias("trimmed"))


@query("FLT-16", """SELECT l_orderkey, count(*) AS n_analyses, count_if(l_linenumber < 7 AND (l_returnflag <> 'R' OR l_linestatus = 'F')) AS n_usable, count_if(l_linenumber BETWEEN 2 AND 6 AND (l_returnflag <> 'R' OR l_linestatus = 'F')) AS n_between FROM lineitem GROUP BY 1""")
def usable_analyses(spark, sf_dir):
    r, s = F.col("l_returnflag"), F.col("l_linestatus")
    p = F.when(r == "A", F.concat(F.lit("<"), F.col("l_discount").cast("string"))).when(r == "N", F.col("l_tax").cast("string")).otherwise("NS")
    usable, between = V.analysis_usable(F.col("l_linenumber") < 7, F.col("l_linenumber"), p, F.col("l_quantity").cast("string"), F.lit("1.0"), F.when(s == "F", "2.0"))
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n_analyses"), F.count_if(usable).alias("n_usable"), F.count_if(between).alias("n_between"))


@query("PRJ-33", "SELECT l_orderkey, count(*) AS n_arms, sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS started, CASE WHEN count_if(l_returnflag = 'A') = 0 THEN 'no_STARTED_in_first_period' WHEN count_if(l_returnflag = 'N') = 0 THEN 'no_COMPLETED_in_first_period' ELSE 'ok' END AS reason FROM lineitem GROUP BY 1")
def first_period(spark, sf_dir):
    """Lines as milestones of the first period: A is started, N completed."""
    a, n = (F.count_if(F.col("l_returnflag") == x) for x in "AN")
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n_arms"), F.sum(F.when(F.col("l_returnflag") == "A", F.col("l_quantity"))).alias("started"), F.when(a == 0, "no_STARTED_in_first_period").when(n == 0, "no_COMPLETED_in_first_period").otherwise("ok").alias("reason"))


@query("PRJ-32", "SELECT l_orderkey, 'outcomeMeasures[' || (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1) || ']' AS path, l_partkey FROM lineitem")
def measure_paths(spark, sf_dir):
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    m = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(*order))).alias("m"))
    return m.select("l_orderkey", F.posexplode("m").alias("i", "x")).select("l_orderkey", F.format_string("outcomeMeasures[%d]", "i").alias("path"), "x.l_partkey")


@query("PRJ-31", "SELECT l_orderkey, count_if(l_returnflag = 'A') AS n_primary, count_if(l_returnflag = 'N') AS n_secondary, count_if(l_returnflag = 'R') AS n_other, bool_or(l_linestatus = 'F') AS has_protocol FROM lineitem GROUP BY 1")
def registered_outcomes(spark, sf_dir):
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_returnflag", "l_linestatus")).alias("o"))
    n = lambda x: F.size(F.filter("o", lambda o: o["l_returnflag"] == x)).cast("bigint")
    return g.select("l_orderkey", n("A").alias("n_primary"), n("N").alias("n_secondary"), n("R").alias("n_other"), F.exists("o", lambda o: o["l_linestatus"] == "F").alias("has_protocol"))


@query("PRJ-37", r"SELECT doc_id, CASE WHEN regexp_matches(text, '[^.!?]*Licensed[^.!?]*') THEN trim(regexp_replace(regexp_extract(text, '[^.!?]*Licensed[^.!?]*'), '\s+', ' ', 'g')) END AS sentence FROM documents")
def sentence_around(spark, sf_dir):
    found = V.sentence_of(F.col("text"), "Licensed")
    return table(spark, sf_dir, "documents").select("doc_id", F.trim(F.regexp_replace(found, r"\s+", " ")).alias("sentence"))


@query("SEL-3", f"WITH {CELLS}, c AS (SELECT nct_id, title, label, sum(value) AS n FROM cells GROUP BY 1, 2, 3), t AS (SELECT nct_id, title, min(n) AS lo, max(n) AS hi, count(*) AS k FROM c GROUP BY 1, 2), f AS (SELECT nct_id, sum(value) AS size FROM cells GROUP BY 1) SELECT nct_id, title, hi AS analysed, CASE WHEN lo = hi AND k >= 2 THEN lo ELSE size END AS denominator FROM t JOIN f USING (nct_id)")
def denominators(spark, sf_dir):
    """Number analysed: the largest a class posts; a percentage's denominator: what all classes agree on, else the baseline."""
    c = cells(spark, sf_dir).groupBy("nct_id", "title", "label").agg(F.sum("value").alias("n"))
    t = c.groupBy("nct_id", "title").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.count("*").alias("k"))
    size = cells(spark, sf_dir).groupBy("nct_id").agg(F.sum("value").alias("size"))
    return t.join(size, "nct_id").select("nct_id", "title", F.col("hi").alias("analysed"), F.when((F.col("lo") == F.col("hi")) & (F.col("k") >= 2), F.col("lo")).otherwise(F.col("size")).alias("denominator"))


@query("SEL-15", f"""WITH {CELLS}, n AS (SELECT count(DISTINCT nct_id) AS n FROM cells WHERE title LIKE 'Sex%'), f AS (SELECT count(DISTINCT nct_id) AS k FROM cells WHERE title LIKE 'Sex%' AND label <> 'Total' AND CAST(substr(nct_id, 4) AS INT) % 100 = 7)
  SELECT 'raw_rows' AS source, n AS n_trials, CAST(0 AS BIGINT) AS n_different FROM n UNION ALL SELECT 'envelopes', n, 0 FROM n UNION ALL SELECT 'faulty', n, k FROM n, f""")
def rebuilt_table(spark, sf_dir):
    """The table parsed from records, from raw rows and from versioned envelopes is the same; from a source with altered counts it is not."""
    columns = ["nct_id", "measure_title", "n_female", "n_male", "n_unknown", "n_total_parsed"]
    parsed = lambda x: S.parsed_trials(S.bucket_sums(x, known)).select(*columns)
    whole = cells(spark, sf_dir).select("nct_id", "title", "unit", "label", "value")
    raw, envelope = R.landing(spark, "raw"), R.landing(spark, "envelopes")
    R.write_lines(whole.filter(F.col("title").rlike("(?i)sex|gender")), raw)
    rows = F.collect_list(F.struct("label", "unit", "value"))
    R.write_lines(whole.repartition("nct_id").groupBy("nct_id", "title").agg(rows.alias("rows")).groupBy("nct_id").agg(F.lit("v1").alias("version"), F.collect_list(F.struct("title", "rows")).alias("measures")), envelope)
    from_raw = R.read_lines(spark, raw, "nct_id string, title string, unit string, label string, value double")[0]
    held = R.read_lines(spark, envelope, "nct_id string, version string, measures array<struct<title: string, rows: array<struct<label: string, unit: string, value: double>>>>")[0]
    from_envelope = held.filter("version = 'v1'").select("nct_id", F.inline("measures")).select("nct_id", "title", F.inline("rows"))
    faulty = whole.withColumn("value", F.col("value") + F.when(F.substring("nct_id", 4, 8).cast("int") % 100 == 7, 1000.0).otherwise(0.0))
    # lines are parsed once: the labels are those of the table, mostly; the four tables meet in one shuffle, by trial, and what a trial's rows differ in is counted there
    known, sources = S.label_buckets(whole), {"": whole, "raw_rows": from_raw, "envelopes": from_envelope, "faulty": faulty}
    every = None
    for name, source in sources.items():
        one = parsed(source).withColumn("source", F.lit(name))
        every = one if every is None else every.unionByName(one)
    rebuilt = [name for name in sources if name]
    n = lambda name: F.count_if(F.col("source") == name)
    alike = every.repartition("nct_id").groupBy(*columns).agg(n("").alias("want"), *[n(name).alias(name) for name in rebuilt])
    trials = alike.groupBy("nct_id").agg(*[F.sum(name).alias(name) for name in rebuilt], *[F.bool_or((F.col(name) != F.col("want")) & F.col("nct_id").isNotNull()).alias(f"{name}_differs") for name in rebuilt])
    counts = trials.agg(*[F.struct(F.coalesce(F.sum(name), F.lit(0)).alias("n_trials"), F.count_if(f"{name}_differs").alias("n_different")).alias(name) for name in rebuilt])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(name).alias("source"), f"{name}.n_trials", f"{name}.n_different") for name in rebuilt])))


@query("JN-3", KEYED + " SELECT nct_id, entity, canonical, role, CASE WHEN CAST(right(entity, 1) AS INT) < 5 THEN make_date(2000 + CAST(right(entity, 1) AS INT), 1, 1) END AS effective_date FROM bridge")
def acquisition_dates(spark, sf_dir):
    index = bridged(spark, sf_dir)
    digit = F.right("entity", F.lit(1)).cast("int")
    dates = index.select("entity", "canonical").distinct().select(F.upper("entity").alias("entity"), "canonical", prefix_date(F.when(digit < 5, F.concat((2000 + digit).cast("string"), F.lit("-01")))).alias("effective_date"), F.lit("a filing").alias("source"))
    return P.with_acquisitions(index, dates).select("nct_id", "entity", "canonical", "role", "effective_date")


@query("JN-7", KEYED + """, c AS (SELECT nct_id, list_sort(list(DISTINCT canonical)) AS cs FROM bridge GROUP BY 1) SELECT s.nct_id, 'Group ' || left(right(s.lead, 2), 1) AS recoded, CASE WHEN cs IS NULL THEN 'recode_only' WHEN list_contains(cs, 'Group ' || left(right(s.lead, 2), 1)) THEN 'agree' ELSE 'differ' END AS state FROM studies s LEFT JOIN c USING (nct_id)""")
def curated_vs_recode(spark, sf_dir):
    c = bridged(spark, sf_dir).groupBy("nct_id").agg(F.collect_set("canonical").alias("cs"))
    recoded = F.concat(F.lit("Group "), F.substring("lead", -2, 1))
    return registered(spark, sf_dir).join(c, "nct_id", "left").select("nct_id", recoded.alias("recoded"), F.when(F.col("cs").isNull(), "recode_only").when(F.array_contains("cs", recoded), "agree").otherwise("differ").alias("state"))


@query("JN-16-pages", """WITH t AS (SELECT page_id, unnest(regexp_extract_all(url, '[0-9]+')) AS number FROM pages), k AS (SELECT CAST(p_partkey AS VARCHAR) AS number FROM part) SELECT page_id, number, count(*) AS n FROM t JOIN k USING (number) GROUP BY 1, 2""")
def located_numbers(spark, sf_dir):
    tokens = table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("url", F.lit("[0-9]+"), F.lit(0))).alias("number"))
    known = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("number"))
    return tokens.join(known, "number").groupBy("page_id", "number").agg(F.count("*").alias("n"))


@query("JN-25", "SELECT l.doc_id, source, quality FROM labels l JOIN documents d USING (doc_id)")
def observations(spark, sf_dir):
    """Labels on documents; a label of a document that is not held would be refused."""
    l, d = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents").select("doc_id", "source")
    unheld = l.join(d, "doc_id", "left_anti")
    return l.join(d, "doc_id").select("doc_id", "source", "quality").unionByName(unheld.select("doc_id", F.raise_error(F.lit("a label of a document that is not held")).cast("string").alias("source"), "quality"))


@query("FLT-27", "SELECT user_id, count(*) AS expected, count_if(value > 1) AS answered, CASE WHEN count_if(value > 1) < count(*) THEN 'incomplete_request_unanswered' WHEN count_if(value > 2) < count_if(value > 1) THEN 'incomplete_count_not_stated' ELSE 'completed' END AS state FROM events GROUP BY 1")
def search_states(spark, sf_dir):
    e, a, c = F.count("*"), F.count_if(F.col("value") > 1), F.count_if(F.col("value") > 2)
    return table(spark, sf_dir, "events").groupBy("user_id").agg(e.alias("expected"), a.alias("answered"), V.search_state(e, a, c).alias("state"))


@query("DQ-7", "SELECT event_id, problem FROM (SELECT event_id, unnest(list_filter([CASE WHEN value < 0.5 THEN 'revision_not_positive' END, CASE WHEN event_type = 'error' THEN 'status_not_released' END, CASE WHEN json_extract_string(props, '$.k') IS NULL THEN 'payload_missing' END], lambda x: x IS NOT NULL)) AS problem FROM events)")
def export_problems(spark, sf_dir):
    found = F.array_compact(F.array(F.when(F.col("value") < 0.5, "revision_not_positive"), F.when(F.col("event_type") == "error", "status_not_released"), F.when(F.get_json_object("props", "$.k").isNull(), "payload_missing")))
    return table(spark, sf_dir, "events").select("event_id", F.explode(found).alias("problem"))


@query("AGG-6", PARSED + " SELECT coalesce(CAST(year AS VARCHAR), 'all') AS scope, status, count(*) AS n, sum(n_total_parsed) AS people FROM done GROUP BY GROUPING SETS ((year, status), (status))")
def sex_gender_summary(spark, sf_dir):
    rows = finished(spark, sf_dir).groupingSets([["year", "status"], ["status"]], "year", "status").agg(F.count("*").alias("n"), F.sum("n_total_parsed").alias("people"))
    return rows.select(F.coalesce(F.col("year").cast("string"), F.lit("all")).alias("scope"), "status", "n", "people")


@query("AGG-34", f"WITH {STUDIES} SELECT nation, CASE WHEN enrollment IS NULL THEN 'unknown' WHEN enrollment < 100 THEN 'small' ELSE 'large' END AS tier, count(*) AS n, count_if(status = 'F') AS n_final FROM studies GROUP BY 1, 2")
def area_summary(spark, sf_dir):
    tier = F.when(F.col("enrollment").isNull(), "unknown").when(F.col("enrollment") < 100, "small").otherwise("large")
    return studies(spark, sf_dir).groupBy("nation", tier.alias("tier")).agg(F.count("*").alias("n"), F.count_if(F.col("status") == "F").alias("n_final"))


@query("SRC-7", f"WITH {STUDIES} SELECT row_number() OVER (ORDER BY nct_id) AS row_number, nct_id, lead FROM studies")
def numbered_rows(spark, sf_dir):
    path = R.landing(spark, "inventory")
    registered(spark, sf_dir).select("nct_id", "lead").write.option("header", True).csv(path)
    rows = R.numbered(R.read_delimited(spark, path, ["nct_id", "lead"], ","), ["nct_id"])
    return rows.select((F.col("position") + 1).cast("bigint").alias("row_number"), "nct_id", "lead")


@query("SRC-7-file", f"WITH {STUDIES} SELECT row_number() OVER (ORDER BY md5(nct_id)) AS row_number, nct_id, lead FROM studies")
def numbered_lines(spark, sf_dir):
    """An inventory in an order that no column tells: its rows are numbered by where they stand in its files."""
    path = R.landing(spark, "inventory")
    registered(spark, sf_dir).select("nct_id", "lead").orderBy(F.md5("nct_id")).write.option("header", True).csv(path)
    return read_inventory(spark, path, ["nct_id", "lead"]).select(F.col("position").alias("row_number"), "nct_id", "lead")


@query("SRC-9", f"WITH {STUDIES}, {CELLS}, m AS (SELECT nct_id, list_sort(list(DISTINCT title)) AS titles FROM cells WHERE title LIKE 'Sex%' GROUP BY 1) SELECT nct_id, enrollment, coalesce(array_to_string(titles, ';'), '') AS measures FROM studies LEFT JOIN m USING (nct_id)")
def raw_measure_rows(spark, sf_dir):
    """Selected measures of every trial; one without any keeps an empty list."""
    m = cells(spark, sf_dir).groupBy("nct_id").agg(F.array_sort(F.collect_set("title")).alias("titles"))
    picked = F.filter(F.coalesce("titles", F.array().cast("array<string>")), lambda t: t.rlike("(?i)sex|gender"))
    return studies(spark, sf_dir).join(m, "nct_id", "left").select("nct_id", "enrollment", F.array_join(picked, ";").alias("measures"))


@query("SRC-10", f"WITH {CELLS}, d AS (SELECT DISTINCT nct_id, title FROM cells), p AS (SELECT nct_id, title, row_number() OVER (PARTITION BY nct_id ORDER BY title) - 1 AS position FROM d) SELECT nct_id, title, CAST(position AS INTEGER) AS position, 'v1' AS version FROM p WHERE title LIKE 'Sex%'")
def raw_envelopes(spark, sf_dir):
    """Selected measures with their positions among all measures of the trial."""
    m = cells(spark, sf_dir).groupBy("nct_id").agg(F.array_sort(F.collect_set("title")).alias("t"))
    kept = F.filter(F.transform("t", lambda x, i: F.struct(x.alias("title"), i.cast("int").alias("position"))), lambda x: x["title"].rlike("(?i)sex|gender"))
    return m.select("nct_id", F.explode(kept).alias("x")).select("nct_id", "x.title", "x.position", F.lit("v1").alias("version"))


@query("SRC-11", "SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'no_derived' WHEN 1 THEN 'no_module' WHEN 2 THEN 'malformed' WHEN 3 THEN 'not_indexed' ELSE 'indexed' END AS state FROM events")
def mesh_states(spark, sf_dir):
    """A key that is missing is not a key that holds null."""
    from ..sources.mesh import mesh_state

    k, m = F.get_json_object("props", "$.k"), F.col("event_id") % 5
    doc = F.when(m == 0, "{}").when(m == 1, '{"derivedSection": {}}').when(m == 2, '{"derivedSection": {"conditionBrowseModule": null}}').when(m == 3, '{"derivedSection": {"conditionBrowseModule": {"meshes": []}}}').otherwise(F.concat(F.lit('{"derivedSection": {"conditionBrowseModule": {"meshes": [{"id": "D'), k, F.lit('", "term": "x"}]}}}')))
    return table(spark, sf_dir, "events").select("event_id", mesh_state(doc).alias("state"))

