"""Queries that flatten, assemble and split whole records, and that read the remaining label forms."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import race as E
from ..functions.evidence import reported_count
from ..functions.labels import label_key
from ..operators import blocks as B
from ..operators import selection as S
from ..sources import folders as R
from .bindings import CELLS, STUDIES, cells, registered, studies, table
from .dimensions import ETHNIC_LABELS, _sql
from .registry import query
from .trials import PARSED, finished

NCT = "'NCT' || lpad(CAST({} AS VARCHAR), 8, '0')"


def nct(column: str):
    return F.concat(F.lit("NCT"), F.lpad(F.col(column).cast("string"), 8, "0"))


CONTAINER = 1000


def contained(records, size=CONTAINER):
    """class, data: the records of a class in arrays of at most `size`, whatever the size of the class."""
    placed = R.numbered(records.select("class", "nct_id", "lead", "enrollment"), ["nct_id"]).withColumn("part", F.floor(F.col("position") / size))
    return placed.groupBy("class", "part").agg(F.collect_list(F.struct("nct_id", "lead", "enrollment")).alias("data"))


@query("SRC-2", f"WITH {STUDIES} SELECT nct_id, lead, enrollment, 'run-1' AS extracted_at FROM studies")
def record_container(spark, sf_dir):
    """Each container holds its stamp and an array of at most CONTAINER records; the records come out one row each, stamped."""
    path = R.landing(spark, "container")
    contained(studies(spark, sf_dir)).select(F.lit("run-1").alias("extracted_at"), "data").write.json(path)
    return spark.read.schema("extracted_at string, data array<struct<nct_id: string, lead: string, enrollment: long>>").json(path).select("extracted_at", F.inline("data"))


@query("PRJ-1", f"WITH {STUDIES} SELECT nct_id, lead AS lead_sponsor_name, coalesce(class, 'OTHER') AS sponsor_class, coalesce(enrollment, 0) AS enrollment, CASE WHEN status = 'P' THEN 'N/A' ELSE 'RANDOMIZED' END AS allocation, coalesce(strftime(results_date, '%Y-%m-%d'), '') AS results_date FROM studies")
def flat_metadata(spark, sf_dir):
    """A nested study flattened, each field with its stated default."""
    s = studies(spark, sf_dir).select(F.struct(F.struct("nct_id").alias("identification"), F.struct("lead", "class").alias("sponsor"), F.struct("enrollment", F.when(F.col("status") != "P", "RANDOMIZED").alias("allocation")).alias("design"), F.struct(F.date_format("results_date", "yyyy-MM-dd").alias("results")).alias("status")).alias("p"))
    return s.select(
        "p.identification.nct_id", F.col("p.sponsor.lead").alias("lead_sponsor_name"), F.coalesce("p.sponsor.class", F.lit("OTHER")).alias("sponsor_class"), F.coalesce("p.design.enrollment", F.lit(0)).alias("enrollment"),
        F.coalesce("p.design.allocation", F.lit("N/A")).alias("allocation"), F.coalesce("p.status.results", F.lit("")).alias("results_date"),
    )


@query("PRJ-30", f"WITH {STUDIES}, h AS (SELECT {NCT.format('l_orderkey')} AS nct_id, count(DISTINCT l_suppkey) AS n_sites, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1) SELECT nct_id, class AS sponsor_class, coalesce(n_sites, 0) AS n_sites, CAST(last_ship AS DATE) AS completed FROM studies LEFT JOIN h USING (nct_id)")
def study_facts(spark, sf_dir):
    h = table(spark, sf_dir, "lineitem").groupBy(nct("l_orderkey").alias("nct_id")).agg(F.count_distinct("l_suppkey").alias("n_sites"), F.max(F.to_date("l_shipdate")).alias("completed"))
    return registered(spark, sf_dir).join(h, "nct_id", "left").select("nct_id", F.col("class").alias("sponsor_class"), F.coalesce("n_sites", F.lit(0)).alias("n_sites"), "completed")


@query("PRJ-35", "SELECT c_custkey, CAST(CASE WHEN c_acctbal > 0 THEN floor(c_acctbal / 100) ELSE -1 END AS INTEGER) AS white, CAST(CASE WHEN c_nationkey % 3 = 0 THEN -1 WHEN c_nationkey % 3 = 1 THEN c_nationkey ELSE c_nationkey + 7 END AS INTEGER) AS other FROM customer")
def race_buckets(spark, sf_dir):
    """Islander and multiracial counts fold into other; only where both are missing is other not reported."""
    m, n = F.col("c_nationkey") % 3, F.col("c_nationkey").cast("string")
    white = reported_count(F.when(F.col("c_acctbal") > 0, F.floor(F.col("c_acctbal") / 100).cast("string")))
    islander, several = reported_count(F.when(m == 0, "Not Reported").otherwise(n)), reported_count(F.when(m == 2, "7").otherwise("-1"))
    other = F.when((islander < 0) & (several < 0), -1).otherwise(F.greatest(islander, F.lit(0)) + F.greatest(several, F.lit(0)))
    return table(spark, sf_dir, "customer").select("c_custkey", white.cast("int").alias("white"), other.cast("int").alias("other"))


@query("PRJ-38", "SELECT event_id, json_extract_string(props, '$.k') AS text FROM events")
def text_at_path(spark, sf_dir):
    doc = F.try_parse_json(F.concat(F.lit('{"a": {"b": [{"c": '), F.get_json_object("props", "$.k"), F.lit("}]}}")))
    return table(spark, sf_dir, "events").select("event_id", F.try_variant_get(doc, "$.a.b[0].c", "string").alias("text"))


@query("PRJ-39", PARSED + " SELECT nct_id, year, status, n_female, n_male FROM done WHERE status = 'reported'")
def lean_rows(spark, sf_dir):
    return finished(spark, sf_dir).filter("status = 'reported'").select("nct_id", "year", "status", "n_female", "n_male")


@query("PRJ-41", "SELECT l_orderkey, count_if(l_returnflag = 'A') AS n_references, count_if(l_returnflag = 'A' AND l_linestatus = 'F') AS n_results, bool_or(l_returnflag = 'N') AS states_gender FROM lineitem GROUP BY 1")
def references(spark, sf_dir):
    """References with an identifier only; an eligibility field that is not stated stays null."""
    ref = F.struct(F.when(F.col("l_returnflag") == "A", F.col("l_partkey")).alias("pmid"), F.when(F.col("l_linestatus") == "F", "RESULT").otherwise("BACKGROUND").alias("type"), (F.col("l_returnflag") == "N").alias("g"))
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(ref).alias("r"))
    kept = F.filter("r", lambda x: x["pmid"].isNotNull())
    return g.select("l_orderkey", F.size(kept).cast("bigint").alias("n_references"), F.size(F.filter(kept, lambda x: x["type"] == "RESULT")).cast("bigint").alias("n_results"), F.exists("r", lambda x: x["g"]).alias("states_gender"))


@query("PRJ-43", "WITH d AS (SELECT reason, row_number() OVER (ORDER BY reason) - 1 AS code FROM (SELECT DISTINCT p_type AS reason FROM part)) SELECT p_partkey, CAST(code AS INTEGER) AS code, CASE WHEN p_size < 10 THEN 'identifier' WHEN p_size < 30 THEN 'name_and_organisation' ELSE 'name' END AS kind FROM part JOIN d ON p_type = reason")
def publish_cut(spark, sf_dir):
    """Reasons become indices into a dictionary of the distinct ones."""
    p = table(spark, sf_dir, "part")
    codes = p.select("p_type").distinct().withColumn("code", F.row_number().over(Window.orderBy("p_type")) - 1)  # over a closed vocabulary
    return p.join(codes, "p_type").select("p_partkey", F.col("code").cast("int").alias("code"), F.when(F.col("p_size") < 10, "identifier").when(F.col("p_size") < 30, "name_and_organisation").otherwise("name").alias("kind"))


@query("FLT-11", PARSED + " SELECT nct_id, CASE WHEN measure_title IS NOT NULL AND n_total_parsed = 0 THEN 'all_dimensions_zero' WHEN measure_title IS NULL THEN 'no_measurements' END AS refetch FROM done")
def refetch_reasons(spark, sf_dir):
    f = finished(spark, sf_dir)
    totals = F.create_map(*[x for b in S.BUCKETS for x in (F.lit(b), F.coalesce(f"n_{b}", F.lit(0.0)))])
    zero = F.forall(F.map_values(totals), lambda v: v == 0)
    return f.select("nct_id", F.when(F.col("measure_title").isNotNull() & zero, "all_dimensions_zero").when(F.col("measure_title").isNull(), "no_measurements").alias("refetch"))


#: Labels that name a gender identity and no sex.
GENDER_ONLY = ("non-binary", "nonbinary", "genderqueer", "two-spirit")


@query("VOC-8", f"WITH {CELLS} SELECT DISTINCT label, CASE WHEN label IN ('Female', 'Women') THEN 'female' WHEN label = 'Male ' THEN 'male' WHEN label IN ('Non-binary', 'Transgender female*') THEN NULL ELSE 'unknown' END AS category, label = 'Total' AS quarantined FROM cells")
def legacy_sex_map(spark, sf_dir):
    """Identity labels are not sexes; an unknown one without any word of sex is put aside."""
    z = label_key(F.col("label"))
    identity = z.isin(*GENDER_ONLY) | z.rlike(r"cis|\btrans|transgender")
    category = F.when(identity, None).when(z.isin("female", "women", "woman", "f") | z.contains("female"), "female").when(z.isin("male", "men", "man", "m") | z.contains("male"), "male").otherwise("unknown")
    return cells(spark, sf_dir).select("label").distinct().select("label", category.alias("category"), ((category == "unknown").eqNullSafe(F.lit(True)) & ~z.rlike("sex|gender|male|women|men|unknown|reported")).alias("quarantined"))


ETHNIC = f"el{_sql(ETHNIC_LABELS, ('i', 'label', 'category'))}, eth AS (SELECT l_orderkey, l_returnflag AS title, label, category, l_quantity AS value FROM lineitem JOIN el ON l_suppkey % 5 = i)"


def ethnic_rows(spark, sf_dir):
    labels = F.array(*[F.lit(x[0]) for x in ETHNIC_LABELS])
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("title"), F.get(labels, (F.col("l_suppkey") % 5).cast("int")).alias("label"), F.col("l_quantity").alias("value"))
    return S.classify_distinct(rows, "label", "category", E.ethnicity)


@query("SEL-9", f"WITH {ETHNIC}, p AS (SELECT l_orderkey, sum(l_quantity) AS size FROM lineitem GROUP BY 1), t AS (SELECT l_orderkey, sum(CASE WHEN category = 'hispanic_latino' THEN value END) AS hispanic, sum(value) AS n FROM eth WHERE category IS NOT NULL GROUP BY 1) SELECT l_orderkey, hispanic, n AS n_in_table, coalesce(n > 0, FALSE) AS reported, CASE WHEN n > 0 THEN greatest(0, size - n) END AS unknown_inferred FROM p LEFT JOIN t USING (l_orderkey)")
def ethnicity_block(spark, sf_dir):
    population = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("size"))
    b = B.dimension_block(ethnic_rows(spark, sf_dir).filter("category is not null"), "l_orderkey", "category", "value", population, "size")
    return b.select("l_orderkey", F.try_element_at("totals", F.lit("hispanic_latino")).alias("hispanic"), "n_in_table", "reported", "unknown_inferred")


@query("VOC-21", f"WITH {ETHNIC}, g AS (SELECT l_orderkey, title, count(*) AS n_rows, count(category) AS n_eth FROM eth GROUP BY 1, 2) SELECT l_orderkey, bool_or(n_eth > 0 AND n_eth < n_rows) AS mixed, count(*) AS n_tables FROM g GROUP BY 1")
def mixed_tables(spark, sf_dir):
    """Tables in which ethnicity rows stand among others."""
    g = ethnic_rows(spark, sf_dir).groupBy("l_orderkey", "title").agg(F.count("*").alias("n_rows"), F.count("category").alias("n_eth"))
    return g.groupBy("l_orderkey").agg(F.bool_or((F.col("n_eth") > 0) & (F.col("n_eth") < F.col("n_rows"))).alias("mixed"), F.count("*").alias("n_tables"))


@query("VOC-20", f"WITH {ETHNIC} SELECT l_orderkey, title, bool_and(category IS NOT NULL) AS whole_table, sum(CASE WHEN category IS NULL THEN value ELSE 0 END) AS skipped FROM eth GROUP BY 1, 2")
def whole_dimension_tables(spark, sf_dir):
    """A table is of one dimension only if all its rows name it; skipped rows stay apart from the totals."""
    return ethnic_rows(spark, sf_dir).groupBy("l_orderkey", "title").agg(F.every(F.col("category").isNotNull()).alias("whole_table"), F.sum(F.when(F.col("category").isNull(), F.col("value")).otherwise(0.0)).alias("skipped"))


@query("SEL-8", f"WITH {ETHNIC}, r AS (SELECT l_orderkey, title, sum(value) AS race_n FROM eth WHERE category IS NULL GROUP BY 1, 2), e AS (SELECT l_orderkey, title, sum(value) AS eth_n FROM eth WHERE category = 'hispanic_latino' GROUP BY 1, 2) SELECT l_orderkey, title, race_n AS not_hispanic, eth_n AS hispanic FROM r JOIN e USING (l_orderkey, title)")
def combined_classification(spark, sf_dir):
    """In a table that posts races and one Hispanic row, the race rows count people who are not Hispanic."""
    rows = ethnic_rows(spark, sf_dir)
    race = rows.filter("category is null").groupBy("l_orderkey", "title").agg(F.sum("value").alias("not_hispanic"))
    eth = rows.filter("category = 'hispanic_latino'").groupBy("l_orderkey", "title").agg(F.sum("value").alias("hispanic"))
    return race.join(eth, ["l_orderkey", "title"])


@query("SEL-10", PARSED + ", s AS (SELECT nct_id, enrollment FROM studies) SELECT d.nct_id, n_female, n_male, CASE WHEN status = 'reported' THEN greatest(0, coalesce(d.enrollment, 0) - coalesce(n_female, 0) - coalesce(n_male, 0)) END AS unknown_balanced FROM done d")
def legacy_sex_block(spark, sf_dir):
    """The older block pushes the gap to the population into unknown; the parser's row never does."""
    c = lambda n: F.coalesce(n, F.lit(0.0))
    gap = F.greatest(F.lit(0.0), F.coalesce(F.col("enrollment").cast("double"), F.lit(0.0)) - c("n_female") - c("n_male"))
    return finished(spark, sf_dir).select("nct_id", "n_female", "n_male", F.when(F.col("status") == "reported", gap).alias("unknown_balanced"))


@query("SEL-6", f"""WITH {CELLS}, p AS (SELECT nct_id, sum(value) AS size FROM cells WHERE CAST(substr(nct_id, 4) AS INT) % 3 <> 0 OR unit = 'Participants' GROUP BY 1), t AS (SELECT nct_id, title, sum(value) AS n, sum(CASE WHEN label IN ('Non-binary', 'Transgender female*') THEN value ELSE 0 END) AS fine FROM cells GROUP BY 1, 2),
  f AS (SELECT nct_id, bool_and(n < size) AND sum(n) = max(size) AND count(*) > 1 AS parted FROM t JOIN p USING (nct_id) GROUP BY 1), r AS (SELECT t.*, row_number() OVER (PARTITION BY nct_id ORDER BY fine DESC, n DESC, title) AS rank FROM t)
  SELECT nct_id, title, CASE WHEN coalesce(parted, FALSE) THEN 'part' WHEN rank = 1 THEN 'fullest' ELSE 'superseded' END AS role FROM r LEFT JOIN f USING (nct_id)""")
def selected_tables(spark, sf_dir):
    """Tables that together are exactly the baseline population are its parts and all count; else the fullest does and supersedes the rest. The
    population is that of the trial's cells; for every third trial of those in people only."""
    number = F.substring("nct_id", 4, 8).cast("int")
    size = cells(spark, sf_dir).filter((number % 3 != 0) | (F.col("unit") == "Participants")).groupBy("nct_id").agg(F.sum("value").alias("size"))
    fine = F.sum(F.when(F.col("label").isin("Non-binary", "Transgender female*"), F.col("value")).otherwise(0.0))
    t = cells(spark, sf_dir).groupBy("nct_id", "title").agg(F.sum("value").alias("n"), fine.alias("fine"))
    return S.select_tables(t.join(size, "nct_id", "left"), "nct_id", "n", "size", "title", F.col("fine"), F.col("n"), "title").select("nct_id", "title", "role")


@query("SEL-16", f"WITH {STUDIES}, l AS (SELECT DISTINCT {NCT.format('l_orderkey')} AS nct_id FROM lineitem), x AS (SELECT nct_id, CASE WHEN l.nct_id IS NULL THEN 'not_retrieved' END AS a, status FROM studies s LEFT JOIN l USING (nct_id)) SELECT nct_id, CASE WHEN a IS NOT NULL THEN 'not_retrieved' WHEN status = 'P' THEN 'section_unreadable' ELSE 'complete' END AS state, CASE WHEN a IS NULL AND status <> 'P' THEN TRUE END AS flow FROM x")
def assembled_records(spark, sf_dir):
    """A section that cannot be read is null with a failure beside it; an id that was not retrieved keeps a record."""
    got = table(spark, sf_dir, "lineitem").select(nct("l_orderkey").alias("nct_id"), F.lit(True).alias("here")).distinct()
    s = registered(spark, sf_dir).join(got, "nct_id", "left")
    section = F.try_parse_json(F.when(F.col("status") == "P", "not json").otherwise('{"flow": true}'))
    flow = F.when(F.col("here"), F.try_variant_get(section, "$.flow", "boolean"))
    return s.select("nct_id", F.when(F.col("here").isNull(), "not_retrieved").when(section.isNull(), "section_unreadable").otherwise("complete").alias("state"), flow.alias("flow"))


@query("VOC-16", f"WITH {CELLS}, d AS (SELECT nct_id, title, count(DISTINCT CASE WHEN label IN ('Female', 'Women') THEN 'female' WHEN label = 'Male ' THEN 'male' END) AS sexes FROM cells GROUP BY 1, 2) SELECT nct_id, title, CASE WHEN sexes >= 2 THEN 'sex' END AS dimension FROM d")
def subgroup_levels(spark, sf_dir):
    """A measure is by subgroup of a dimension only if its titles show at least two of its levels."""
    z = label_key(F.col("label"))
    level = F.when(z.isin("female", "women"), "female").when(z == "male", "male")
    return cells(spark, sf_dir).groupBy("nct_id", "title").agg(F.size(F.collect_set(level)).alias("k")).select("nct_id", "title", F.when(F.col("k") >= 2, "sex").alias("dimension"))


@query("VOC-17", "SELECT doc_id, regexp_matches(lower(text), 'subgroup|by (sex|race|age)') AS cue, CASE WHEN regexp_matches(lower(text), 'subgroup') THEN 'keyword' WHEN regexp_matches(lower(text), 'by (sex|race|age)') THEN 'by_demographic' END AS kind FROM documents")
def subgroup_cues(spark, sf_dir):
    t = F.lower("text")
    keyword, by = t.rlike("subgroup"), t.rlike("by (sex|race|age)")
    return table(spark, sf_dir, "documents").select("doc_id", (keyword | by).alias("cue"), F.when(keyword, "keyword").when(by, "by_demographic").alias("kind"))


@query("DQ-5", """WITH k AS (SELECT event_type, unnest(json_keys(props)) AS key FROM events) SELECT event_type, key, count(*) AS n FROM k WHERE key NOT IN ('k', 'v') OR (event_type = 'error' AND key = 'k') GROUP BY 1, 2""")
def banned_keys(spark, sf_dir):
    """Keys of published payloads that their kind's contract does not allow; errors may not show the one that the others have."""
    allowed = F.when(F.col("event_type") == "error", F.array(F.lit("v"))).otherwise(F.array(F.lit("k"), F.lit("v")))
    keys = table(spark, sf_dir, "events").select("event_type", F.explode(F.array_except(F.json_object_keys("props"), allowed)).alias("key"))
    return keys.groupBy("event_type", "key").agg(F.count("*").alias("n"))


