"""Queries over records as files and sets: sources, sinks, splits, set operations and checks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import agreements as A
from ..sources import folders as S
from ..streaming import inbox as I
from ..streaming import labelstate as K
from .bindings import SNAPSHOTS, STUDIES, snapshots, registered, studies, table
from .registry import query

RECORD = "nct_id string, lead string, class string, status string, results_date string, enrollment long"
PICKED = "SELECT nct_id, lead, class, status, strftime(results_date, '%Y-%m-%d') AS results_date, enrollment FROM studies"


def records(spark, sf_dir):
    return studies(spark, sf_dir).select("nct_id", "lead", "class", "status", F.date_format("results_date", "yyyy-MM-dd").alias("results_date"), "enrollment")


def landed(spark, sf_dir):
    path = S.landing(spark, "studies")
    S.write_lines(records(spark, sf_dir), path)
    return path


@query("SRC-1", f"WITH {STUDIES} {PICKED} WHERE results_date BETWEEN DATE '1997-01-01' AND DATE '1998-06-30'")
def filtered_registered(spark, sf_dir):
    return S.read_studies(spark, landed(spark, sf_dir), RECORD, "results_date", "1997-01-01", "1998-06-30")


@query("SRC-3", f"WITH {STUDIES} {PICKED}")
def written_and_read(spark, sf_dir):
    return S.read_lines(spark, landed(spark, sf_dir), RECORD)[0]


@query("SRC-4", f"WITH {STUDIES} SELECT count(*) AS n_records, count_if(status = 'P') AS n_problems FROM studies")
def tolerant_lines(spark, sf_dir):
    """Lines of pending studies are cut off before they are written; each becomes a counted problem."""
    path = S.landing(spark, "broken")
    line = F.to_json(F.struct(*records(spark, sf_dir).columns))
    rows = records(spark, sf_dir)
    rows.select(line.alias("value")).unionByName(rows.filter("status = 'P'").select(F.substring(line, 1, 20).alias("value"))).write.text(path)
    good, bad = S.read_lines(spark, path, RECORD)
    return good.select(F.lit(1).alias("g"), F.lit(0).alias("b")).unionByName(bad.select(F.lit(0).alias("g"), F.lit(1).alias("b"))).agg(F.sum("g").cast("bigint").alias("n_records"), F.sum("b").cast("bigint").alias("n_problems"))


@query("SRC-5", f"WITH {STUDIES} SELECT nct_id, lead, class FROM studies")
def delimited(spark, sf_dir):
    path = S.landing(spark, "sponsors")
    records(spark, sf_dir).write.option("header", True).option("sep", "|").csv(path)
    return S.read_delimited(spark, path, ["nct_id", "lead", "class"])


@query("SRC-8", f"WITH {STUDIES} SELECT nct_id, enrollment, results_date, status = 'F' AS is_final, [lead, class] AS labels FROM studies")
def typed_round_trip(spark, sf_dir):
    path = S.landing(spark, "typed")
    rows = studies(spark, sf_dir).select("nct_id", "enrollment", "results_date", (F.col("status") == "F").alias("is_final"), F.to_json(F.array("lead", "class")).alias("labels"))
    rows.write.option("header", True).option("escape", '"').csv(path)
    back = spark.read.schema("nct_id string, enrollment long, results_date date, is_final boolean, labels string").option("header", True).option("escape", '"').csv(path)
    return back.withColumn("labels", F.from_json("labels", "array<string>"))


@query("SRC-12", f"WITH {STUDIES}, p AS (SELECT nct_id, row_number() OVER (ORDER BY nct_id) - 1 AS position, count(*) OVER () AS n FROM studies) SELECT CAST(floor(position / ceil(n / 7.0)) AS BIGINT) AS part, count(*) AS n_rows, min(nct_id) AS first_id, max(nct_id) AS last_id FROM p GROUP BY 1")
def positional_parts(spark, sf_dir):
    rows = S.numbered(registered(spark, sf_dir).select("nct_id"), ["nct_id"])
    total = F.lit(table(spark, sf_dir, "orders").count())
    return rows.groupBy(S.part_of(F.col("position"), total, 7).alias("part")).agg(F.count("*").alias("n_rows"), F.min("nct_id").alias("first_id"), F.max("nct_id").alias("last_id"))


@query("SRC-1-limited", f"WITH {STUDIES} {PICKED} WHERE results_date >= DATE '1997-01-01' AND class = 'BUILDING' ORDER BY nct_id LIMIT 25")
def limited_studies(spark, sf_dir):
    """A source's own limit, in the order of its ids."""
    return S.read_studies(spark, landed(spark, sf_dir), RECORD, "results_date", "1997-01-01", None, F.col("class") == "BUILDING", 25, "nct_id")


@query("SRC-13", f"WITH {STUDIES} SELECT CAST(substr(nct_id, 4) AS INT) % 16 AS shard, count(*) AS n_rows, count(DISTINCT nct_id) AS n_ids FROM studies GROUP BY 1")
def shards(spark, sf_dir):
    """Written, one folder a shard, and read from there."""
    path = S.landing(spark, "shards")
    S.write_shards(registered(spark, sf_dir).select("nct_id", "lead"), "nct_id", 16, path)
    return spark.read.parquet(path).groupBy("shard").agg(F.count("*").alias("n_rows"), F.count_distinct("nct_id").alias("n_ids"))


@query("SRC-13-refused", f"WITH {STUDIES}, k AS (SELECT nct_id, CAST(substr(nct_id, 4) AS INT) AS k FROM studies) SELECT 'N' || substr(nct_id, 4) AS nct_id, 'not_an_id' AS problem FROM k WHERE k % 100 = 1 UNION ALL SELECT nct_id, 'repeated_id' FROM k WHERE k % 100 = 2")
def refused_shards(spark, sf_dir):
    """Ids with planted faults: some of another form, some twice."""
    k = F.substring("nct_id", 4, 8).cast("int") % 100
    ids = registered(spark, sf_dir).select("nct_id")
    bad = ids.select(F.when(k == 1, F.concat(F.lit("N"), F.substring("nct_id", 4, 8))).otherwise(F.col("nct_id")).alias("nct_id"))
    return S.shard_problems(bad.unionByName(ids.filter(k == 2)), "nct_id")


CLASSES = {"sponsor": ["lead", "class"], "status": ["status", "results_date"], "size": ["enrollment"]}


@query("SRC-14", f"WITH {STUDIES} SELECT CAST(0 AS BIGINT) AS n_different, count(*) AS n_records FROM studies")
def lossless_split(spark, sf_dir):
    whole = records(spark, sf_dir)
    lost = S.merge_losses(whole, S.split_fields(whole, "nct_id", CLASSES), "nct_id")
    return lost.agg(F.count("*").alias("n_different")).join(whole.agg(F.count("*").alias("n_records")))


@query("SRC-14-planted", f"WITH {STUDIES}, k AS (SELECT nct_id, CAST(substr(nct_id, 4) AS INT) AS k FROM studies WHERE lead IS NOT NULL) SELECT nct_id, unnest(CASE WHEN k % 50 = 1 THEN ['lost', 'added'] ELSE ['lost'] END) AS side FROM k WHERE k % 50 IN (1, 2)")
def lossy_split(spark, sf_dir):
    """A split that blanks one field of some records and drops others from one class."""
    whole = records(spark, sf_dir)
    k = F.substring("nct_id", 4, 8).cast("int") % 50
    parts = S.split_fields(whole, "nct_id", CLASSES)
    parts["sponsor"] = parts["sponsor"].withColumn("lead", F.when(k != 1, F.col("lead")))
    parts["size"] = parts["size"].filter(k != 2)
    return S.merge_losses(whole, parts, "nct_id").select("nct_id", "side")


@query("SRC-15", f"WITH {STUDIES} SELECT nct_id, lead, enrollment FROM studies WHERE CAST(substr(nct_id, 4) AS BIGINT) IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 49)")
def subset_archive(spark, sf_dir):
    wanted = table(spark, sf_dir, "lineitem").filter("l_quantity >= 49").select(F.concat(F.lit("NCT"), F.lpad(F.col("l_orderkey").cast("string"), 8, "0")).alias("nct_id"))
    return records(spark, sf_dir).join(wanted, "nct_id", "left_semi").select("nct_id", "lead", "enrollment")


@query("SRC-16", f"""WITH {STUDIES}, p AS (SELECT class, CAST(substr(nct_id, 4) AS INT) % 5 AS part, CASE WHEN class = 'BUILDING' THEN status ELSE 'run-1' END AS stamp, CASE WHEN class = 'MACHINERY' AND year > 1998 THEN 6 ELSE 5 END AS total FROM studies WHERE NOT (class = 'FURNITURE' AND CAST(substr(nct_id, 4) AS INT) % 5 = 3))
  SELECT class, count(DISTINCT stamp) AS n_runs, count(DISTINCT part) AS n_parts, max(total) AS total_parts, count(DISTINCT stamp) = 1 AND count(DISTINCT total) = 1 AND count(DISTINCT part) = max(total) AS is_one_run FROM p GROUP BY 1""")
def one_run(spark, sf_dir):
    """Datasets by class, three of them faulty: mixed stamps, parts that disagree about their number, a part that is missing."""
    part = S.shard_of(F.col("nct_id"), 5)
    stamp = F.when(F.col("class") == "BUILDING", F.col("status")).otherwise("run-1")
    total = F.when((F.col("class") == "MACHINERY") & (F.col("year") > 1998), 6).otherwise(5)
    parts = registered(spark, sf_dir).filter(~((F.col("class") == "FURNITURE") & (part == 3))).select("class", part.alias("part"), stamp.alias("stamp"), total.alias("total"))
    return S.mixed_runs(parts, ["class"], ["stamp"], "part", "total")


@query("SET-3", f"WITH {STUDIES}, a AS (SELECT lead, class FROM studies WHERE status <> 'P'), b AS (SELECT lead, class FROM studies WHERE status <> 'F') SELECT (SELECT count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b)) AS n_agree, (SELECT count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b)) AS n_left, (SELECT count(*) FROM (SELECT * FROM b EXCEPT SELECT * FROM a)) AS n_right")
def pair_sets(spark, sf_dir):
    s = registered(spark, sf_dir)
    a, b = (s.filter(f"status <> '{x}'").select("lead", "class") for x in "PF")
    named = [f(a, b).select(F.lit(n).alias("k")) for n, f in (("agree", lambda a, b: a.intersect(b)), ("left", lambda a, b: a.subtract(b)), ("right", lambda a, b: b.subtract(a)))]
    return named[0].unionByName(named[1]).unionByName(named[2]).agg(*[F.count_if(F.col("k") == k).alias(f"n_{k}") for k in ("agree", "left", "right")])


@query("SET-4", f"WITH {STUDIES} SELECT nct_id, count(*) AS n_parts FROM (SELECT nct_id FROM studies WHERE status = 'F' UNION ALL SELECT nct_id FROM studies WHERE class = 'BUILDING' UNION ALL SELECT nct_id FROM studies WHERE enrollment > 100) GROUP BY 1")
def united_parts(spark, sf_dir):
    s = studies(spark, sf_dir)
    parts = [s.filter(c).select("nct_id") for c in ("status = 'F'", "class = 'BUILDING'", "enrollment > 100")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("nct_id").agg(F.count("*").alias("n_parts"))


@query("SET-6", "SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem) THEN 'retrieved' ELSE 'not_retrieved' END AS scope FROM orders")
def scope(spark, sf_dir):
    o, l = table(spark, sf_dir, "orders").select("o_orderkey"), table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    there = l.distinct().withColumn("there", F.lit(True))
    return o.join(there, "o_orderkey", "left").select("o_orderkey", F.when(F.col("there"), "retrieved").otherwise("not_retrieved").alias("scope"))


@query("DQ-1", f"""WITH {STUDIES}, k AS (SELECT nct_id, CAST(substr(nct_id, 4) AS INT) AS k FROM studies) SELECT unnest(['not_json', 'id_missing', 'id_form', 'id_repeated', 'several_snapshots', 'several_runs']) AS check_name,
  unnest([count_if(k % 100 = 1), count_if(k % 100 = 2), count_if(k % 100 = 3), count_if(k % 100 = 4), CAST(bool_or(k % 100 = 5) AS BIGINT), CAST(bool_or(k % 100 = 6) AS BIGINT)]) AS n_violations FROM k""")
def archive_checks(spark, sf_dir):
    """An archive of lines with planted faults by the trial's number: cut lines, no id, ids of another form, repeated ids, other snapshots and runs."""
    k = F.substring("nct_id", 4, 8).cast("int") % 100
    rows = registered(spark, sf_dir).select("nct_id", k.alias("k"))
    rows = rows.unionByName(rows.filter("k = 4"))
    shown = F.when(F.col("k") == 3, F.concat(F.lit("X"), "nct_id")).when(F.col("k") != 2, F.col("nct_id"))
    line = F.to_json(F.struct(shown.alias("nct_id"), F.when(F.col("k") == 5, "s2").otherwise("s1").alias("snapshot"), F.when(F.col("k") == 6, "r2").otherwise("r1").alias("run")))
    path = S.landing(spark, "archive")
    rows.select(F.when(F.col("k") == 1, F.left(line, F.lit(9))).otherwise(line).alias("value")).write.text(path)
    return S.archive_problems(*S.read_lines(spark, path, "nct_id string, snapshot string, run string"))


@query("DQ-3", "SELECT event_type, count(*) AS n_rows, count(json_extract_string(props, '$.k')) AS n_k, count(json_extract_string(props, '$.missing')) AS n_missing FROM events GROUP BY 1")
def path_presence(spark, sf_dir):
    v = F.try_parse_json("props")
    e = table(spark, sf_dir, "events").withColumn("v", v)
    return e.groupBy("event_type").agg(F.count("*").alias("n_rows"), F.count(F.try_variant_get("v", "$.k", "string")).alias("n_k"), F.count(F.try_variant_get("v", "$.missing", "string")).alias("n_missing"))


@query("DQ-4", "SELECT 'lineitem_order' AS reference, count(*) AS n_orphans FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) UNION ALL SELECT 'labels_document', count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents) UNION ALL SELECT 'order_lines', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def references(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    checks = {
        "lineitem_order": t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"), "left_anti"),
        "labels_document": t("labels").join(t("documents").select("doc_id"), "doc_id", "left_anti"),
        "order_lines": t("orders").join(t("lineitem"), F.col("l_orderkey") == F.col("o_orderkey"), "left_anti"),
    }
    out = None
    for name, rows in checks.items():
        one = rows.agg(F.count("*").alias("n_orphans")).select(F.lit(name).alias("reference"), "n_orphans")
        out = one if out is None else out.unionByName(one)
    return out


AGREED = """c AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 50 = 2 THEN 'UNHEARD' ELSE c_mktsegment END AS segment, coalesce(n, 0) + CASE WHEN c_custkey % 50 = 3 THEN 1 ELSE 0 END AS n_orders FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey),
  cc AS (SELECT * FROM c UNION ALL SELECT * FROM c WHERE k % 50 = 1), o AS (SELECT CASE WHEN o_orderkey % 600 = 10 THEN NULL ELSE o_orderkey END AS k, o_custkey + CASE WHEN o_orderkey % 60 = 4 THEN 100000000 ELSE 0 END AS customer, CASE WHEN o_orderkey % 60 = 5 THEN 'X' ELSE o_orderstatus END AS status, q + CASE WHEN o_orderkey % 60 = 6 THEN 0.5 ELSE 0 END AS quantity FROM orders JOIN (SELECT l_orderkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey),
  l AS (SELECT l_orderkey + CASE WHEN l_orderkey % 60 = 7 AND l_linenumber = 1 THEN 1000000000 ELSE 0 END AS k, l_quantity AS q, l_linenumber AS line FROM lineitem)"""


@query("DQ-4-contract", f"""WITH {AGREED} SELECT 'customers' AS "table", CAST(k AS VARCHAR) AS "key", 'key_repeated' AS rule, count(*) AS n FROM cc GROUP BY k HAVING count(*) > 1
  UNION ALL SELECT 'customers', CAST(k AS VARCHAR), 'segment_known', count(*) FROM cc WHERE segment = 'UNHEARD' GROUP BY k
  UNION ALL SELECT 'customers', CAST(customer AS VARCHAR), 'not_found:orders.customer', count(*) FROM o WHERE customer NOT IN (SELECT k FROM c) GROUP BY customer
  UNION ALL SELECT 'customers', CAST(c.k AS VARCHAR), 'n_orders', count(customer) FROM c LEFT JOIN o ON customer = c.k WHERE c.k % 50 <> 1 GROUP BY c.k, n_orders HAVING count(customer) <> n_orders
  UNION ALL SELECT 'orders', NULL, 'key_missing', count(*) FROM o WHERE k IS NULL HAVING count(*) > 0 UNION ALL SELECT 'orders', CAST(k AS VARCHAR), 'status_known', count(*) FROM o WHERE status = 'X' GROUP BY k
  UNION ALL SELECT 'lines', k || '-' || line, 'key_repeated', count(*) FROM l GROUP BY k, line HAVING count(*) > 1
  UNION ALL SELECT 'orders', CAST(l.k AS VARCHAR), 'not_found:lines.order', count(*) FROM l ANTI JOIN o ON l.k = o.k GROUP BY l.k
  UNION ALL SELECT 'orders', CAST(o.k AS VARCHAR), 'quantity', count(l.k) FROM o LEFT JOIN l ON o.k = l.k WHERE o.k IS NOT NULL GROUP BY o.k, quantity HAVING coalesce(sum(q), 0) <> quantity""")
def contract(spark, sf_dir):
    """Customers, orders and lines with faults planted in keys, references, vocabularies and published totals, held against what is declared of them."""
    t = lambda n: table(spark, sf_dir, n)
    k, o, line = F.col("c_custkey"), F.col("o_orderkey"), F.col("l_orderkey")
    n, q = t("orders").groupBy("o_custkey").agg(F.count("*").alias("n")), t("lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("q"))
    plus = lambda when, what: F.when(when, what).otherwise(0)
    customers = t("customer").join(n, F.col("o_custkey") == k, "left").select(k.alias("k"), F.when(k % 50 == 2, "UNHEARD").otherwise(F.col("c_mktsegment")).alias("segment"), (F.coalesce("n", F.lit(0)) + plus(k % 50 == 3, 1)).alias("n_orders"))
    orders = t("orders").join(q, o == line).select(F.when(o % 600 != 10, o).alias("k"), (F.col("o_custkey") + plus(o % 60 == 4, 100_000_000)).alias("customer"), F.when(o % 60 == 5, "X").otherwise(F.col("o_orderstatus")).alias("status"), (F.col("q") + plus(o % 60 == 6, 0.5)).alias("quantity"))
    lines = t("lineitem").select((line + plus((line % 60 == 7) & (F.col("l_linenumber") == 1), 1_000_000_000)).alias("order"), F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("q"))
    agreed = {
        "customers": A.Terms(F.col("k"), {"segment_known": F.col("segment") != "UNHEARD"}, {}, {"n_orders": A.Total(F.col("n_orders"), "orders", "customer")}),
        "orders": A.Terms(F.col("k"), {"status_known": F.col("status").isin("O", "F", "P")}, {"customer": ("customers", F.col("customer"))}, {"quantity": A.Total(F.col("quantity"), "lines", "order", "q")}),
        "lines": A.Terms(F.concat_ws("-", "order", "line"), {}, {"order": ("orders", F.col("order"))}),
    }
    return A.breaches({"customers": customers.unionByName(customers.filter("k % 50 = 1")), "orders": orders, "lines": lines}, agreed)


@query("DQ-4-sums", """WITH c AS (SELECT c_nationkey AS entity, c_mktsegment AS class, count(*) + CASE WHEN c_nationkey % 5 = 0 AND c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS n FROM customer GROUP BY 1, 2), w AS (SELECT c_nationkey AS entity, count(*) AS total, CASE WHEN c_nationkey % 7 = 0 THEN 'people' ELSE 'customers' END AS denominator FROM customer GROUP BY 1),
  s AS (SELECT w.*, coalesce(sum(n), 0) AS summed FROM w LEFT JOIN c USING (entity) GROUP BY ALL) SELECT entity, unnest(list_filter([CASE WHEN summed <> total THEN 'classes_do_not_add_up' END, CASE WHEN denominator <> 'customers' THEN 'unknown_denominator' END], lambda x: x IS NOT NULL)) AS problem FROM s""")
def class_sums(spark, sf_dir):
    """Published totals against the sums of their classes, each total with a denominator that has a definition; some nations are wrong in either."""
    c, k = table(spark, sf_dir, "customer"), F.col("entity")
    classes = c.groupBy(F.col("c_nationkey").alias("entity"), F.col("c_mktsegment").alias("class")).agg(F.count("*").alias("n"))
    classes = classes.withColumn("n", F.col("n") + F.when((k % 5 == 0) & (F.col("class") == "BUILDING"), 1).otherwise(0))
    totals = c.groupBy(F.col("c_nationkey").alias("entity")).agg(F.count("*").alias("total")).withColumn("denominator", F.when(k % 7 == 0, "people").otherwise("customers"))
    return S.sum_problems(totals, classes, "entity", ["customers"])


@query("DQ-9", f"""WITH {STUDIES}, a AS (SELECT year, count(*) AS n FROM studies GROUP BY 1), p AS (SELECT CASE WHEN year % 3 = 0 THEN year + 100 ELSE year END AS year, CASE WHEN year % 3 = 1 THEN n + 1 ELSE n END AS n FROM a)
  SELECT coalesce(a.year, p.year) AS year, a.n AS counted, p.n AS published FROM a FULL JOIN p ON a.year = p.year WHERE a.n IS DISTINCT FROM p.n""")
def recount(spark, sf_dir):
    """Published counts against a recount; in what is published some years are wrong by one and some stand under another year."""
    a = registered(spark, sf_dir).groupBy("year").agg(F.count("*").alias("counted"))
    y = F.col("year") % 3
    p = a.select(F.when(y == 0, F.col("year") + 100).otherwise(F.col("year")).alias("year"), F.when(y == 1, F.col("counted") + 1).otherwise(F.col("counted")).alias("published"))
    return a.join(p, "year", "full").filter(~F.col("counted").eqNullSafe(F.col("published"))).select("year", "counted", "published")


@query("DQ-11", f"""WITH {STUDIES}, a AS (SELECT year, avg(enrollment) AS x FROM studies GROUP BY 1) SELECT year, year % 2 = 0 AS within, round(CASE WHEN year % 2 = 0 THEN 0 ELSE 0.001 END, 6) AS difference FROM a""")
def spot_check(spark, sf_dir):
    """Mean enrolment by year against the same mean taken from the line items; every other year's published mean is off by more than the tolerance."""
    a = studies(spark, sf_dir).groupBy("year").agg((F.sum("enrollment") / F.count("enrollment")).alias("x"))
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("q")).join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    b = lines.groupBy(F.year("o_orderdate").cast("bigint").alias("year")).agg(F.avg("q").alias("y"))
    off = F.abs(F.col("x") + F.when(F.col("year") % 2 == 0, 0.0).otherwise(0.001) - F.col("y"))
    return a.join(b, "year").select("year", (off < 0.0005).alias("within"), F.round(off, 6).alias("difference"))


@query("DQ-14", f"""WITH {STUDIES}, k AS (SELECT nct_id, CAST(substr(nct_id, 4) AS INT) AS k FROM studies) SELECT nct_id, CASE k % 60 WHEN 1 THEN 'in_another_shard' WHEN 2 THEN 'in_several_shards' WHEN 3 THEN 'missing_in_b' ELSE 'missing_in_a' END AS problem FROM k WHERE k % 60 BETWEEN 1 AND 4""")
def split_consistency(spark, sf_dir):
    """A split in two classes of fields over four shards, with planted faults: a wrong shard, two shards, an id that one class lacks."""
    s = registered(spark, sf_dir).select("nct_id", F.substring("nct_id", 4, 8).cast("int").alias("k"))
    f, right = F.col("k") % 60, F.pmod(F.col("k"), F.lit(4))
    a = s.filter(f != 4).select("nct_id", F.explode(F.when(f == 2, F.array(right, F.pmod(right + 1, F.lit(4)))).when(f == 1, F.array(F.pmod(right + 1, F.lit(4)))).otherwise(F.array(right))).alias("shard"))
    b = s.filter(f != 3).select("nct_id", right.alias("shard"))
    return S.split_problems({"a": a, "b": b}, 4)


@query("DQ-15", """WITH b AS (SELECT DISTINCT p_partkey % 2 AS sex, p_size AS lo FROM part WHERE NOT (p_partkey % 2 = 1 AND p_size % 11 = 0)), n AS (SELECT sex, lo, lead(lo) OVER (PARTITION BY sex ORDER BY lo) AS nxt, count(*) OVER (PARTITION BY lo) AS sexes, min(lo) OVER (PARTITION BY sex) AS first FROM b)
  SELECT sex, lo, nxt, nxt IS NULL OR nxt = lo + 1 AS tiles, sexes = 2 AS in_both FROM n""")
def tiling(spark, sf_dir):
    """Age bands by sex: each begins where the one before ends, and both sexes have it; one sex lacks every eleventh band."""
    bands = table(spark, sf_dir, "part").select((F.col("p_partkey") % 2).alias("sex"), F.col("p_size").alias("lo")).filter("not (sex = 1 and lo % 11 = 0)").distinct()
    nxt = F.lead("lo").over(Window.partitionBy("sex").orderBy("lo"))  # as many rows as bands
    rows = bands.withColumns({"nxt": nxt, "sexes": F.count("*").over(Window.partitionBy("lo"))})
    return rows.select("sex", "lo", "nxt", (F.col("nxt").isNull() | (F.col("nxt") == F.col("lo") + 1)).alias("tiles"), (F.col("sexes") == 2).alias("in_both"))


@query("STR-2", "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def streamed_windows(spark, sf_dir):
    """Events arrive as files, every seventh twice; counts by day and type, each event once."""
    arriving, out, marks = (S.landing(spark, n) for n in ("events", "windows", "marks"))
    e = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    e.unionByName(e.filter("event_id % 7 = 0")).repartitionByRange(4, "ts").sortWithinPartitions("ts").write.parquet(arriving)
    stream = I.label_stream(spark, arriving, "event_id long, ts timestamp, event_type string", 100)
    counts = I.windowed_counts(stream, "ts", ["event_type"], ["event_id"], "1 day", "3650 days")
    run = I.keep_totals(counts, out, marks)
    run.awaitTermination()
    return I.latest(spark, out).select(F.to_date("window.start").alias("day"), "event_type", "n")


@query("STR-1", f"WITH {SNAPSHOTS} SELECT label, min(week) AS first_seen, max(week) AS last_seen FROM snapshots GROUP BY 1")
def streamed_inbox(spark, sf_dir):
    """Snapshots arrive as files, week by week; the stream's inbox is what one batch over all of them gives."""
    arriving, state, marks = (S.landing(spark, n) for n in ("arriving", "inbox", "marks"))
    snapshots(spark, sf_dir).select("label", "week").repartition(3, "week").write.parquet(arriving)
    run = I.keep_inbox(I.label_stream(spark, arriving, "label string, week date"), ["label"], "week", state, marks)
    run.awaitTermination()
    return I.latest(spark, state)


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
UNREAD = f"""{SNAPSHOTS}, u AS (SELECT label, week FROM snapshots WHERE n % 3 > 0), m AS (SELECT min(week) + 14 AS half FROM u), weeks AS (SELECT DISTINCT week FROM u), noted AS (SELECT DISTINCT label, half AS day FROM u, m WHERE right(label, 1) = '7')"""


@query("STR-1-changes", f"""WITH {UNREAD}, k AS (SELECT u.*, day, coalesce(week <= day, TRUE) AS counts, week - lag(week) OVER (PARTITION BY label ORDER BY week) AS gap, lead(week) OVER (PARTITION BY label ORDER BY week) - week AS ahead FROM u LEFT JOIN noted USING (label)),
  runs AS (SELECT *, count_if(gap IS NULL OR gap > 7) OVER (PARTITION BY label ORDER BY week) AS run FROM k WHERE counts), r AS (SELECT label, run, min(week) AS a, max(week) AS z, any_value(day) AS day FROM runs GROUP BY 1, 2),
  e AS (SELECT label, 'opened' AS event, a AS week, a AS first_seen, a AS last_seen, NULL AS note FROM r UNION ALL SELECT label, 'resolved', day, a, z, 'known unit' FROM r WHERE z = day
    UNION ALL SELECT label, 'left', z + 7, a, z, NULL FROM r WHERE z IS DISTINCT FROM day AND z < (SELECT max(week) FROM u))
  SELECT label, row_number() OVER (PARTITION BY label ORDER BY week, event) AS nth, event, week, first_seen, last_seen, note FROM e""")
def streamed_changes(spark, sf_dir):
    """Snapshots of the labels that nobody could read (some weeks they can), and a curator's notes on some in the third week. They arrive in two
    deliveries: the second run of the stream starts from the state of the first, and each writes its changes only."""
    arriving, out, marks = (S.landing(spark, n) for n in ("snapshots", "changes", "marks"))
    seen = S.kept(snapshots(spark, sf_dir).filter("n % 3 > 0").select("label", F.col("week").cast("timestamp").alias("week"), F.lit(None).cast("string").alias("note")), "unread")
    half = seen.agg((F.min("week") + F.expr("interval 14 days")).alias("half"))  # one row
    notes = seen.filter("label like '%7'").select("label").distinct().join(F.broadcast(half)).select("label", F.col("half").alias("week"), F.lit("known unit").alias("note"))
    both = seen.unionByName(notes).join(F.broadcast(half))
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for delivery in (F.col("week") <= F.col("half"), F.col("week") > F.col("half")):
            both.filter(delivery).drop("half").write.mode("append").parquet(arriving)
            K.keep_changes(K.inbox_changes(I.label_stream(spark, arriving, "label string, week timestamp, note string", 1000)), out, marks).awaitTermination()
    finally:
        spark.conf.set(STATE_STORE, before)
    return spark.read.parquet(out)
