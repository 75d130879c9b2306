"""Queries over weekly snapshots and revisions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import history as H
from .bindings import SNAPSHOTS, snapshots, table
from .registry import query

LAST = f"WITH {SNAPSHOTS}, m AS (SELECT max(week) AS w FROM snapshots), a AS (SELECT * FROM snapshots, m WHERE week = w - 7), b AS (SELECT * FROM snapshots, m WHERE week = w)"


def last_two(spark, sf_dir):
    s = snapshots(spark, sf_dir)
    latest = s.agg(F.max("week").alias("w"))
    s = s.join(F.broadcast(latest))  # one row
    return s.filter(F.col("week") == F.date_sub("w", 7)), s.filter(F.col("week") == F.col("w"))


@query("JN-9-weeks", LAST + " SELECT coalesce(a.label, b.label) AS label, a.n AS before, b.n AS after, CASE WHEN a.label IS NULL THEN 'added' WHEN b.label IS NULL THEN 'removed' ELSE 'changed' END AS change FROM a FULL JOIN b ON a.label = b.label WHERE a.n IS DISTINCT FROM b.n")
def label_changes(spark, sf_dir):
    return H.changes(*last_two(spark, sf_dir), ["label"], "n")


@query("JN-10-weeks", LAST + " SELECT label, 'added' AS change FROM b WHERE label NOT IN (SELECT label FROM a) UNION ALL SELECT label, 'removed' FROM a WHERE label NOT IN (SELECT label FROM b)")
def labels_in_and_out(spark, sf_dir):
    a, b = last_two(spark, sf_dir)
    return b.join(a, "label", "left_anti").select("label", F.lit("added").alias("change")).unionByName(a.join(b, "label", "left_anti").select("label", F.lit("removed").alias("change")))


@query("JN-11", f"WITH {SNAPSHOTS}, m AS (SELECT max(week) AS w FROM snapshots) SELECT label, min(week) AS first_seen, max(week) AS last_seen, count(DISTINCT week) AS n_weeks, CAST(date_diff('day', min(week), max(w)) // 7 AS BIGINT) AS weeks_open, max(week) = max(w) AS is_open FROM snapshots, m GROUP BY 1")
def label_inbox(spark, sf_dir):
    s = snapshots(spark, sf_dir)
    latest = s.agg(F.max("week").alias("as_of"))
    rows = H.inbox(s, ["label"], "week", F.lit(None).cast("date")).drop("weeks_open", "is_open").join(F.broadcast(latest))
    return rows.withColumns({"weeks_open": F.floor(F.datediff("as_of", "first_seen") / 7), "is_open": F.col("last_seen") == F.col("as_of")}).drop("as_of")


@query("JN-11-exits", LAST + """, p AS (SELECT label, CAST(split_part(label, ' ', 2) AS INT) AS k, n FROM a), f AS (SELECT label, min(week) AS first_seen FROM snapshots, m WHERE week < w GROUP BY 1), j AS (SELECT p.*, b.label IS NOT NULL AS still FROM p LEFT JOIN b USING (label))
  SELECT label, n AS prior_n, first_seen, CASE WHEN k % 7 = 0 THEN 'resolved_by_curator' WHEN still THEN 'mapped_by_rules_change' ELSE 'no_longer_in_registry' END AS cause, CASE WHEN still AND k % 3 = 0 THEN 'mapped' END AS bucket_after FROM j JOIN f USING (label) WHERE NOT (still AND k % 3 <> 0 AND k % 7 <> 0)""")
def inbox_exits(spark, sf_dir):
    """Labels that were open the week before and no longer are; every third gets a bucket by this week's rules, every seventh a curator's note."""
    before, now = last_two(spark, sf_dir)
    k = F.split("label", " ")[1].cast("int")
    s = snapshots(spark, sf_dir)
    first = s.join(F.broadcast(s.agg(F.max("week").alias("w")))).filter("week < w").groupBy("label").agg(F.min("week").alias("first_seen"))
    prior = before.select("label", F.col("n").alias("prior_n")).join(first, "label").withColumn("resolved", F.when(k % 7 == 0, "seen"))
    return H.exits(prior, now.select("label", F.when(k % 3 == 0, "mapped").alias("bucket")), "label", True)


@query("JN-12", LAST + " SELECT label, a.n AS n_before, b.n AS n_now FROM a JOIN b USING (label) WHERE a.n <> b.n")
def bucket_changes(spark, sf_dir):
    a, b = last_two(spark, sf_dir)
    return a.select("label", F.col("n").alias("n_before")).join(b.select("label", F.col("n").alias("n_now")), "label").filter("n_before <> n_now")


@query("JN-13", LAST + " SELECT coalesce(a.label, b.label) AS metric, b.n AS now, a.n AS prior, b.n - a.n AS delta FROM a FULL JOIN b ON a.label = b.label")
def metric_delta(spark, sf_dir):
    a, b = (x.select(F.col("label").alias("metric"), F.col("n").alias("value")) for x in last_two(spark, sf_dir))
    return H.metric_delta(a, b)


@query("WIN-5", f"""WITH {SNAPSHOTS}, d AS (SELECT DISTINCT CAST(ts AS DATE) AS date FROM events), m AS (SELECT max(date) AS latest FROM d), old AS (SELECT date, CAST(floor(date_diff('day', DATE '2024-01-01', date) / 14.0) AS BIGINT) AS f, strftime(date, '%Y-%m') AS mo FROM d, m WHERE date < latest),
  c AS (SELECT date FROM (SELECT min(date) AS date, f, row_number() OVER (ORDER BY f DESC) AS k FROM old GROUP BY f) WHERE k <= 2), cov AS (SELECT strftime(date, '%Y-%m') AS mo FROM c UNION SELECT strftime(latest, '%Y-%m') FROM m)
  SELECT date, 'complete' AS kept_as FROM c UNION ALL SELECT max(date), 'aggregate' FROM old WHERE date NOT IN (SELECT date FROM c) AND mo NOT IN (SELECT mo FROM cov) GROUP BY mo""")
def retention(spark, sf_dir):
    days = table(spark, sf_dir, "events").select(F.to_date("ts").alias("date")).distinct()
    latest = days.agg(F.max("date").alias("m")).first()["m"]  # one date
    return H.retention(days, F.lit(latest), "2024-01-01", 2)


@query("WIN-8", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def head_revisions(spark, sf_dir):
    return H.head_revisions(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("JN-5", """WITH m AS (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS mid FROM events), s AS (SELECT user_id, max(event_id) AS held FROM events, m WHERE ts < mid GROUP BY 1), h AS (SELECT user_id, event_id AS offered, event_type = 'error' AS w FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM events) WHERE k = 1)
  SELECT coalesce(s.user_id, h.user_id) AS user_id, held, offered, CASE WHEN offered IS NULL THEN 'untouched' WHEN w AND held IS NULL THEN 'ignore' WHEN held IS NULL THEN 'insert' WHEN offered <= held THEN 'keep' WHEN w THEN 'delete' ELSE 'update' END AS action FROM s FULL JOIN h ON s.user_id = h.user_id""")
def upsert(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    span = e.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).select((F.col("a") + (F.col("b") - F.col("a")) / 2).alias("mid"))
    state = e.join(F.broadcast(span)).filter("ts < mid").groupBy("user_id").agg(F.max("event_id").alias("event_id"))
    return H.upsert(state, H.head_revisions(e, "user_id", ["event_id"]), "user_id", "event_id", F.col("event_type") == "error")


@query("JN-5-chains", """WITH RECURSIVE r AS (SELECT o_orderkey AS id, CASE o_orderkey % 40 WHEN 1 THEN o_orderkey + 2 WHEN 3 THEN o_orderkey - 2 WHEN 5 THEN o_orderkey ELSE prior END AS replaces, o_orderstatus = 'P' AS withdrawn
    FROM (SELECT *, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS prior FROM orders)),
  x AS (SELECT r.id, r.replaces, r.withdrawn, r.replaces = r.id OR (r.replaces IS NOT NULL AND t.id IS NULL) AS stray FROM r LEFT JOIN r t ON t.id = r.replaces),
  b AS (SELECT replaces AS id, count(*) AS n, min(id) AS nxt FROM x WHERE replaces IS NOT NULL AND NOT stray GROUP BY 1),
  l AS (SELECT x.id, withdrawn, coalesce(stray, false) OR coalesce(n, 0) > 1 AS bad, CASE WHEN n = 1 THEN nxt END AS nxt FROM x LEFT JOIN b ON x.id = b.id),
  w AS (SELECT id, id AS tip, bad, 0 AS depth, [id] AS seen, false AS loops FROM l UNION ALL SELECT w.id, l.nxt, w.bad OR n.bad, w.depth + 1, list_append(w.seen, l.nxt), list_contains(w.seen, l.nxt) FROM w JOIN l ON w.tip = l.id JOIN l n ON n.id = l.nxt WHERE NOT w.loops),
  e AS (SELECT id, bool_or(bad OR loops) AS bad, max(depth) AS depth, max_by(tip, depth) AS head FROM w GROUP BY 1)
  SELECT e.id, CASE WHEN NOT e.bad THEN head END AS head, CASE WHEN NOT e.bad THEN CAST(depth AS BIGINT) END AS depth, CASE WHEN e.bad THEN 'quarantined' WHEN h.withdrawn THEN 'withdrawn' WHEN head = e.id THEN 'current' ELSE 'superseded' END AS state FROM e JOIN l h ON h.id = head""")
def chains(spark, sf_dir):
    """Each order of a customer replaces the one before it; some name each other, themselves, or one that is not there."""
    prior = F.lag("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    k = F.col("o_orderkey") % 40
    replaces = F.when(k == 1, F.col("o_orderkey") + 2).when(k == 3, F.col("o_orderkey") - 2).when(k == 5, F.col("o_orderkey")).otherwise(F.col("prior"))
    records = table(spark, sf_dir, "orders").withColumn("prior", prior).select(F.col("o_orderkey").alias("id"), replaces.alias("replaces"), (F.col("o_orderstatus") == "P").alias("withdrawn"))
    return H.supersession(records)


WINNERS = ", ".join(f"(SELECT label FROM o{where} ORDER BY {order}, label LIMIT 1) AS {name}{also}" for also, where in (("", ""), ("_error", " WHERE label LIKE 'error%'")) for name, order in (("oldest", "first_seen, n DESC"), ("largest", "n DESC")))


@query("WIN-7", f"WITH {SNAPSHOTS}, o AS (SELECT label, min(week) AS first_seen, sum(n) AS n FROM snapshots GROUP BY 1) SELECT {WINNERS}")
def oldest_and_largest(spark, sf_dir):
    """Over all open items, and over one class of them."""
    o = snapshots(spark, sf_dir).groupBy("label").agg(F.min("week").alias("first_seen"), F.sum("n").alias("n"))
    few = -F.col("n")
    best = [F.min(F.when(c, F.struct(*order, "label"))).alias(f"{name}{also}") for also, c in (("", F.lit(True)), ("_error", F.col("label").startswith("error"))) for name, order in (("oldest", ["first_seen", few.alias("n")]), ("largest", [few.alias("n")]))]
    return o.agg(*best).select(*[F.col(f"{n}.label").alias(n) for n in ("oldest", "largest", "oldest_error", "largest_error")])


@query("DQ-12", f"WITH {SNAPSHOTS}, w AS (SELECT week, count(*) AS n_labels, sum(n) AS n FROM snapshots GROUP BY 1) SELECT week, n_labels, CAST(n AS BIGINT) AS n, coalesce(n < 0.9 * lag(n) OVER (ORDER BY week), FALSE) AS shrank FROM w")
def shrinkage(spark, sf_dir):
    from pyspark.sql import Window

    w = snapshots(spark, sf_dir).groupBy("week").agg(F.count("*").alias("n_labels"), F.sum("n").alias("n"))
    return w.withColumn("shrank", F.coalesce(F.col("n") < 0.9 * F.lag("n").over(Window.orderBy("week")), F.lit(False)))
