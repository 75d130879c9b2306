"""The given tables as registry views; nothing else in the library knows them. Each view has its SQL beside it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What the seven line numbers, three flags and two states of the line items stand for here.
LABELS = ["Female", "Male ", "Women", "Unknown or Not Reported", "Non-binary", "Transgender female*", "Total"]
TITLES = {"A": "Sex: Female, Male", "N": "Sex/Gender, Customized", "R": "Race (NIH/OMB)"}
UNITS = {"F": "Participants", "O": "Percentage of Participants"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _id(key: str):
    return F.concat(F.lit("NCT"), F.lpad(F.col(key).cast("string"), 8, "0"))


def registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per trial, without its enrolment: orders with their customer as lead sponsor."""
    return table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        _id("o_orderkey").alias("nct_id"), F.col("c_name").alias("lead"), F.col("c_mktsegment").alias("class"), F.col("c_nationkey").alias("nation"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("phase"), F.to_date("o_orderdate").alias("results_date"), F.year("o_orderdate").cast("bigint").alias("year"), F.col("o_totalprice").alias("price"),
    )


def studies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per trial, enrolment from the line items."""
    enrolled = table(spark, sf_dir, "lineitem").groupBy(_id("l_orderkey").alias("nct_id")).agg(F.sum("l_quantity").cast("bigint").alias("enrollment"))
    return registered(spark, sf_dir).join(enrolled, "nct_id", "left")


STUDIES = """studies AS (SELECT 'NCT' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS nct_id, c_name AS lead, c_mktsegment AS class, c_nationkey AS nation, o_orderstatus AS status,
  o_orderpriority AS phase, CAST(o_orderdate AS DATE) AS results_date, CAST(year(o_orderdate) AS BIGINT) AS year, o_totalprice AS price, enrollment
  FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN (SELECT l_orderkey, CAST(sum(l_quantity) AS BIGINT) AS enrollment FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey)"""


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baseline cells in long form: trial, measure, label, unit and count."""
    labels = F.array(*[F.lit(x) for x in LABELS])
    titles, units = (F.create_map(*[F.lit(x) for kv in m.items() for x in kv]) for m in (TITLES, UNITS))
    return table(spark, sf_dir, "lineitem").select(
        _id("l_orderkey").alias("nct_id"), F.element_at(titles, F.col("l_returnflag")).alias("title"), F.element_at(units, F.col("l_linestatus")).alias("unit"),
        F.get(labels, F.pmod(F.col("l_linenumber") - 1, F.lit(7))).alias("label"), F.col("l_quantity").alias("value"), F.to_date("l_shipdate").alias("completed"), F.col("l_suppkey").alias("site"), F.col("l_partkey").alias("device"),
    )


def _case(column: str, values: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + " END"


CELLS = f"""cells AS (SELECT 'NCT' || lpad(CAST(l_orderkey AS VARCHAR), 8, '0') AS nct_id, {_case("l_returnflag", TITLES)} AS title, {_case("l_linestatus", UNITS)} AS unit,
  [{", ".join(f"'{x}'" for x in LABELS)}][(l_linenumber - 1) % 7 + 1] AS label, l_quantity AS value, CAST(l_shipdate AS DATE) AS completed, l_suppkey AS site, l_partkey AS device FROM lineitem)"""


def sponsors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nct_id, agency_class, role, name: the customer leads, suppliers of the lines collaborate."""
    lead = registered(spark, sf_dir).select("nct_id", F.col("class").alias("agency_class"), F.lit("lead").alias("role"), F.concat(F.lit("Holding "), F.substring("lead", -2, 2), F.lit(", Inc.")).alias("name"))
    sites = table(spark, sf_dir, "lineitem").select(_id("l_orderkey").alias("nct_id"), "l_suppkey").distinct()
    helpers = sites.join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    name = F.when(F.col("s_nationkey") < 5, F.concat(F.lit("Unit "), F.substring("s_name", -3, 3), F.lit(", a wholly owned subsidiary of Holding "), F.substring("s_name", -2, 2), F.lit(" Corp."))).otherwise(F.concat(F.lit("HOLDING "), F.substring("s_name", -2, 2), F.lit(" Co., Ltd.")))
    return lead.unionByName(helpers.select("nct_id", F.lit("OTHER").alias("agency_class"), F.lit("collaborator").alias("role"), name.alias("name")))


SPONSORS = f"""{STUDIES}, sponsors AS (SELECT nct_id, class AS agency_class, 'lead' AS role, 'Holding ' || right(lead, 2) || ', Inc.' AS name FROM studies
  UNION ALL SELECT 'NCT' || lpad(CAST(l_orderkey AS VARCHAR), 8, '0'), 'OTHER', 'collaborator',
    CASE WHEN s_nationkey < 5 THEN 'Unit ' || right(s_name, 3) || ', a wholly owned subsidiary of Holding ' || right(s_name, 2) || ' Corp.' ELSE 'HOLDING ' || right(s_name, 2) || ' Co., Ltd.' END
  FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) JOIN supplier ON l_suppkey = s_suppkey)"""


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly label snapshots from the events: week (its Monday), label, n."""
    e = table(spark, sf_dir, "events")
    label = F.concat(F.col("event_type"), F.lit(" "), F.pmod(F.get_json_object("props", "$.k").cast("int"), F.lit(40)).cast("string"))
    return e.select(F.to_date(F.date_trunc("week", "ts")).alias("week"), label.alias("label")).groupBy("week", "label").agg(F.count("*").alias("n"))


SNAPSHOTS = """snapshots AS (SELECT CAST(date_trunc('week', ts) AS DATE) AS week, event_type || ' ' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 40 AS VARCHAR) AS label, count(*) AS n FROM events GROUP BY 1, 2)"""
