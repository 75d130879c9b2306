"""Queries over documents, pages, devices and the links between them."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import links as K
from ..operators.walk import record_texts
from .bindings import table
from .registry import query

#: Conditions of the parts' names: primary category, secondary, keywords.
ONTOLOGY = {
    "Metabolic": {"Ring": ["ring"], "Small Ring": ["small ring"], "Diabetes": ["diabet"]},
    "Neurology": {"Widget": ["widget"]},
    "Oncology": {"Red": ["red"], "Blue": ["blue"]},
    "Respiratory": {"Gear": ["gear"]},
    "Surgery": {"Spring": ["steel coil spring"]},
}
KEYWORDS = K.keyword_rows(ONTOLOGY)
KEYWORD_SQL = "kw(keyword, prim, sec, pos) AS (VALUES " + ", ".join(str(k) for k in KEYWORDS) + ")"
KEYWORD_SCHEMA = "keyword string, primary string, secondary string, position int"


@query("VOC-19", """SELECT page_id, link, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS link FROM pages) GROUP BY 1, 2""")
def page_links(spark, sf_dir):
    found = F.explode(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1)))
    return table(spark, sf_dir, "pages").select("page_id", found.alias("link")).groupBy("page_id", "link").agg(F.count("*").alias("n"))


N8, N6 = "lpad(CAST(doc_id % 100000000 AS VARCHAR), 8, '0')", "lpad(CAST(doc_id % 1000000 AS VARCHAR), 6, '0')"


def with_citation(spark, sf_dir):
    """Two pages of every document: its text, and one that cites something by the document's number; some citations are not whole tokens."""
    d = F.col("doc_id")
    n8, n6 = (F.lpad((d % 10**k).cast("string"), k, "0") for k in (8, 6))
    says = [
        F.concat(F.lit("See N C T "), F.left(n8, F.lit(4)), F.lit(" "), F.right(n8, F.lit(4)), F.lit(" here.")), F.concat(F.lit("(NCT#: "), n8, F.lit(")")), F.concat(F.lit("NCT"), n8, F.lit("ABC")), F.concat(F.lit("ISRCTN "), n8), F.concat(F.lit("2012-"), n6, F.lit("-11")),
        F.concat(F.lit("IDE No. G"), n6), F.concat(F.lit("doi 10.1000/x."), n6, F.lit(").")), F.concat(F.lit("PMID: "), n8), F.concat(F.lit("K"), n6, F.lit(" and P"), n6, F.lit("/S008, not XK"), n6), F.concat(F.lit("DEN"), n6), F.concat(F.lit("UMIN0"), n8), F.lit("nothing"),
    ]
    page = F.get(F.array(*says), (d % len(says)).cast("int"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.when(d % 24 == 8, F.concat(F.lit("K"), n6)).alias("own"), page.alias("cited"))
    return docs.select("doc_id", "own", F.posexplode(F.array("text", "cited")).alias("page", "text")).withColumn("page", F.col("page") + 1)


@query("VOC-14", f"""SELECT doc_id, 2 AS page, x.kind AS kind, x.id AS identifier FROM (SELECT doc_id, unnest(CASE doc_id % 12 WHEN 0 THEN [{{'kind': 'nct', 'id': 'NCT' || {N8}}}] WHEN 1 THEN [{{'kind': 'nct', 'id': 'NCT' || {N8}}}] WHEN 3 THEN [{{'kind': 'isrctn', 'id': 'ISRCTN ' || {N8}}}]
  WHEN 4 THEN [{{'kind': 'eudract', 'id': '2012-' || {N6} || '-11'}}] WHEN 5 THEN [{{'kind': 'ide', 'id': 'G' || {N6}}}] WHEN 6 THEN [{{'kind': 'doi', 'id': '10.1000/x.' || {N6}}}] WHEN 7 THEN [{{'kind': 'pmid', 'id': {N8}}}] WHEN 9 THEN [{{'kind': 'submission_number', 'id': 'DEN' || {N6}}}]
  WHEN 8 THEN list_filter([{{'kind': 'submission_number', 'id': CASE WHEN doc_id % 24 <> 8 THEN 'K' || {N6} END}}, {{'kind': 'submission_number', 'id': 'P' || {N6} || '/S008'}}], lambda y: y.id IS NOT NULL) WHEN 10 THEN [{{'kind': 'jprn_umin', 'id': 'UMIN0' || {N8}}}] END) AS x FROM (SELECT DISTINCT doc_id FROM documents))""")
def identifiers(spark, sf_dir):
    return K.identifiers(with_citation(spark, sf_dir), ["doc_id", "page"], "text", "own")


SENTENCES = ["No clinical studies were required.", "Clinical testing was not performed.", "A pivotal study of 120 patients was done.", "Patients were enrolled at two sites.", "Standalone performance was measured.", "The lens is glass."]


@query("VOC-15", """WITH k AS (SELECT doc_id, source, doc_id % 6 AS i, doc_id % 5 = 0 AS cites, doc_id % 7 <> 0 AS readable FROM documents) SELECT doc_id, CAST(i IN (2, 3) AS BIGINT) AS n_human_study, CAST(i IN (2, 4) AS BIGINT) AS n_data_test, CAST(i IN (0, 1) AS BIGINT) AS n_no_study,
  CASE WHEN NOT readable THEN 'not_assessable_no_text' WHEN cites THEN 'cites_registry_identifier' WHEN i IN (2, 3, 4) THEN 'describes_study_no_registry_identifier' WHEN i < 2 THEN 'states_no_clinical_study_only' ELSE 'no_study_language_found' END AS state FROM k""")
def study_language(spark, sf_dir):
    """Every document with a sentence of its own behind its text, which says nothing of studies."""
    i = F.col("doc_id") % len(SENTENCES)
    text = F.concat(F.coalesce("text", F.lit("")), F.lit(". "), F.get(F.array(*map(F.lit, SENTENCES)), i.cast("int")))
    d = table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))
    found = K.study_language(K.sentences(d, ["doc_id"], "text"), ["doc_id"])
    return found.select("doc_id", "n_human_study", "n_data_test", "n_no_study", K.study_description(F.col("doc_id") % 7 != 0, F.col("doc_id") % 5 == 0).alias("state"))


@query("VOC-15-terms", r"""WITH s AS (SELECT doc_id, trim(unnest(regexp_split_to_array(text, '[.!?]\s+'))) AS sentence FROM documents), t AS (SELECT * FROM s WHERE sentence <> '')
  SELECT doc_id, count(*) AS n_sentences, count_if(regexp_matches(sentence, 'Licensed|License')) AS n_mentions, CASE WHEN bool_or(regexp_matches(sentence, 'Licensed|License') AND regexp_matches(sentence, 'WITHOUT|without')) THEN 'negated' WHEN count_if(regexp_matches(sentence, 'Licensed|License')) > 0 THEN 'stated' ELSE 'not_mentioned' END AS state FROM t GROUP BY 1""")
def term_mentions(spark, sf_dir):
    return K.term_mentions(K.sentences(table(spark, sf_dir, "documents"), ["doc_id"], "text"), ["doc_id"], "Licensed|License", "WITHOUT|without")


CONDITIONS = ["coil spring steel", "steel coill sprng", "Blue widgets, of steel and brass", "type 2 diabetes mellitus", None]


@query("VOC-11", f"""WITH {KEYWORD_SQL}, n AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'coil spring steel' WHEN 1 THEN 'steel coill sprng' WHEN 2 THEN 'blue widgets of steel and brass' WHEN 3 THEN 'type 2 diabetes mellitus' ELSE lower(p_name) END AS name FROM part),
  h AS (SELECT p_partkey, prim, sec, row_number() OVER (PARTITION BY p_partkey ORDER BY length(keyword) DESC, pos) AS k FROM n JOIN kw ON contains(name, keyword))
  SELECT n.p_partkey, CASE WHEN n.p_partkey % 5 = 1 THEN 'Surgery' ELSE coalesce(prim, 'Other') END AS primary, CASE WHEN n.p_partkey % 5 = 1 THEN 'Spring' ELSE coalesce(sec, 'Uncategorized') END AS secondary FROM n LEFT JOIN h ON n.p_partkey = h.p_partkey AND k = 1""")
def condition_categories(spark, sf_dir):
    """Some names hold keywords within their words, some only words like a keyword's."""
    given = F.get(F.array(*[F.lit(c) for c in CONDITIONS]), (F.col("p_partkey") % len(CONDITIONS)).cast("int"))
    names = table(spark, sf_dir, "part").select("p_partkey", F.coalesce(given, "p_name").alias("name"))
    return K.longest_keyword(names, "name", spark.createDataFrame(KEYWORDS, KEYWORD_SCHEMA)).select("p_partkey", "primary", "secondary")


@query("VOC-12", f"""WITH {KEYWORD_SQL}, c AS (SELECT p_partkey, coalesce(max_by(prim, length(keyword) * 1000 - pos), 'Other') AS prim FROM part LEFT JOIN kw ON contains(lower(p_name), keyword) GROUP BY 1),
  n AS (SELECT l_orderkey, prim, count(*) AS n FROM lineitem JOIN c ON l_partkey = p_partkey GROUP BY 1, 2) SELECT l_orderkey, prim AS primary, n FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, prim DESC) AS k FROM n) WHERE k = 1""")
def study_categories(spark, sf_dir):
    parts = K.longest_keyword(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", spark.createDataFrame(KEYWORDS, KEYWORD_SCHEMA))
    lines = table(spark, sf_dir, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return K.most_frequent(lines, "l_orderkey", "primary", "secondary", F.col("l_linenumber")).select("l_orderkey", "primary", "n")


@query("FLT-20", "SELECT doc_id, length(regexp_replace(text, '[^a-zA-Z]', '', 'g')) AS n_letters, length(text) AS n_chars, length(text) > 50 AND length(regexp_replace(text, '[^a-zA-Z]', '', 'g')) * 10 < length(text) * 6 AS garbled FROM documents")
def garbled_pages(spark, sf_dir):
    letters, n = F.length(F.regexp_replace("text", "[^a-zA-Z]", "")), F.char_length("text")
    return table(spark, sf_dir, "documents").select("doc_id", letters.cast("bigint").alias("n_letters"), n.cast("bigint").alias("n_chars"), ((n > 50) & (letters * 10 < n * 6)).alias("garbled"))


@query("FLT-26", r"""WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS page FROM documents) SELECT doc_id, count(*) AS n_pages, count_if(length(page) >= 20) AS n_text, CASE WHEN count_if(length(page) >= 20) = count(*) THEN 'text' WHEN count_if(length(page) >= 20) = 0 THEN 'image_only' ELSE 'partial' END AS status FROM p GROUP BY 1""")
def text_status(spark, sf_dir):
    p = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("page"))
    n, t = F.count("*"), F.count_if(F.char_length("page") >= 20)
    return p.groupBy("doc_id").agg(n.alias("n_pages"), t.alias("n_text"), F.when(t == n, "text").when(t == 0, "image_only").otherwise("partial").alias("status"))


@query("FLT-21", "SELECT p_name, p_brand, count(*) AS n_rows, CASE WHEN count(DISTINCT p_size) > 1 THEN 'substantive_conflict' WHEN count(DISTINCT p_type) > 1 THEN 'alias_only' ELSE 'identical' END AS duplicate_class FROM part GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_rows(spark, sf_dir):
    return K.duplicate_class(table(spark, sf_dir, "part"), ["p_name", "p_brand"], ["p_type"], ["p_size"])


@query("AGG-20", "SELECT p_brand, arg_min(p_name, p_partkey) AS shown, CASE WHEN count(DISTINCT p_size) = 1 THEN min(p_size) END AS agreed, count(*) AS n_rows FROM part GROUP BY 1")
def submissions(spark, sf_dir):
    return K.folded(table(spark, sf_dir, "part"), "p_brand", "p_partkey", "p_name", "p_size").drop("listed")


@query("AGG-21", "SELECT p_name AS family, count(*) AS n_members, count(DISTINCT p_brand) AS n_organisations, min(p_partkey) AS first_member, array_to_string(list_sort(list(DISTINCT p_type)), ',') AS pathways FROM part GROUP BY 1")
def families(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("family")).agg(F.count("*").alias("n_members"), F.count_distinct("p_brand").alias("n_organisations"), F.min("p_partkey").alias("first_member"), F.array_join(F.array_sort(F.collect_set("p_type")), ",").alias("pathways"))


@query("JN-26", "SELECT p_name, count(*) AS n_records, CASE WHEN count(*) = 1 THEN min(p_brand) END AS p_brand, CASE WHEN count(*) = 1 THEN 'available' ELSE 'several_records' END AS state FROM part GROUP BY 1")
def official_record(spark, sf_dir):
    return K.exactly_one(table(spark, sf_dir, "part"), "p_name", ["p_brand"])


@query("JN-17", """WITH t AS (SELECT p_partkey AS title_id, lower(p_type || ' ' || p_name || ' ' || replace(p_brand, '#', ' ')) AS title FROM part), f AS (SELECT DISTINCT p_name AS form, 1 AS strength FROM part UNION SELECT DISTINCT lower(p_type), 2 FROM part),
  h AS (SELECT title_id, form, strength FROM t JOIN f ON contains(' ' || title || ' ', ' ' || form || ' ')), n AS (SELECT form, count(DISTINCT title_id) AS n_titles FROM h GROUP BY 1)
  SELECT title_id, form, strength, n_titles, n_titles >= 50 AS is_common FROM (SELECT h.*, row_number() OVER (PARTITION BY title_id ORDER BY strength, form) AS k FROM h) JOIN n USING (form) WHERE k = 1""")
def name_matches(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    forms = p.select(F.col("p_name").alias("form"), F.lit(1).alias("strength")).distinct().unionByName(p.select(F.lower("p_type").alias("form"), F.lit(2).alias("strength")).distinct())
    return K.name_matches(forms, p.select(F.col("p_partkey").alias("title_id"), F.concat_ws(" ", "p_type", "p_name", "p_brand").alias("title")))


@query("JN-14", """WITH l AS (SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN doc_id + 1000000000 ELSE doc_id END AS id, CASE WHEN quality = 1 THEN 'accepted' ELSE 'rejected' END AS decision FROM labels)
  SELECT d.doc_id, coalesce(decision, 'unreviewed') AS review_state FROM documents d LEFT JOIN l ON d.doc_id = l.id UNION ALL SELECT id, 'orphaned_' || decision FROM l WHERE id NOT IN (SELECT doc_id FROM documents)""")
def reviewed_documents(spark, sf_dir):
    """Reviews of documents that no longer exist are returned, not thrown away: every tenth label is given such an id."""
    key = F.when(F.col("doc_id") % 10 == 0, F.col("doc_id") + 1_000_000_000).otherwise(F.col("doc_id"))
    reviews = table(spark, sf_dir, "labels").select(key.alias("doc_id"), F.when(F.col("quality") == 1, "accepted").otherwise("rejected").alias("decision"))
    joined, orphans = K.with_reviews(table(spark, sf_dir, "documents").select("doc_id"), reviews, "doc_id")
    return joined.select("doc_id", "review_state").unionByName(orphans.select("doc_id", F.concat(F.lit("orphaned_"), "decision").alias("review_state")))


@query("JN-16", """WITH p AS (SELECT p_partkey, 'P' || lpad(CAST(p_partkey % 1000000 AS VARCHAR), 6, '0') AS base, p_partkey % 8 AS k FROM part) SELECT p_partkey, 'outcome' AS path, base || '/S008' AS number, k IN (1, 2) AS supplement_cited FROM p WHERE k IN (0, 1, 2)
  UNION ALL SELECT p_partkey, 'outcome', base, NULL FROM p WHERE k IN (0, 6)""")
def cited_submissions(spark, sf_dir):
    """A trial's outcome cites a submission by the part's number: alone, with its supplement, with another, in lower case, or within a longer token."""
    fields, numbers = citing(spark, sf_dir)
    return K.cited_numbers(fields.withColumn("path", F.lit("outcome")), numbers).select(F.col("id").alias("p_partkey"), "path", "number", "supplement_cited")


def citing(spark, sf_dir):
    """(id, text) of each part's outcome, and the numbers sought."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.lpad((F.col("p_partkey") % 1_000_000).cast("string"), 6, "0").alias("n"), (F.col("p_partkey") % 8).cast("int").alias("k"))
    says = [F.concat(F.lit("cleared as P"), "n", F.lit(".")), F.concat(F.lit("under P"), "n", F.lit("/S008")), F.concat(F.lit("under p"), "n", F.lit(" - s008 here")), F.concat(F.lit("under P"), "n", F.lit("/S007")), F.concat(F.lit("P"), "n", F.lit("/S0089")), F.concat(F.lit("XP"), "n"), F.concat(F.lit("(p"), "n", F.lit(")")), F.lit("none")]
    base = F.concat(F.lit("P"), "n")
    numbers = p.select(F.explode(F.array(F.when(F.col("k") != 6, F.concat(base, F.lit("/S008"))), base)).alias("number")).filter("number is not null").distinct()
    return p.select(F.col("p_partkey").alias("id"), F.get(F.array(*says), F.col("k")).alias("text")), numbers


@query("JN-16-walk", """WITH p AS (SELECT p_partkey, 'P' || lpad(CAST(p_partkey % 1000000 AS VARCHAR), 6, '0') AS base, p_partkey % 8 AS k, ['title', 'outcomes[].measure', 'arms[].groups[].note', 'links.cited[]'][p_partkey % 4 + 1] AS path FROM part) SELECT p_partkey, path, base || '/S008' AS number, k IN (1, 2) AS supplement_cited FROM p WHERE k IN (0, 1, 2)
  UNION ALL SELECT p_partkey, path, base, NULL FROM p WHERE k IN (0, 6)""")
def cited_anywhere(spark, sf_dir):
    """The same citations, each in another field of a nested record; the walk finds them wherever they stand."""
    fields, numbers = citing(spark, sf_dir)
    t = F.col("text")
    there = [F.struct(t.alias("title")), F.struct(F.array(F.struct(F.lit(7).alias("n"), t.alias("measure"))).alias("outcomes")), F.struct(F.array(F.struct(F.array(F.struct(F.lit("Arm").alias("title"), t.alias("note"))).alias("groups"))).alias("arms")), F.struct(F.struct(F.array(F.lit("none"), t).alias("cited")).alias("links"))]
    shape = (F.col("id") % 4).cast("int")
    records = fields.select("id", F.get(F.array(*map(F.to_json, there)), shape).alias("record"))
    return K.cited_numbers(record_texts(records, "id", "record"), numbers).select(F.col("id").alias("p_partkey"), "path", "number", "supplement_cited")


@query("JN-24", """WITH b AS (SELECT p_partkey, p_brand, p_type, p_size FROM part), o AS (SELECT p_partkey, p_brand, CASE WHEN p_size > 25 THEN 'STANDARD' ELSE p_type END AS p_type, CASE WHEN p_size > 40 THEN NULL ELSE p_size END AS p_size FROM part)
  SELECT p_partkey, 'p_type' AS field, b.p_type AS listed, o.p_type AS official FROM b JOIN o USING (p_partkey) WHERE b.p_type IS DISTINCT FROM o.p_type UNION ALL SELECT p_partkey, 'p_size', CAST(b.p_size AS VARCHAR), CAST(o.p_size AS VARCHAR) FROM b JOIN o USING (p_partkey) WHERE b.p_size IS DISTINCT FROM o.p_size""")
def metadata_differences(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    official = p.withColumns({"p_type": F.when(F.col("p_size") > 25, "STANDARD").otherwise(F.col("p_type")), "p_size": F.when(F.col("p_size") <= 40, F.col("p_size"))})
    return K.differences(p, official, "p_partkey", ["p_brand", "p_type", "p_size"])


@query("AGG-31", "SELECT l_orderkey, CASE WHEN bool_or(l_returnflag = 'A') THEN 'A' WHEN bool_or(l_returnflag = 'R') THEN 'R' ELSE 'N' END AS overall, count(*) AS n_routes, count_if(l_linestatus = 'F' AND l_returnflag = 'A') AS f_a, count_if(l_linestatus = 'F') AS f_any, count_if(l_linestatus = 'O') AS o_any, CASE WHEN bool_or(l_linestatus = 'O') THEN CASE WHEN bool_or(l_linestatus = 'O' AND l_returnflag = 'A') THEN 'A' WHEN bool_or(l_linestatus = 'O' AND l_returnflag = 'R') THEN 'R' ELSE 'N' END ELSE 'not_tried' END AS route_o FROM lineitem GROUP BY 1")
def coverage_status(spark, sf_dir):
    """The best state over all routes, and each route's own cell: how many of what, and its best state, which is not_tried without any."""
    lines = table(spark, sf_dir, "lineitem")
    whole = K.best_state(lines, "l_orderkey", "l_returnflag", ["A", "R", "N"])
    o = K.best_state(lines.filter("l_linestatus = 'O'"), "l_orderkey", "l_returnflag", ["A", "R", "N"]).select("l_orderkey", F.col("overall").alias("route_o"))
    f, a = F.col("l_linestatus") == "F", F.col("l_returnflag") == "A"
    cells = lines.groupBy("l_orderkey").agg(F.count_if(f & a).alias("f_a"), F.count_if(f).alias("f_any"), F.count_if(~f).alias("o_any"))
    return whole.join(cells, "l_orderkey").join(o, "l_orderkey", "left").na.fill("not_tried", ["route_o"])


@query("WIN-1", """WITH m AS (SELECT conv_id, role, count(*) AS n_turns, sum(length(text)) AS n_chars, min(turn) AS pos, conv_id % 5 = 0 AND role = 'assistant' OR conv_id % 7 = 0 AS failed FROM conversations GROUP BY 1, 2)
  SELECT conv_id, role, n_turns, NOT failed AS succeeded FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY failed, n_chars DESC, CASE role WHEN 'assistant' THEN 2 WHEN 'user' THEN 1 ELSE 0 END DESC, pos) AS k FROM m) WHERE k = 1""")
def primary_model(spark, sf_dir):
    """Most said, then capability, then first; failed calls are passed over unless all failed."""
    failed = ((F.col("conv_id") % 5 == 0) & (F.col("role") == "assistant")) | (F.col("conv_id") % 7 == 0)
    m = table(spark, sf_dir, "conversations").groupBy("conv_id", "role").agg(F.count("*").alias("n_turns"), F.sum(F.char_length("text")).alias("n_chars"), F.min("turn").alias("pos")).withColumn("failed", failed)
    rank = F.when(F.col("role") == "assistant", 2).when(F.col("role") == "user", 1).otherwise(0)
    best = Window.partitionBy("conv_id").orderBy("failed", F.desc("n_chars"), rank.desc(), "pos")
    return m.withColumn("k", F.row_number().over(best)).filter("k = 1").select("conv_id", "role", "n_turns", (~F.col("failed")).alias("succeeded"))


@query("AGG-29", "SELECT role, count(*) AS n_calls, sum(length(text)) AS n_chars, round(sum(length(text) * CASE role WHEN 'assistant' THEN 15.0 WHEN 'user' THEN 3.0 ELSE 1.0 END) / 1e6, 6) AS cost FROM conversations GROUP BY 1")
def token_costs(spark, sf_dir):
    rate = spark.createDataFrame([("assistant", 15.0), ("user", 3.0), ("", 1.0)], "family string, rate double")
    c = table(spark, sf_dir, "conversations").select("role", F.char_length("text").cast("bigint").alias("n")).groupBy("role").agg(F.count("*").alias("n_calls"), F.sum("n").alias("n_chars"))
    priced = c.join(F.broadcast(rate), F.col("family") == F.when(F.col("role").isin("assistant", "user"), F.col("role")).otherwise(""))
    return priced.select("role", "n_calls", "n_chars", F.round(F.col("n_chars") * F.col("rate") / 1e6, 6).alias("cost"))


@query("WIN-6", """WITH l AS (SELECT l_partkey AS entity, CASE l_linenumber % 3 WHEN 0 THEN 'device_name_match' WHEN 1 THEN 'device_name_and_organisation_match' ELSE 'registry_citation' END AS method, CASE WHEN l_suppkey % 4 = 0 THEN 'identifier_confirmed' WHEN l_suppkey % 4 = 1 THEN 'rejected_by_rule' WHEN l_suppkey % 4 = 2 THEN 'identifier_not_resolved' ELSE 'name_rule' END AS validation FROM lineitem WHERE l_quantity > 40),
  n AS (SELECT entity, count_if(validation = 'identifier_confirmed') AS t1, count_if(method = 'device_name_and_organisation_match') AS t2, count_if((method = 'device_name_match' AND validation <> 'rejected_by_rule') OR validation = 'identifier_not_resolved') AS t4 FROM l GROUP BY 1),
  d AS (SELECT p_partkey AS entity, p_size % 5 = 0 AS done, CAST(p_size % 2 = 0 AS INT) AS t3, CAST(p_size % 2 = 0 AND p_size % 3 = 0 AS INT) AS r, CAST(p_size % 2 = 0 AND p_size % 7 = 0 AS INT) AS s FROM part), b AS (SELECT entity, coalesce(t1, 0) AS t1, coalesce(t2, 0) AS t2, coalesce(t4, 0) AS t4, coalesce(t3, 0) AS t3, coalesce(done, FALSE) AS done, coalesce(r, 0) AS r, coalesce(s, 0) AS s FROM n FULL JOIN d USING (entity)),
  u AS (SELECT 1 AS tier, entity, t1 AS n_evidence, 0 AS a, 0 AS b, 0 AS c, -t1 AS o FROM b WHERE t1 > 0 UNION ALL SELECT 2, entity, t2, 0, 0, 0, -t2 FROM b WHERE t2 > 0 UNION ALL SELECT 3, entity, t3, -CAST(t1 > 0 AS INT), -r, -s, 0 FROM b WHERE t3 > 0 AND NOT done UNION ALL SELECT 4, entity, t4, 0, 0, 0, -t4 FROM b WHERE t4 > 0 AND t1 + t2 = 0)
  SELECT tier, entity, n_evidence, CAST(row_number() OVER (PARTITION BY tier ORDER BY a, b, c, o, entity) AS INT) AS rank FROM u""")
def review_queue(spark, sf_dir):
    """All of it: links by part with a method and a validation, documents by part."""
    m, v = F.col("l_linenumber") % 3, F.col("l_suppkey") % 4
    method = F.when(m == 0, "device_name_match").when(m == 1, "device_name_and_organisation_match").otherwise("registry_citation")
    state = F.when(v == 0, "identifier_confirmed").when(v == 1, "rejected_by_rule").when(v == 2, "identifier_not_resolved").otherwise("name_rule")
    links = table(spark, sf_dir, "lineitem").filter("l_quantity > 40").select(F.col("l_partkey").alias("entity"), method.alias("method"), state.alias("validation"))
    every = lambda k: F.col("p_size") % k == 0
    docs = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("entity"), every(2).alias("is_candidate"), every(5).alias("has_extraction"), every(3).alias("mentions_race"), every(7).alias("mentions_sex"))
    return K.review_queue(links, docs)


@query("WIN-9", "SELECT url_host, page_id FROM (SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS url_host, page_id, row_number() OVER (PARTITION BY regexp_extract(url, '^https?://([^/]+)', 1) ORDER BY page_id DESC) AS k FROM pages) WHERE k = 1")
def latest_line(spark, sf_dir):
    host = F.regexp_extract("url", "^https?://([^/]+)", 1)
    return table(spark, sf_dir, "pages").groupBy(host.alias("url_host")).agg(F.max("page_id").alias("page_id"))
