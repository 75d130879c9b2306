"""Queries over race and ethnicity labels, dimension blocks and the joins that attach evidence to trials."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import fuzzy as Z
from ..functions import race as E
from ..functions.labels import label_key
from ..operators import grid as G
from ..operators import blocks as B
from ..operators import links as K
from ..operators import racetables as Q
from ..operators import stats as T
from ..sources.folders import kept
from .bindings import STUDIES, _id, registered, studies, table
from .documents import KEYWORDS
from .registry import query
from .trials import PARSED, finished

#: Labels that stand for the parts by number, with the reading that the written rules give each; no category: put aside.
RACE_LABELS = [
    ("White", "white", None, "vocabulary"), ("Black or African American", "black_african_american", None, "vocabulary"), ("Asian", "asian", None, "vocabulary"), ("Other race", "other", None, "vocabulary"), ("Unknown/Not-Reported", "unknown_not_reported", None, "vocabulary"), ("White, %", "white", None, "vocabulary"),
    ("Caucasin", "white", None, "fuzzy_match"), ("White - Arabic/North African Heritage", "white", "middle_eastern_north_african", "mena_label"), ("Arab ethnicity", "white", "middle_eastern_arab", "mena_label"), ("Middle Eastern or North African", "white", "middle_eastern_north_african", "mena_label"), ("White/Middle Eastern", "white", None, "slash_normalized"),
    ("North American Native", "american_indian_alaska_native", None, "aian_label"), ("American (Amer) Indian (Ind) or Alaska Native (N)", "american_indian_alaska_native", None, "aian_label"), ("Navajo", "american_indian_alaska_native", None, "aian_label"), ("Indigenous Mayan", "american_indian_alaska_native", None, "aian_label"), ("Indigenous African", "black_african_american", "african", "black_label"),
    ("Native American or Pacific Islander", "other", None, "unmapped"), ("Hawaiian or Pacific Islander", "native_hawaiian_pacific_islander", None, "nhpi_label"), ("Native Hawaiians", "native_hawaiian_pacific_islander", "native_hawaiian", "nhpi_label"), ("Guamanian or Chamorro", "native_hawaiian_pacific_islander", "guamanian_chamorro", "nhpi_label"), ("Maori", "native_hawaiian_pacific_islander", None, "nhpi_label"),
    ("Native Hawaiian or Other", "other", None, "unmapped"), ("Tonga", "other", None, "unmapped"), ("Asian/Pacific Islander", "asian", None, "asian_pacific_grouped"), ("Asian, Native Hawaiian, or Other Pacific Islander", "asian", None, "asian_pacific_grouped"), ("Asian and Pacific Islander", "asian", None, "asian_pacific_grouped"),
    ("African American/African Heritage & White - White/Caucasian/European Heritage", "more_than_one_race", None, "heritage_label"), ("Black/African American and White", "more_than_one_race", None, "multirace_label"), ("Mixed: White and Black", "more_than_one_race", None, "multirace_label"), ("Asian or Asian British", "asian", None, "uk_census_label"), ("Black or Black British", "black_african_american", None, "uk_census_label"),
    ("White British", "white", None, "uk_census_label"), ("Mixed or Multiple Ethnic Groups", "more_than_one_race", None, "uk_census_label"), ("White British or Other ethnic group", "other", None, "unmapped"), ("White/African/American", "white", None, "slash_normalized"), ("Chinese/Indian", "asian", "chinese", "slash_normalized"), ("German", "white", "european", "european_label"),
    ("Eastern European descent", "white", "european_eastern", "european_label"), ("South East Asian", "asian", "southeast_asian", "asian_label"), ("Chinese or Japanese", "asian", "east_asian", "asian_label"), ("Black African", "black_african_american", "african", "black_label"), ("Haitian or Jamaican", "black_african_american", "caribbean", "black_label"),
    ("Non-Hispanic White", "white", None, "split_from_combined"), ("Black or African American (not Hispanic)", "black_african_american", None, "split_from_combined"), ("Hispanic or Latino", "other", None, "unmapped"), ("West Asian", "other", None, "unmapped"), ("Cohort A", None, None, "unmapped"), ("Condom", None, None, "unmapped"),
    ("White - Caucasian / European Heritage", "white", None, "heritage_label"), ("White-Caucasian/ European heritage, n (%)", "white", None, "heritage_label"), ("Wt-Wt/Caucasian (Ca.)/European (Eu.) H.", "white", None, "heritage_label"), ("White(Wh)-Wh/Caucasian(Ca)/European(Eu)Heritage(H)", "white", None, "heritage_label"),
    ("White, European Heritage", "white", "european", "heritage_label"), ("White Heritage", "white", None, "heritage_label"), ("Asian - East Asian Heritage", "asian", "east_asian", "heritage_label"), ("Asian-East Asian H", "asian", "east_asian", "heritage_label"),
    ("Asian - South East Asian Heritage", "asian", "southeast_asian", "heritage_label"), ("Asian - Japanese Heritage", "asian", "japanese", "heritage_label"), ("Asian - Chinese Heritage", "asian", "chinese", "heritage_label"), ("Asian - Central/South Asian Heritage", "asian", None, "heritage_label"),
    ("East/South East Asian heritage", "asian", None, "heritage_label"), ("Japanese H./East Asian H./SouthEast Asian H.", "asian", None, "heritage_label"), ("Japanese Heritage", "asian", "japanese", "heritage_label"), ("White-Arabic/NA H and white/caucasia/European H", "white", None, "heritage_label"),
    ("JAPANESE HERITAGE(H)/EAST A H/SOUTH EAST A H", "asian", None, "heritage_label"), ("Black, of African Heritage", "black_african_american", "african", "heritage_label"), ("Black of African heritage", "black_african_american", "african", "heritage_label"), ("Asian; South East Asian Heritage", "asian", "southeast_asian", "heritage_label"),
    ("Asian-South East Asian Heritag", "asian", "southeast_asian", "heritage_label"), ("Black or African Heritage", "black_african_american", None, "heritage_label"), ("African American (Af Am)/African Heritage (Af Ht)", "black_african_american", None, "heritage_label"), ("American Indian/ Alaska native Heritage", "american_indian_alaska_native", None, "heritage_label"),
    ("Mixed Heritage", "more_than_one_race", None, "heritage_label"), ("African American/African Heritage & White", "more_than_one_race", None, "heritage_label"), ("African American/ African and White Heritage", "more_than_one_race", None, "heritage_label"), ("American Indian/Alaskan Native and White Heritage", "more_than_one_race", None, "heritage_label"),
    ("Multiple-Afr Amer/Afr Her/Amer Ind or Al N", "more_than_one_race", None, "heritage_label"), ("Multiple-Black/AA and White/Caucasian/EU H", "more_than_one_race", None, "heritage_label"), ("Asian - East Asian and White Heritage", "more_than_one_race", None, "heritage_label"), ("AA/African Heritage and AI or AN and White", "more_than_one_race", None, "heritage_label"),
    ("Af Am/Af Her & White", "more_than_one_race", None, "heritage_label"), ("Asian Heritage and Native Hawaiian Heritage", "more_than_one_race", None, "heritage_label"), ("Asian Heritage and Pacific Islander Heritage", "more_than_one_race", None, "heritage_label"), ("Asian Heritage and Other Pacific Islander Heritage", "more_than_one_race", None, "heritage_label"),
    ("African Amer/African Heritage/Amer Ind or Alaska N", "other", None, "unmapped"), ("African - White / Caucasian Heritage", "other", None, "unmapped"), ("Mixed Heritage or Other", "other", None, "unmapped"), ("Af Amer/White Heritage", "other", None, "unmapped"),
    ("American/African Heritage", "other", None, "unmapped"), ("Mixed-Heritage or Other", "other", None, "unmapped"), ("Mixed-Heritage Unknown", "other", None, "unmapped"), ("Multiple-Heritage Refused", None, None, "unmapped"),
    ("Multiple-Heritage N/A", None, None, "unmapped"), ("Multiple-White-Refused Heritage", "other", None, "unmapped"), ("Multiple-African American-NA Heritage", "other", None, "unmapped"), ("American Indian or Alaska Native-NA Heritage", "other", None, "unmapped"),
    ("White - Caucasian-NA Heritage", "other", None, "unmapped"), ("White - (N/A) Heritage", "other", None, "unmapped"), ("Asian - (Unk) Heritage", "other", None, "unmapped"), ("Multiple-White-(N/A) Heritage", "other", None, "unmapped"),
    ("American Indian or Alaska Native-NA H", "other", None, "unmapped"), ("African American-NA H", "other", None, "unmapped"), ("Native Hawaiian or Other Pacific Islander-Unk H", "other", None, "unmapped"), ("White - Refused Heritage", "other", None, "unmapped"),
    ("White - N/A Heritage", "other", None, "unmapped"), ("White - NA Heritage", "other", None, "unmapped"), ("Asian - Unk Heritage", "other", None, "unmapped"), ("Non-European heritage", None, None, "unmapped"),
    ("White - White/Caucasian/European Heritage", "white", None, "slash_normalized"), ("African American/African Heritage", "black_african_american", "african_american", "slash_normalized"), ("Japanese/East Asian HER/South East Asian HER", "asian", "japanese", "slash_normalized"), ("American Indian or Alaska Native & White", "more_than_one_race", None, "multirace_label"),
    ("Black or African American & White", "more_than_one_race", None, "multirace_label"), ("Asian and White", "more_than_one_race", None, "multirace_label"), ("White + Asian", "more_than_one_race", None, "multirace_label"), ("Black/African American and White/Caucasian", "more_than_one_race", None, "multirace_label"),
    ("American Indian/Alaska Native and Asian and White", "more_than_one_race", None, "multirace_label"), ("Asian & Native Hawaiian or Other Pacific Islander", "more_than_one_race", None, "multirace_label"), ("Black & Middle Eastern/North African", "more_than_one_race", None, "multirace_label"), ("Multiple-Black or African American and White", "more_than_one_race", None, "multirace_label"),
    ("Multiple - Asian, White", "more_than_one_race", None, "multirace_label"), ("Mixed (Black/White)", "more_than_one_race", None, "multirace_label"), ("Mixed: Black/Indian", "more_than_one_race", None, "multirace_label"), ("Multiracial: black/white/native", "more_than_one_race", None, "multirace_label"),
    ("More Than One Race (Black/African American, White and American Indian/Alaska Native)", "more_than_one_race", None, "multirace_label"), ("MULTIPLE-ASIAN & BLACK OR AFRICAN AMERICAN", "more_than_one_race", None, "multirace_label"), ("Caucasian, Black, and Asian", "more_than_one_race", None, "multirace_label"), ("American Indian and Alaska Native and White", "more_than_one_race", None, "multirace_label"),
    ("African-American/Black, Hispanic, and Caucasian/White", "more_than_one_race", None, "multirace_label"), ("Asian or Asian British (Indian)", "asian", "south_asian_indian", "uk_census_label"), ("British African", "black_african_american", "african", "uk_census_label"), ("Asian or Asian British - Pakistani", "asian", "south_asian_pakistani", "uk_census_label"),
    ("British Indian", "asian", "south_asian_indian", "uk_census_label"), ("British or Asian Pakistani", "asian", "south_asian_pakistani", "uk_census_label"), ("Asian, Asian British or Asian Welsh", "asian", None, "uk_census_label"), ("Asian or Asian British (Indian or Other)", "asian", None, "uk_census_label"),
    ("White (British, Irish, Other)", "white", None, "uk_census_label"), ("White - Caucasian European Heritage", "white", "european", "heritage_label"), ("African/American", "black_african_american", "african_american", "black_label"), ("African/American or Indian", "black_african_american", "african", "slash_normalized"),
    ("Native Hawaiian/Pacific Islander Hispanic", "native_hawaiian_pacific_islander", None, "split_from_combined"), ("Hispanic/Black", "black_african_american", None, "split_from_combined"), ("Latine White", "white", None, "split_from_combined"), ("Asian American", "asian", None, "asian_label"),
    ("Javanese", "asian", "southeast_asian_indonesian", "asian_label"), ("Asian American/Pacific Islander", "asian", None, "asian_pacific_grouped"), ("Asian and Native Hawaiian or Pacific Islander", "more_than_one_race", None, "multirace_label"),
]
ETHNIC_LABELS = [("Hispanic or Latino", "hispanic_latino"), ("Not Hispanic or Latino", "not_hispanic_latino"), ("Non-Hispanic", "not_hispanic_latino"), ("Unknown", "unknown_not_reported"), ("Total", None)]
ETHNIC_CASES = [
    ("Hispanic or Latino", "hispanic_latino", None, "vocabulary"), ("not hispanic", "not_hispanic_latino", None, "vocabulary"), ("Mexican", "hispanic_latino", "mexican", "vocabulary"), ("Ethnicity: Hispanic", "hispanic_latino", None, "dimension_wording_stripped"), ("Ethnicity - Not Hispanic or Latino", "not_hispanic_latino", None, "dimension_wording_stripped"),
    ("Race : Hispanic", "hispanic_latino", None, "dimension_wording_stripped"), ("Race: Unknown", "unknown_not_reported", None, "race_dimension_label"), ("Hispanic (Regardless of Race)", "hispanic_latino", None, "dimension_wording_stripped"), ("Not Hispanc or Latino", "not_hispanic_latino", None, "fuzzy_match"),
    ("Ethnicity: Not Hispanc or Latino", "unknown_not_reported", None, "unmapped"), ("Hispanic or Latinoo", "hispanic_latino", None, "fuzzy_match"), ("Ethnicity unknown", "unknown_not_reported", None, "unmapped"), ("Blue", "unknown_not_reported", None, "unmapped"),
]
JOINT_CASES = [
    ("Non-Hispanic White", "White", "Non-Hispanic"), ("Black or African American (not Hispanic)", "Black or African American", "not Hispanic"), ("Hispanic/Latino Black", "Black", "Hispanic/Latino"), ("Non-Hispanic White only", "White", "Non-Hispanic"), ("Non-Black Hispanic", None, None), ("Hispanic or Latino", None, None), ("White", None, None),
]


def _sql(rows, columns):
    values = ", ".join("(" + ", ".join("NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v) for v in (i, *r)) + ")" for i, r in enumerate(rows))
    return f"({', '.join(columns)}) AS (VALUES {values})"


def pick(column: str, rows):
    """The label that stands for a number."""
    return F.get(F.array(*[F.lit(x[0]) for x in rows]), (F.col(column) % len(rows)).cast("int"))


RACE = f"rl{_sql(RACE_LABELS, ('i', 'label', 'category', 'subcategory', 'flag'))}, race AS (SELECT l_orderkey, label, category, subcategory, flag, l_linestatus AS sex, l_quantity AS value FROM lineitem JOIN rl ON l_partkey % {len(RACE_LABELS)} = i)"


def race_rows(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", pick("l_partkey", RACE_LABELS).alias("label"), F.col("l_linestatus").alias("sex"), F.col("l_quantity").alias("value"))


def categorised(spark, sf_dir):
    """Every distinct label is read once; the readings are written, so Spark knows their size. Labels of no race have no category."""
    rows = race_rows(spark, sf_dir)
    known = E.race_categories(rows, "label")
    aside = (F.col("flag") == "unmapped") & E.is_quarantined(F.col("label"))
    return rows.join(kept(known.withColumn("category", F.when(~aside, F.col("category"))), "race-labels"), "label")


@query("VOC-1", f"WITH {RACE} SELECT label, category, subcategory, flag, CASE WHEN flag = 'unmapped' THEN 'low' WHEN flag = 'fuzzy_match' THEN 'medium' ELSE 'high' END AS confidence, count(*) AS n FROM race GROUP BY ALL")
def race_labels(spark, sf_dir):
    return categorised(spark, sf_dir).groupBy("label", "category", "subcategory", "flag", "confidence").agg(F.count("*").alias("n"))


@query("VOC-3", f"WITH {RACE} SELECT label, category IS NULL AS quarantined, count(*) AS n FROM race WHERE flag = 'unmapped' GROUP BY ALL")
def quarantine(spark, sf_dir):
    return categorised(spark, sf_dir).filter("flag = 'unmapped'").groupBy("label", F.col("category").isNull().alias("quarantined")).agg(F.count("*").alias("n"))


@query("VOC-7", f"WITH el{_sql(ETHNIC_CASES, ('i', 'label', 'category', 'subcategory', 'flag'))} SELECT label, category, subcategory, flag, count(*) AS n FROM lineitem JOIN el ON l_suppkey % {len(ETHNIC_CASES)} = i GROUP BY ALL")
def ethnicity_labels(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(pick("l_suppkey", ETHNIC_CASES).alias("label"))
    counted = rows.groupBy("label").agg(F.count("*").alias("n"))
    return counted.join(E.ethnicity_categories(counted, "label"), "label").select("label", "category", "subcategory", "flag", "n")


@query("VOC-2", f"WITH jl{_sql(JOINT_CASES, ('i', 'label', 'race', 'ethnicity'))} SELECT label, race, ethnicity, count(*) AS n FROM lineitem JOIN jl ON l_suppkey % {len(JOINT_CASES)} = i GROUP BY ALL")
def joint_labels(spark, sf_dir):
    counted = table(spark, sf_dir, "lineitem").groupBy(pick("l_suppkey", JOINT_CASES).alias("label")).agg(F.count("*").alias("n"))
    return counted.join(E.joint_labels(counted, "label"), "label").select("label", "race", "ethnicity", "n")


SEX_CASES = [("White : Female", "White", "female"), ("Caucasian (Male)", "Caucasian", "male"), ("African American- Males", "African American", "male"), ("African American Female Veterans", "African American Veterans", "female"), ("White", None, None), ("Asian Female", "Asian", "female"), ("Male", None, None)]


@query("VOC-4", f"""WITH sl{_sql(SEX_CASES, ("i", "label", "race", "sex"))}, r AS (SELECT DISTINCT l_orderkey, l_returnflag AS title, label, race, sex FROM lineitem JOIN sl ON (l_linenumber - 1) % {len(SEX_CASES)} = i)
  SELECT l_orderkey, title, label, CASE WHEN bool_and(race IS NOT NULL) OVER w THEN race END AS race, CASE WHEN bool_and(race IS NOT NULL) OVER w THEN sex END AS sex FROM r WINDOW w AS (PARTITION BY l_orderkey, title)""")
def race_by_sex(spark, sf_dir):
    """'White : Female' is a race and a sex; a table is by sex only if all its rows are."""
    rows = table(spark, sf_dir, "lineitem").withColumn("i", F.col("l_linenumber") - 1).select("l_orderkey", F.col("l_returnflag").alias("title"), pick("i", SEX_CASES).alias("label")).distinct()
    race, sex = E.race_by_sex(F.col("label"))
    whole = F.every(F.col("race").isNotNull()).over(Window.partitionBy("l_orderkey", "title"))
    return rows.withColumns({"race": race, "sex": sex}).withColumn("whole", whole).select("l_orderkey", "title", "label", *[F.when(F.col("whole"), F.col(c)).alias(c) for c in ("race", "sex")])


#: Tables by order number: which label each line number has.
TABLES = [
    ["White, Black", "White", "Asian", "Other", "White, Black", "Asian", "Other"], ["White, Black", "Other", "Unknown", "Other", "Unknown", "Other", "White, Black"], ["Asian and Native Hawaiian or Pacific Islander", "White", "Other", "White", "Other", "White", "Other"],
    ["Asian and Native Hawaiian or Pacific Islander", "Asian", "Other", "White", "Other", "White", "Other"], ["West Asian", "East Asian", "Southeast Asian", "White", "Pakistani", "White", "White"], ["Aboriginal", "White", "White", "White", "White", "White", "White"],
]


@query("VOC-5", """WITH x AS (SELECT l_orderkey, l_returnflag AS title, l_linenumber AS line, l_orderkey % 6 AS k FROM lineitem GROUP BY ALL), s AS (SELECT l_orderkey, CASE WHEN bool_and(l_suppkey % 2 = 0) THEN 'americas' WHEN bool_or(l_suppkey % 2 = 0) THEN 'mixed' ELSE 'outside_americas' END AS region FROM lineitem GROUP BY 1),
  f AS (SELECT *, bool_or(line = 2) OVER w AS has2, bool_or(line = 3) OVER w AS has3, bool_or(line = 5) OVER w AS has5 FROM x JOIN s USING (l_orderkey) WINDOW w AS (PARTITION BY l_orderkey, title))
  SELECT l_orderkey, title, line, CASE WHEN k = 0 AND line IN (1, 5) THEN CASE WHEN has2 THEN 'multirace_comma_list' ELSE 'unmapped' END WHEN k = 1 AND line IN (1, 7) THEN 'unmapped' WHEN k = 2 AND line = 1 THEN 'asian_pacific_grouped' WHEN k = 3 AND line = 1 THEN CASE WHEN has2 THEN 'multirace_label' ELSE 'asian_pacific_grouped' END
    WHEN k = 4 AND line = 1 THEN CASE WHEN (has2 OR has3) AND NOT has5 THEN 'west_asian_template' ELSE 'unmapped' END WHEN k = 5 AND line = 1 THEN CASE region WHEN 'americas' THEN 'indigenous_in_the_americas' WHEN 'outside_americas' THEN 'indigenous_outside_americas' ELSE 'unmapped' END ELSE 'vocabulary' END AS flag,
  CASE WHEN k IN (0, 1) AND line IN (1, 5 + 2 * k) THEN CASE WHEN k = 0 AND has2 THEN 'more_than_one_race' ELSE 'other' END WHEN k = 2 AND line = 1 THEN 'asian' WHEN k = 3 AND line = 1 THEN CASE WHEN has2 THEN 'more_than_one_race' ELSE 'asian' END WHEN k = 3 AND line = 2 THEN 'asian'
    WHEN k = 4 AND line = 1 THEN CASE WHEN (has2 OR has3) AND NOT has5 THEN 'asian' ELSE 'other' END WHEN k = 4 AND line IN (2, 3, 5) THEN 'asian' WHEN k = 5 AND line = 1 THEN CASE WHEN region = 'americas' THEN 'american_indian_alaska_native' ELSE 'other' END
    WHEN k = 0 AND line IN (3, 6) THEN 'asian' WHEN (k = 0 AND line = 2) OR (k IN (2, 3) AND line IN (4, 6)) OR (k = 2 AND line = 2) OR (k = 4 AND line IN (4, 6, 7)) OR k = 5 THEN 'white' WHEN k = 1 AND line IN (3, 5) THEN 'unknown_not_reported' ELSE 'other' END AS category FROM f""")
def cross_row_rules(spark, sf_dir):
    """What a row means can depend on the rows beside it, and on where the sites are."""
    lines = table(spark, sf_dir, "lineitem")
    even = F.col("l_suppkey") % 2 == 0
    sites = lines.groupBy("l_orderkey").agg(F.when(F.every(even), "americas").when(F.bool_or(even), "mixed").otherwise("outside_americas").alias("region"))
    label = F.get(F.get(F.array(*[F.array(*map(F.lit, t)) for t in TABLES]), (F.col("l_orderkey") % 6).cast("int")), F.col("l_linenumber") - 1)
    rows = lines.select("l_orderkey", F.col("l_returnflag").alias("title"), F.col("l_linenumber").alias("line"), label.alias("label")).distinct()
    known = kept(E.race_categories(rows, "label"), "race-labels")
    read = Q.table_rules(rows.join(known, "label").join(sites, "l_orderkey"), ["l_orderkey", "title"])
    return read.select("l_orderkey", "title", "line", "category", "flag")


BREAKDOWN = [("Asian", None), ("Chinese or Japanese", None), ("Sri Lankan", None), ("White", None), ("White", None), ("Black", None), ("Other", None)]


@query("VOC-6", """WITH x AS (SELECT l_orderkey, l_linenumber AS line, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2), y AS (SELECT *, bool_or(line = 1) OVER w AS has1, coalesce(sum(CASE WHEN line IN (2, 3) THEN q END) OVER w, 0) AS sub FROM x WINDOW w AS (PARTITION BY l_orderkey))
  SELECT l_orderkey, line, line IN (2, 3) AND has1 AND l_orderkey % 3 <> 0 AS left_out FROM y""")
def breakdowns(spark, sf_dir):
    """'Asian' with parts beside it, which two of three tables count once more than their population."""
    w = Window.partitionBy("l_orderkey")
    x = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", F.col("l_linenumber").alias("line")).agg(F.sum("l_quantity").alias("q"))
    sub = F.coalesce(F.sum(F.when(F.col("line").isin(2, 3), F.col("q"))).over(w), F.lit(0.0))
    x = x.withColumns({"sub": sub, "has1": F.max(F.col("line") == 1).over(w)}).withColumns({"i": F.col("line") - 1, "value": F.when(F.col("line") == 1, F.col("q") + F.col("sub")).otherwise(F.col("q"))})
    x = x.withColumn("population", F.sum("value").over(w) - F.when(F.col("has1") & (F.col("l_orderkey") % 3 != 0), F.col("sub")).otherwise(0.0)).withColumn("label", pick("i", BREAKDOWN))
    return Q.breakdown_rows(x.join(kept(E.race_categories(x, "label"), "race-labels"), "label"), ["l_orderkey"], "population", "line").select("l_orderkey", "line", "left_out")


@query("VOC-18")
def closest_words(spark, sf_dir):
    """The closest condition keyword to every distinct part name. The ratio is an indel likeness, which DuckDB lacks; the tests hold it against brute force."""
    return Z.closest(table(spark, sf_dir, "part"), "p_name", [(k, c) for k, c, _, _ in KEYWORDS], 70.0, label_key(F.col("p_name")))


@query("FLT-1", "SELECT p_type, p_size % 3 = 0 AS is_race, p_size % 3 <> 2 AS is_ethnicity, count(*) AS n FROM part GROUP BY 1, 2, 3")
def title_predicates(spark, sf_dir):
    k = F.col("p_size") % 3
    title = F.when(k == 0, F.concat("p_type", F.lit(" RaceEthnicity (NIH)"))).when(k == 1, "Ethnicity, Customized").otherwise(F.concat(F.lit("Trace element "), "p_type"))
    return table(spark, sf_dir, "part").groupBy("p_type", E.is_race_title(title).alias("is_race"), E.is_ethnicity_title(title).alias("is_ethnicity")).agg(F.count("*").alias("n"))


BLOCK = f"""{RACE}, pop AS (SELECT l_orderkey, sum(l_quantity) AS size FROM lineitem GROUP BY 1), t AS (SELECT l_orderkey, sum(value) AS n_in_table, sum(CASE WHEN category = 'white' THEN value END) AS white, sum(CASE WHEN category IN ('white', 'asian', 'black_african_american') THEN value ELSE 0 END) AS n_classified FROM race WHERE category IS NOT NULL GROUP BY 1)"""


def block(spark, sf_dir):
    rows = categorised(spark, sf_dir).filter("category is not null")
    population = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("size"))
    return B.dimension_block(rows, "l_orderkey", "category", "value", population, "size", "subcategory", "sex")


@query("SEL-7", f"""WITH {BLOCK}, u AS (SELECT l_orderkey, sum(CASE WHEN subcategory IS NOT NULL THEN value END) AS n_detailed, sum(CASE WHEN category = 'asian' AND subcategory = 'east_asian' THEN value END) AS east_asian, sum(CASE WHEN category = 'white' AND sex = 'F' THEN value END) AS white_f, sum(CASE WHEN category = 'white' AND sex = 'O' THEN value END) AS white_o,
  sum(CASE WHEN category = 'unknown_not_reported' THEN value END) AS unknown_explicit FROM race WHERE category IS NOT NULL GROUP BY 1)
  SELECT l_orderkey, white, n_in_table, n_in_table IS NOT NULL AND n_in_table > 0 AS reported, CASE WHEN n_in_table > 0 THEN greatest(0, size - n_in_table) END AS unknown_inferred, unknown_explicit, n_detailed, east_asian, white_f, white_o FROM pop LEFT JOIN t USING (l_orderkey) LEFT JOIN u USING (l_orderkey)""")
def race_block(spark, sf_dir):
    b = block(spark, sf_dir)
    of = lambda m, k: F.try_element_at(m, F.lit(k))
    detailed = F.aggregate(F.map_values("subcategories"), F.lit(0.0), lambda a, x: a + x)
    return b.select(
        "l_orderkey", of("totals", "white").alias("white"), "n_in_table", "reported", "unknown_inferred", of("totals", "unknown_not_reported").alias("unknown_explicit"), F.when(F.size("subcategories") > 0, detailed).alias("n_detailed"),
        of("subcategories", "asian.east_asian").alias("east_asian"), of("joint", "white.F").alias("white_f"), of("joint", "white.O").alias("white_o"),
    )


@query("FLT-18", f"WITH {BLOCK} SELECT l_orderkey, n_in_table, n_classified, n_in_table - n_classified AS n_unclassified FROM t WHERE n_in_table > 0")
def observed_block(spark, sf_dir):
    return B.observed_counts(block(spark, sf_dir), ["white", "asian", "black_african_american"]).select("l_orderkey", "n_in_table", "n_classified", "n_unclassified")


@query("FLT-17", f"WITH {BLOCK} SELECT l_orderkey, CASE WHEN white > 60 THEN 'race_table_has_ethnicity_rows' WHEN n_in_table > size + greatest(1, 0.01 * size) THEN 'table_total_exceeds_sex_table' WHEN n_in_table < size - greatest(1, 0.01 * size) THEN 'table_total_below_sex_table' ELSE 'matches_sex_table' END AS check_result FROM pop JOIN t USING (l_orderkey)")
def structure_check(spark, sf_dir):
    b = block(spark, sf_dir).filter("reported")
    return b.select("l_orderkey", B.table_check(F.col("n_in_table"), F.col("size"), F.coalesce(F.try_element_at("totals", F.lit("white")) > 60, F.lit(False))).alias("check_result"))


@query("FLT-19", "SELECT p_partkey, array_to_string(list_filter(['enrols_patients_not_the_general_population', CASE WHEN p_retailprice > 1000 THEN 'site_in_a_referral_centre_zip' END, CASE WHEN p_size <= 13 THEN 'children_only' END, CASE WHEN p_size >= 45 THEN 'older_adults_only' END], lambda x: x IS NOT NULL), ',') AS caveats FROM part")
def caveats(spark, sf_dir):
    size = F.col("p_size")
    c = B.reference_caveats(F.lit(False), F.col("p_retailprice") > 1000, F.when(size >= 45, 60).otherwise(size), size + 5, F.lit(False))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(c, ",").alias("caveats"))


@query("JN-21", "SELECT c_custkey AS point_id, CAST(floor(c_acctbal / 1000) AS BIGINT) AS area FROM customer WHERE c_acctbal >= 0 AND c_acctbal < 10000")
def points_in_polygons(spark, sf_dir):
    """Customers as points, one square for each thousand of balance; every edge of a square is its own row."""
    points = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("point_id"), (F.col("c_acctbal") / 1000).alias("x"), ((F.col("c_custkey") % 97) / 100).alias("y"))
    squares = table(spark, sf_dir, "nation").filter("n_nationkey < 10").select(F.col("n_nationkey").cast("bigint").alias("area"))
    a = F.col("area")
    corners = F.array(*[F.struct((a + dx).cast("double").alias("x"), F.lit(float(dy)).alias("y")) for dx, dy in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))])
    edges = squares.select("area", corners.alias("c")).select("area", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("i"), "c").select("area", F.col("c")[F.col("i")]["x"].alias("x1"), F.col("c")[F.col("i")]["y"].alias("y1"), F.col("c")[F.col("i") + 1]["x"].alias("x2"), F.col("c")[F.col("i") + 1]["y"].alias("y2"))
    return B.points_in_areas(points, edges, 0.01)  # strips so narrow that none holds a large share of the points


@query("JN-21-grid", """WITH p AS (SELECT c_custkey AS point_id, c_acctbal / 1000 AS x, (c_custkey % 97) / 100 AS y FROM customer), s AS (SELECT point_id, CAST(floor(x) AS BIGINT) AS area, x - floor(x) AS dx, y FROM p WHERE x >= 0 AND x < 10)
  SELECT point_id, area FROM s WHERE NOT (dx >= 0.25 AND dx < 0.75 AND y >= 0.25 AND y < 0.75) UNION ALL SELECT point_id, 100 FROM p WHERE x >= -50 AND x < 50 UNION ALL SELECT point_id, 101 FROM p WHERE y >= 0 AND y < 0.5 AND x >= y AND x < 10 - y""")
def points_in_grid(spark, sf_dir):
    """Customers as points; a square with a hole for each thousand of balance, one square around all, and a trapezoid; cells by the density of the points."""
    points = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("point_id"), (F.col("c_acctbal") / 1000).alias("x"), ((F.col("c_custkey") % 97) / 100).alias("y"))
    squares = table(spark, sf_dir, "nation").filter("n_nationkey < 10").select(F.col("n_nationkey").cast("bigint").alias("area"))
    corner = lambda x, y: F.struct((F.lit(0.0) + x).cast("double").alias("x"), F.lit(float(y)).alias("y"))
    a = F.col("area")
    ring = lambda *at: F.array(*[corner(x, y) for x, y in (*at, at[0])])
    square = lambda x, d, e: ring((x + d, d), (x + e, d), (x + e, e), (x + d, e))
    rings = squares.select("area", F.explode(F.array(square(a, 0.0, 1.0), square(a, 0.25, 0.75))).alias("c"))
    one = squares.filter("area = 0")
    rings = rings.unionByName(one.select(F.lit(100).cast("bigint").alias("area"), ring((-50, -50), (50, -50), (50, 50), (-50, 50)).alias("c"))).unionByName(one.select(F.lit(101).cast("bigint").alias("area"), ring((0, 0), (10, 0), (9.5, 0.5), (0.5, 0.5)).alias("c")))
    sides = rings.select("area", F.explode(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: F.struct(F.get("c", k).alias("f"), F.get("c", k + 1).alias("t")))).alias("e"))
    return G.points_in_cells(points, sides.select("area", F.col("e.f.x").alias("x1"), F.col("e.f.y").alias("y1"), F.col("e.t.x").alias("x2"), F.col("e.t.y").alias("y2")))


@query("JN-4", f"WITH {STUDIES} SELECT nct_id, CASE WHEN class = 'BUILDING' AND n_regionkey = 1 THEN 'Reviewed' WHEN class = 'BUILDING' THEN 'Other' ELSE class END AS category FROM studies JOIN nation ON nation = n_nationkey")
def placements(spark, sf_dir):
    reviewed = table(spark, sf_dir, "nation").filter("n_regionkey = 1").select(F.col("n_nationkey").alias("nation"), F.lit("Reviewed").alias("placed"))
    s = registered(spark, sf_dir).withColumn("category", F.when(F.col("class") == "BUILDING", "Other").otherwise(F.col("class"))).join(reviewed, "nation", "left")
    return s.select("nct_id", F.when((F.col("category") == "Other") & F.col("placed").isNotNull(), F.col("placed")).otherwise(F.col("category")).alias("category"))


@query("JN-6", PARSED + " SELECT d.nct_id, d.status, CASE WHEN d.nct_id IN (SELECT nct_id FROM trials) THEN percent_female END AS percent_female, d.class = 'MACHINERY' AS in_cohort FROM done d")
def linked_trials(spark, sf_dir):
    f = finished(spark, sf_dir)
    cohort = studies(spark, sf_dir).filter("class = 'MACHINERY'").select("nct_id", F.lit(True).alias("c"))
    return f.join(cohort, "nct_id", "left").select("nct_id", "status", "percent_female", F.coalesce("c", F.lit(False)).alias("in_cohort"))


@query("JN-15", f"""WITH c AS (SELECT doc_id AS document, 'NCT' || {"lpad(CAST(doc_id % 100000000 AS VARCHAR), 8, '0')"} AS identifier FROM documents WHERE doc_id % 12 IN (0, 1)), p AS (SELECT doc_id AS document, doc_id - doc_id % 12 AS parent FROM documents WHERE doc_id % 12 IN (1, 2)),
  b AS (SELECT document, identifier, max(own) AS own FROM (SELECT *, 1 AS own FROM c UNION ALL SELECT p.document, identifier, 0 FROM p JOIN c ON parent = c.document) GROUP BY 1, 2), a AS (SELECT *, CAST(substr(identifier, 4) AS INT) AS k FROM b)
  SELECT document, identifier, CASE WHEN own = 1 THEN 'own_document' ELSE 'parent_document' END AS cited_by, CASE WHEN k NOT IN (SELECT o_orderkey FROM orders) THEN 'not_looked_up' WHEN k % 7 = 0 THEN 'not_found' WHEN k % 7 = 1 THEN 'lookup_failed' WHEN k % 7 = 2 THEN 'resolved_to_different_id' ELSE 'resolves' END AS state FROM a""")
def cited_identifiers(spark, sf_dir):
    """Registry identifiers that the documents' own pages cite, and those that only the page's parent does, against what the registry answered."""
    from .documents import with_citation

    # only registry numbers are looked for, by no other kind's pattern; what is found is written, since documents and their children both read it
    found = K.identifiers(with_citation(spark, sf_dir), ["doc_id"], "text", "own", {"nct": K.IDENTIFIERS["nct"]})
    citations = kept(found.select(F.col("doc_id").alias("document"), "identifier"), "citations")
    d = F.col("doc_id")
    parents = table(spark, sf_dir, "documents").filter((d % 12).isin(1, 2)).select(d.alias("document"), (d - d % 12).alias("parent"))
    trials = table(spark, sf_dir, "orders").select(_id("o_orderkey").alias("nct_id"))
    k = F.substring("nct_id", 4, 8).cast("int") % 7
    status = F.when(k == 0, 404).when(k == 1, 500).otherwise(200)
    answers = trials.select(F.col("nct_id").alias("identifier"), status.alias("status"), F.when(k == 2, F.concat(F.lit("OLD"), "nct_id")).otherwise(F.col("nct_id")).alias("own_id"))
    return K.cited_studies(citations, answers, parents)


@query("JN-18", "SELECT s_suppkey, CASE WHEN s_nationkey < 8 THEN 'exact' WHEN s_nationkey < 16 THEN 'legal_form_differs' ELSE 'no_match' END AS tier FROM supplier")
def match_tiers(spark, sf_dir):
    from ..functions.names import organisation_key

    s = table(spark, sf_dir, "supplier")
    n = F.col("s_nationkey")
    other = s.select("s_suppkey", F.when(n < 8, F.col("s_name")).when(n < 16, F.concat("s_name", F.lit(" Inc"))).otherwise(F.concat("s_name", F.lit(" Two"))).alias("theirs"))
    both = s.join(other, "s_suppkey")
    key = lambda c: organisation_key(F.col(c), ["inc"], [])
    return both.select("s_suppkey", F.when(F.lower("s_name") == F.lower("theirs"), "exact").when(key("s_name") == key("theirs"), "legal_form_differs").otherwise("no_match").alias("tier"))


@query("JN-19", r"""WITH q AS (SELECT doc_id, CASE WHEN doc_id % 3 = 2 THEN 'no such quote' ELSE trim(regexp_replace(substr(text, 11, 40), '\s+', ' ', 'g')) END AS quote, CASE WHEN doc_id % 3 = 1 THEN doc_id + 1 ELSE doc_id END AS source FROM documents)
  SELECT q.doc_id, q.source, CASE WHEN d.doc_id IS NULL THEN 'source_not_held' WHEN quote <> '' AND contains(regexp_replace(d.text, '\s+', ' ', 'g'), quote) THEN 'stands' ELSE 'not_found' END AS state FROM q LEFT JOIN documents d ON d.doc_id = q.source""")
def verified_quotes(spark, sf_dir):
    """Statements with a quote and the document they name as its source: its own, the next one, or words that stand nowhere."""
    squash = lambda c: F.regexp_replace(c, r"\s+", " ")
    d, i = table(spark, sf_dir, "documents").select("doc_id", "text"), F.col("doc_id") % 3
    quotes = d.select("doc_id", F.when(i == 2, "no such quote").otherwise(F.trim(squash(F.substring("text", 11, 40)))).alias("quote"), F.when(i == 1, F.col("doc_id") + 1).otherwise(F.col("doc_id")).alias("source"))
    held = d.select(F.col("doc_id").alias("source"), squash("text").alias("held"))
    both = quotes.join(held.withColumn("here", F.lit(True)), "source", "left")
    stands = (F.col("quote") != "") & F.col("held").contains(F.col("quote"))
    return both.select("doc_id", "source", F.when(F.col("here").isNull(), "source_not_held").when(stands, "stands").otherwise("not_found").alias("state"))


@query("JN-28", r"""WITH p AS (SELECT doc_id, count(*) AS n_lines, count_if(regexp_matches(line, 'License')) AS n_license FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1) SELECT d.doc_id, d.source, n_lines, n_license, CASE WHEN n_license > 0 THEN 'licensed' ELSE 'plain' END AS type, quality IS NOT NULL AS reviewed FROM documents d LEFT JOIN p USING (doc_id) LEFT JOIN labels USING (doc_id)""")
def document_registry(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    lines = d.select("doc_id", F.explode(F.split("text", "\n")).alias("line")).groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.count_if(F.col("line").contains("License")).alias("n_license"))
    return d.select("doc_id", "source").join(lines, "doc_id", "left").join(table(spark, sf_dir, "labels"), "doc_id", "left").select("doc_id", "source", "n_lines", "n_license", F.when(F.col("n_license") > 0, "licensed").otherwise("plain").alias("type"), F.col("quality").isNotNull().alias("reviewed"))


#: Documents by number: their first and second page, and what FDA's kind of label would say.
TYPED = [
    ("The summary of safety and effectiveness data of this device", "more", None, "ssed", "text", 1), ("We have reviewed your notification and it may proceed", "indications for use of the device", None, "clearance_letter", "text", 1), ("We have reviewed your notification and it may proceed", "", "summary", "summary", "official_label_unread_pages", 1),
    ("We have reviewed your notification and it may proceed", "device description, indications for use and predicate device", None, "summary", "text", 2), ("", "", "labeling", "labeling", "official_label_only", None), ("", "", None, "unclassified_no_text", "none", None), ("words that no rule knows at all", "", "labeling", "labeling", "official_label_text_unmatched", None),
    ("words that no rule knows at all", "nor here, though it is long", None, "other", "text", None), ("words that no rule knows at all", "we have reviewed your notification, but on a later page", None, "other", "text", None),
]


@query("VOC-13", f"WITH tl{_sql(TYPED, ('i', 'a', 'b', 'label', 'type', 'basis', 'page'))} SELECT doc_id AS document, type, basis, page FROM documents JOIN tl ON doc_id % {len(TYPED)} = i")
def document_types(spark, sf_dir):
    i = (F.col("doc_id") % len(TYPED)).cast("int")
    at = lambda k: F.get(F.array(*[F.lit(x[k]).cast("string") for x in TYPED]), i)
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("document"), at(0).alias("a"), at(1).alias("b"), at(2).alias("label_type"))
    pages = d.select("document", F.posexplode(F.array("a", "b")).alias("page", "text")).withColumn("page", F.col("page") + 1)
    rules = [("ssed", "(?i)summary of safety and effectiveness", 3), ("clearance_letter", "(?i)we have reviewed your notification", 1)]
    return K.document_type(pages, d.select("document", "label_type"), rules, ["(?i)device description", "(?i)indications for use", "(?i)predicate device", "(?i)substantial equivalence"], "summary", ["clearance_letter"])


@query("AGG-18", "SELECT l_orderkey, l_returnflag AS type, count(*) AS n, count_if(l_quantity > 10) AS n_with_data, array_to_string(list_sort(list(DISTINCT l_linestatus)), ',') AS units, min(l_linenumber) AS min_groups, max(l_linenumber) AS max_groups FROM lineitem GROUP BY 1, 2")
def posted_outcomes(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", F.col("l_returnflag").alias("type")).agg(F.count("*").alias("n"), F.count_if(F.col("l_quantity") > 10).alias("n_with_data"), F.array_join(F.array_sort(F.collect_set("l_linestatus")), ",").alias("units"), F.min("l_linenumber").alias("min_groups"), F.max("l_linenumber").alias("max_groups"))


@query("AGG-19", f"WITH {STUDIES} SELECT reason, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN status = 'P' THEN 'pending' END, CASE WHEN class <> 'BUILDING' THEN 'not_building' END, CASE WHEN enrollment IS NULL THEN 'no_enrollment' END], lambda x: x IS NOT NULL)) AS reason FROM studies) GROUP BY 1")
def reason_counts(spark, sf_dir):
    reasons = F.array_compact(F.array(F.when(F.col("status") == "P", "pending"), F.when(F.col("class") != "BUILDING", "not_building"), F.when(F.col("enrollment").isNull(), "no_enrollment")))
    return studies(spark, sf_dir).select(F.explode(reasons).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query("AGG-28-slope", f"WITH {STUDIES} SELECT round(regr_r2(enrollment, year), 6) AS r2, count(*) AS n, round(1 - (1 - regr_r2(enrollment, year)) * (count(*) - 1) / (count(*) - 2), 6) AS adjusted FROM studies WHERE enrollment IS NOT NULL")
def pooled_fit(spark, sf_dir):
    s = studies(spark, sf_dir).select(F.lit("all").alias("g"), "enrollment", (F.col("year") - 1995).alias("year"))
    one = T.least_squares(s, ["g"], "enrollment", ["year"]).filter("term = 'year'")
    return one.select(F.round("r2", 6).alias("r2"), "n", F.round(1 - (1 - F.col("r2")) * (F.col("n") - 1) / (F.col("n") - 2), 6).alias("adjusted"))


@query("AGG-32", PARSED + ", a AS (SELECT status AS metric, count(*) AS got FROM done GROUP BY 1), b AS (SELECT status AS metric, count(*) AS want FROM done WHERE year < 1999 GROUP BY 1) SELECT coalesce(a.metric, b.metric) AS metric, got, want FROM a FULL JOIN b ON a.metric = b.metric WHERE got IS DISTINCT FROM want")
def baseline_drift(spark, sf_dir):
    f = finished(spark, sf_dir)
    got = f.groupBy(F.col("status").alias("metric")).agg(F.count("*").alias("got"))
    want = f.filter("year < 1999").groupBy(F.col("status").alias("metric")).agg(F.count("*").alias("want"))
    return got.join(want, "metric", "full").filter(~F.col("got").eqNullSafe(F.col("want")))


@query("FLT-5", f"WITH {STUDIES} SELECT nct_id, lead AS company FROM studies WHERE status <> 'P' AND results_date >= DATE '1996-01-01' AND class IN ('BUILDING', 'MACHINERY') AND enrollment > 0")
def industry_cohort(spark, sf_dir):
    return studies(spark, sf_dir).filter("status <> 'P' and results_date >= date '1996-01-01' and class in ('BUILDING', 'MACHINERY') and enrollment > 0").select("nct_id", F.col("lead").alias("company"))


@query("FLT-6", f"""WITH {STUDIES}, h AS (SELECT 'NCT' || lpad(CAST(l_orderkey AS VARCHAR), 8, '0') AS nct_id, min(CASE WHEN s_nationkey < 12 THEN s_name END) AS first_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1)
  SELECT nct_id, CASE WHEN class = 'BUILDING' THEN lead ELSE first_name END AS company, CASE WHEN class = 'BUILDING' THEN TRUE WHEN first_name IS NOT NULL THEN FALSE END AS via_lead FROM studies LEFT JOIN h USING (nct_id)""")
def assigned_company(spark, sf_dir):
    h = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).groupBy(F.concat(F.lit("NCT"), F.lpad(F.col("l_orderkey").cast("string"), 8, "0")).alias("nct_id")).agg(F.min(F.when(F.col("s_nationkey") < 12, F.col("s_name"))).alias("first_name"))
    lead = F.col("class") == "BUILDING"
    return registered(spark, sf_dir).join(h, "nct_id", "left").select("nct_id", F.when(lead, F.col("lead")).otherwise(F.col("first_name")).alias("company"), F.when(lead, True).when(F.col("first_name").isNotNull(), False).alias("via_lead"))


@query("DQ-6", "SELECT doc_id, problem FROM (SELECT doc_id, unnest(list_filter([CASE WHEN quality IS NULL THEN 'no_quality' END, CASE WHEN toxic = 1 AND quality = 1 THEN 'toxic_but_good' END], lambda x: x IS NOT NULL)) AS problem FROM labels)")
def link_problems(spark, sf_dir):
    found = F.array_compact(F.array(F.when(F.col("quality").isNull(), "no_quality"), F.when((F.col("toxic") == 1) & (F.col("quality") == 1), "toxic_but_good")))
    return table(spark, sf_dir, "labels").select("doc_id", F.explode(found).alias("problem"))


@query("DQ-8", f"WITH {STUDIES} SELECT class, count(*) AS n FROM studies WHERE class NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') GROUP BY 1")
def outside_vocabulary(spark, sf_dir):
    allowed = spark.createDataFrame([("BUILDING",), ("MACHINERY",), ("HOUSEHOLD",)], "class string")
    return registered(spark, sf_dir).join(F.broadcast(allowed), "class", "left_anti").groupBy("class").agg(F.count("*").alias("n"))


@query("DQ-10", "SELECT CAST(date_trunc('month', ts) AS DATE) AS month, count(DISTINCT user_id) AS n_stamps, count(DISTINCT user_id) = 1 AS agree FROM events GROUP BY 1")
def stamp_agreement(spark, sf_dir):
    n = F.count_distinct("user_id")
    return table(spark, sf_dir, "events").groupBy(F.to_date(F.date_trunc("month", "ts")).alias("month")).agg(n.alias("n_stamps"), (n == 1).alias("agree"))


@query("DQ-13", f"WITH {STUDIES} SELECT 'enrollment' AS path, count(enrollment) AS before, count(CASE WHEN status <> 'P' THEN enrollment END) AS after FROM studies UNION ALL SELECT 'lead', count(lead), count(lead) FROM studies")
def projection_losses(spark, sf_dir):
    one = studies(spark, sf_dir).agg(F.count("enrollment").alias("a"), F.count(F.when(F.col("status") != "P", F.col("enrollment"))).alias("b"), F.count("lead").alias("c"))
    return one.selectExpr("stack(2, 'enrollment', a, b, 'lead', c, c) as (path, before, after)")


@query("PRJ-13", "SELECT DISTINCT p_type, p_type AS cleaned FROM part")
def clean_labels(spark, sf_dir):
    from ..functions.labels import clean_label

    noisy = F.concat(F.lit("Race (n, % "), F.col("p_type"), F.lit(")​"))
    return table(spark, sf_dir, "part").select("p_type").distinct().select("p_type", clean_label(noisy).alias("cleaned"))


@query("FLT-14", PARSED + " SELECT nct_id, bool_or(coalesce(n_unknown, 0) > 0 AND coalesce(n_female, 0) + coalesce(n_male, 0) > 0) AS unknown_with_values FROM measures GROUP BY 1")
def explicit_unknown(spark, sf_dir):
    from ..operators.selection import bucket_sums
    from .bindings import cells

    c = lambda b: F.coalesce(f"n_{b}", F.lit(0.0))
    return bucket_sums(cells(spark, sf_dir)).groupBy("nct_id").agg(F.bool_or((c("unknown") > 0) & (c("female") + c("male") > 0)).alias("unknown_with_values"))


@query("JN-27", "WITH f AS (SELECT p_brand, p_partkey, p_name FROM part), c AS (SELECT p_name, count(DISTINCT p_partkey) AS hits FROM f GROUP BY 1) SELECT p_brand, count(DISTINCT p_partkey) AS n_candidates, bool_or(hits >= 50) AS any_common FROM f JOIN c USING (p_name) GROUP BY 1")
def family_candidates(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    c = p.groupBy("p_name").agg(F.count_distinct("p_partkey").alias("hits"))
    return p.join(c, "p_name").groupBy("p_brand").agg(F.count_distinct("p_partkey").alias("n_candidates"), F.bool_or(F.col("hits") >= 50).alias("any_common"))
