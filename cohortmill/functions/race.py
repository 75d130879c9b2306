"""Race and ethnicity labels: a vocabulary, grammars of labels that name one group and nothing else, labels of several parts,
the closest word, else unmapped. Everything is an expression over distinct labels; parts of a label are rows of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.folders import kept
from . import racegrammar as G
from . import racewords as W
from .fuzzy import closest
from .labels import clean_label, label_key

#: Labels that name a category outright, by category and subcategory ("" for none).
VOCABULARY = {
    "american_indian_alaska_native": {"": ["American Indian or Alaska Native", "American Indian or Alaskan Native", "American Indian/Alaska Native", "American Indian/Native Alaskan", "Native American", "Indigenous", "First Nations"]},
    "asian": {
        "": ["Asian"], "chinese": ["Chinese"], "japanese": ["Japanese"], "korean": ["Korean"], "vietnamese": ["Vietnamese"], "filipino": ["Filipino"], "south_asian_indian": ["Asian Indian", "Indian"], "south_asian_pakistani": ["Pakistani"],
        "south_asian_bangladeshi": ["Bangladeshi"], "southeast_asian_thai": ["Thai"], "southeast_asian_cambodian": ["Cambodian"], "southeast_asian_laotian": ["Laotian"], "southeast_asian_malaysian": ["Malaysian"],
        "southeast_asian_indonesian": ["Indonesian"], "east_asian_taiwanese": ["Taiwanese"], "east_asian": ["East Asian"], "south_asian": ["South Asian"], "southeast_asian": ["Southeast Asian"],
    },
    "black_african_american": {
        "": ["Black or African American", "Black", "Negro"], "african_american": ["African American", "African-American"], "african": ["African", "Sub-Saharan African"],
        "caribbean_haitian": ["Haitian"], "caribbean_jamaican": ["Jamaican"], "caribbean": ["Caribbean", "West Indian"],
    },
    "native_hawaiian_pacific_islander": {
        "": ["Native Hawaiian or Other Pacific Islander", "Native Hawaiian/Pacific Islander", "Pacific Islander"], "native_hawaiian": ["Native Hawaiian", "Hawaiian"], "samoan": ["Samoan"],
        "guamanian_chamorro": ["Guamanian", "Chamorro"], "tongan": ["Tongan"], "fijian": ["Fijian"],
    },
    "white": {
        "": ["White", "Caucasian", "Caucasian/White", "White/Caucasian", "Caucasian or White", "White or Caucasian"], "european": ["European"], "middle_eastern": ["Middle Eastern"], "north_african": ["North African"],
        "middle_eastern_arab": ["Arab"], "middle_eastern_persian": ["Persian", "Iranian"], "middle_eastern_turkish": ["Turkish"], "european_eastern": ["Eastern European"], "european_western": ["Western European"],
    },
    "more_than_one_race": {"": ["More than one race", "Two or more races", "Multiple races", "Multi-racial", "Multiracial", "Mixed", "Mixed Race", "Biracial"]},
    "other": {"": ["Other", "Other Race", "Some Other Race", "Other/Unspecified", "Another Race"]},
    "unknown_not_reported": {
        "": ["Unknown", "Unknown race", "Unspecified", "Unspecified race", "Race unknown", "Race not reported", "Not Reported", "Unknown or Not Reported", "Unknown/Not Reported", "Unknown/Not-reported", "Declined", "Not Specified", "Missing"],
    },
}
#: Ethnicity words, and labels that resemble the wrong word.
HISPANIC = r"(?:hispanic|latin(?:o|a|x|e))s?"
HISPANIC_PHRASE = rf"(?<![a-z])(?:(?:non|not)[\s-]*(?:of\s+)?)?{HISPANIC}(?:\s*(?:/|,|or(?![a-z]))?\s*(?:(?:non|not)[\s-]*(?:of\s+)?)?{HISPANIC})*(?:\s+origin)?(?![a-z])"
NOT_HISPANIC = r"(?<![a-z])(?:non|not|no|neither)[\s-]*(?:of\s+)?(?:hispanic|latin[oaxe])"
WITHHELD = ["tonga"]
#: Words without which an unread label is no race at all.
PLAUSIBLE = [
    "race", "racial", "ethnic", "origin", "other", "unknown", "mixed", "biracial", "multiracial", "prefer not", "declined", "not reported", "not specified", "missing", "unspecified", "white", "caucasian", "black", "african", "asian", "hispanic",
    "latino", "latina", "native", "hawaiian", "pacific", "indian", "alaska", "indigenous", "caribbean",
]
#: Ethnicity labels by category and subcategory, and the wording of a dimension around them.
ETHNICITY = {
    "hispanic_latino": {
        "": ["Hispanic or Latino", "Hispanic/Latino", "Hispanic", "Latino", "Latina", "Latinx", "Spanish origin", "Another Hispanic, Latino, or Spanish origin", "Another Hispanic, Latino/a, or Spanish Origin", "Mexican, Puerto Rican, Cuban, Central or So. Amer."],
        "mexican": ["Mexican", "Mexican American", "Chicano", "Mexican, Mexican American, Chicano", "Mexican, Mexican American, Chicano/a"], "puerto_rican": ["Puerto Rican"], "cuban": ["Cuban"], "dominican": ["Dominican"], "central_american": ["Central American"],
        "south_american": ["South American"], "central_american_guatemalan": ["Guatemalan"], "central_american_honduran": ["Honduran"], "central_american_salvadoran": ["Salvadoran"], "south_american_colombian": ["Colombian"], "south_american_peruvian": ["Peruvian"],
        "south_american_venezuelan": ["Venezuelan"], "south_american_ecuadorian": ["Ecuadorian"], "south_american_argentine": ["Argentine"], "south_american_chilean": ["Chilean"],
    },
    "not_hispanic_latino": {"": ["Not Hispanic or Latino", "Not Hispanic/Latino", "Non-Hispanic", "Non Hispanic", "Not Hispanic"]},
    "unknown_not_reported": {"": ["Unknown", "Not Reported", "Unknown or Not Reported", "Unknown/Not Reported", "Declined", "Missing", "Not Specified"]},
}
DIMENSION = r"(?i)^(?:(?:race\s*(?:/|and|or|,)\s*ethnicity|ethnicity\s*(?:/|and|or|,)\s*race)|ethnic\s+group|ethnicity)\s*[:_–—-]\s*(?=\S)"
RACE_DIMENSION = r"(?i)^race\s*[:_–—-]\s*(?=\S)"
NEUTRAL = r"(?i)\s*\(\s*(?:regardless\s+of\s+race|(?:of\s+)?any\s+race|all\s+races)\s*\)$"

SPECIFIC = ["white", "black_african_american", "asian", "american_indian_alaska_native", "native_hawaiian_pacific_islander"]
NAMED = [*SPECIFIC, "more_than_one_race"]
MARK = r"[/,;&():–—-]"


def is_race_title(title: Column) -> Column:
    """race or racial as a word, also within CamelCase."""
    spaced = F.regexp_replace(F.coalesce(title, F.lit("")), "([a-z])([A-Z])", "$1 $2")
    return F.lower(spaced).rlike(r"(?<![a-z])(race|racial|races)(?![a-z])")


def is_ethnicity_title(title: Column) -> Column:
    """ethnicity, ethnic, Hispanic or Latino, unless it is about race alone."""
    t = F.lower(F.coalesce(title, F.lit("")))
    return t.rlike("ethnic|hispanic|latino") & ~(t.contains("race") & ~t.contains("ethnicity"))


def is_quarantined(label: Column) -> Column:
    """An unread label without any word of race."""
    z = F.lower(clean_label(label))
    return ~z.rlike("|".join(PLAUSIBLE)) & ~z.isin(*WITHHELD)


def joint_label(label: Column) -> tuple[Column, Column]:
    """(race part, ethnicity part) of a label that is one ethnicity phrase with something beside it; nulls elsewhere. The race part still has to be a known label."""
    text = clean_label(label)
    phrases = F.regexp_extract_all(text, F.lit(f"(?i){HISPANIC_PHRASE}"), F.lit(0))
    edges = " \t:;,-–—/()[]"
    rest = F.regexp_replace(F.trim(F.regexp_replace(F.regexp_replace(text, f"(?i){HISPANIC_PHRASE}", " "), r"\s+", " ")), r"(?i) only$", "")
    rest = F.nullif(F.trim(F.btrim(rest, F.lit(edges))), F.lit(""))
    one = (F.size(phrases) == 1) & rest.isNotNull()
    return F.when(one, rest), F.when(one, F.trim(F.get(phrases, F.lit(0))))


def joint_labels(labels: DataFrame, column: str) -> DataFrame:
    """(column, race, ethnicity) of every distinct label that is not null: the parts where the race part is a known label, else nulls."""
    race, said = joint_label(F.col(column))
    rows = labels.select(column).filter(F.col(column).isNotNull()).distinct().select(column, race.alias("race"), said.alias("ethnicity")).withColumn("low", F.lower("race"))
    known = rows.join(_vocabulary(labels.sparkSession, VOCABULARY, "low"), "low", "left")
    return known.select(column, *[F.when(F.col("v_category").isNotNull(), F.col(c)).alias(c) for c in ("race", "ethnicity")])


def race_by_sex(label: Column) -> tuple[Column, Column]:
    """(race part, sex) of a label with exactly one word of sex and something else; nulls elsewhere."""
    text = clean_label(label)
    sexes = r"(?i)\b(females?|males?)\b"
    rest = F.trim(F.btrim(F.regexp_replace(F.trim(F.regexp_replace(text, sexes, " ")), r"\s+", " "), F.lit(" \t:;,-–—/()[]")))
    one = (F.regexp_count(text, F.lit(sexes)) == 1) & (rest != "")
    word = F.lower(F.regexp_extract(text, sexes, 1))
    return F.when(one, rest), F.when(one, F.when(word.startswith("f"), "female").otherwise("male"))


def is_ethnicity_only(z: Column) -> Column:
    """Nothing but an ethnicity phrase."""
    return z.rlike(f"(?i)^{MARK}*\\s*{HISPANIC_PHRASE}\\s*{MARK}*$")


def ethnicity(label: Column) -> Column:
    """The category alone, by the vocabulary and a negation guard; null for a label that says nothing of ethnicity."""
    z = label_key(label)
    return F.when(z.rlike(NOT_HISPANIC), "not_hispanic_latino").when(z.rlike(r"(?<![a-z])(unknown|not reported|declined|missing)(?![a-z])"), "unknown_not_reported").when(z.rlike(HISPANIC), "hispanic_latino")


def _words(table: dict[str, dict[str, list[str]]]) -> list[tuple[str, str, str | None]]:
    return [(w, c, s or None) for c, subs in table.items() for s, words in subs.items() for w in words]


def _vocabulary(spark, table, name: str) -> DataFrame:
    """A few dozen fixed rows, broadcast."""
    rows = {w.lower(): (c, s) for w, c, s in reversed(_words(table))}
    return F.broadcast(spark.createDataFrame([(w, c, s) for w, (c, s) in rows.items()], f"{name} string, v_category string, v_subcategory string"))


def ethnicity_categories(labels: DataFrame, column: str) -> DataFrame:
    """(column, category, subcategory, confidence, flag) of every distinct label that is not null: vocabulary; the same without dimension wording; the closest
    word unless one of the two negates; else unmapped. A row of the race dimension is not read as ethnicity."""
    spark, text = labels.sparkSession, clean_label(F.col(column))
    race_row = text.rlike(RACE_DIMENSION) & ~text.rlike("(?i)hispanic|latin[oaxe]|spanish")
    bare = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(text, DIMENSION, ""), rf"{RACE_DIMENSION}(?=.*(?i:hispanic|latin[oaxe]|spanish))", ""), NEUTRAL, ""))
    base = labels.select(column).filter(F.col(column).isNotNull()).distinct().select(column, F.lower(text).alias("whole"), bare.alias("bare"), race_row.alias("race_row"))
    a, b = _vocabulary(spark, ETHNICITY, "whole"), _vocabulary(spark, ETHNICITY, "low").withColumnsRenamed({"v_category": "b_category", "v_subcategory": "b_subcategory"})
    known = base.withColumn("low", F.lower("bare")).join(a, "whole", "left").join(b, "low", "left")
    rest = closest(known.filter("v_category is null and b_category is null and not race_row"), "bare", [(w, w) for w, _, _ in _words(ETHNICITY)], 85.0, F.col("bare"))
    near = _vocabulary(spark, ETHNICITY, "near").withColumnsRenamed({"v_category": "n_category", "v_subcategory": "n_subcategory"})
    out = known.join(rest.withColumn("near", F.lower("outcome")), "bare", "left").join(near, "near", "left")
    as_posted = F.lower("bare") == F.col("whole")  # the guard is for labels that lost some wording
    agree = as_posted | (F.lower("bare").rlike(NOT_HISPANIC) == F.col("near").rlike(NOT_HISPANIC))
    fuzzy = F.col("n_category").isNotNull() & F.coalesce(agree, F.lit(False))
    read = lambda c: F.coalesce(f"v_{c}", F.when(~F.col("race_row"), F.col(f"b_{c}")), F.when(fuzzy & F.col("b_category").isNull() & F.col("v_category").isNull(), F.col(f"n_{c}")))
    flag = F.when(F.col("v_category").isNotNull(), "vocabulary").when(F.col("race_row"), "race_dimension_label").when(F.col("b_category").isNotNull(), "dimension_wording_stripped").when(fuzzy, "fuzzy_match").otherwise("unmapped")
    confidence = F.when(flag.isin("vocabulary", "dimension_wording_stripped"), "high").when(flag == "fuzzy_match", "medium").otherwise("low")
    return out.select(column, F.coalesce(read("category"), F.lit("unknown_not_reported")).alias("category"), read("subcategory").alias("subcategory"), confidence.alias("confidence"), flag.alias("flag"))


def _strip(x: Column, marks: str) -> Column:
    return F.btrim(x, F.lit(marks))


def _pieces(text: Column, pattern: str, marks: str) -> Column:
    """The parts of a text between a pattern, marks at their ends gone, empty ones left out."""
    return F.filter(F.transform(F.split(text, pattern), lambda x: _strip(x, marks)), lambda x: x != "")


def _no_answer(x: Column) -> Column:
    words = F.split(F.lower(x), r"[\s.\-–—/()]+")
    return F.lower(x).rlike(W.NO_ANSWER) | F.exists(words, lambda w: w.isin(*W.SHORT_NO_ANSWERS)) | F.regexp_replace(F.lower(x), "[^a-z]", "").isin(*W.SHORT_NO_ANSWERS)


def _grouped_parts(text: Column) -> tuple[Column, Column]:
    """(the joint wording itself, the parts set side by side) of a label that may be the joint Asian and Pacific category."""
    z = F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), r"[.]", ""), r"\s+", " "))
    z = F.regexp_replace(F.regexp_replace(F.regexp_replace(z, r"\bnon[\s\-]*hispanic\b", " "), r"(?<=[a-z])-(?=[a-z])", " "), r"\band\s*/\s*or\b", "or")
    return F.trim(z).rlike(f"^(?:{W.GROUPED_JOINED})$"), _pieces(_strip(z, " ,;-"), r"\s*(?:\bor\b|/|,|;)\s*", " -()")


def _any(pattern: str) -> str:
    """In any letter case."""
    return f"(?i){pattern}"


def read_texts(texts: DataFrame) -> DataFrame:
    """(piece, category, subcategory, confidence, flag) of distinct texts, by everything but the rules for several races and for the heritage template.

    In order: the vocabulary; Middle Eastern, Native American and Pacific groups; the joint Asian and Pacific category; census wordings; the first
    fragment between slashes that the vocabulary has; European, Asian and Black groups; the closest word (indel likeness of 85); else no category."""
    spark = texts.sparkSession
    joint, parts = _grouped_parts(F.col("piece"))
    texts = texts.select("piece", joint.alias("joint"), parts.alias("parts"))
    atoms = texts.select("piece").unionByName(texts.select(F.explode("parts").alias("piece"))).filter("piece <> ''").distinct()
    atoms = G.with_readings(atoms, "piece")
    atoms = kept(atoms.withColumn("low", F.lower("piece")).join(_vocabulary(spark, VOCABULARY, "low"), "low", "left").drop("low"), "label-atoms")
    sides = texts.select("piece", F.explode("parts").alias("part")).join(atoms.select(F.col("piece").alias("part"), (F.col("asian_label.category") == "asian").alias("a"), F.col("nhpi_label").isNotNull().alias("p")), "part")
    together = F.col("part").rlike(f"^(?:{W.GROUPED_TOGETHER})$")
    asian = together | F.coalesce("a", F.lit(False))
    islander = together | (~asian & (F.col("part").rlike(f"^(?:{W.GROUPED_PACIFIC})$") | F.col("p")))
    grouped = sides.groupBy("piece").agg((F.every(asian | islander) & F.bool_or(asian) & F.bool_or(islander)).alias("grouped"))
    rejoined = F.regexp_replace("piece", _any(W.AFRICAN_SLASH_AMERICAN), "african american")
    frags = lambda x: F.coalesce(F.when(x.contains("/"), F.transform(F.split(F.lower(x), "/"), F.trim)), F.array().cast("array<string>"))
    numbered = lambda k, x: F.transform(frags(x), lambda f, i: F.struct(F.lit(k).alias("k"), i.alias("i"), f.alias("frag")))
    both = F.concat(numbered(0, rejoined), numbered(1, F.when(rejoined != F.col("piece"), F.col("piece"))))
    slash = texts.select("piece", F.explode(both).alias("f")).select("piece", "f.*").join(_vocabulary(spark, VOCABULARY, "frag"), "frag")
    firsts = lambda k: F.min(F.when(F.col("k") == k, F.struct("i", F.col("v_category").alias("category"), F.col("v_subcategory").alias("subcategory"))))
    slash = slash.groupBy("piece").agg(firsts(0).alias("slash"), firsts(1).alias("slash_apart"))
    out = texts.select("piece", "joint").join(atoms, "piece").join(grouped, "piece", "left").join(slash, "piece", "left")
    apart = F.when(F.col("slash").isNull() & F.col("black_label").isNull(), F.col("slash_apart"))
    fragment = F.coalesce("slash", apart)
    answer = lambda c, f, conf="high": F.struct(c.getField("category").alias("category"), c.getField("subcategory").alias("subcategory"), F.lit(conf).alias("confidence"), F.lit(f).alias("flag"))
    word = F.struct(F.col("v_category").alias("category"), F.col("v_subcategory").alias("subcategory"))
    chain = F.when(F.col("v_category").isNotNull(), answer(word, "vocabulary"))
    for flag in ("mena_label", "aian_label", "nhpi_label"):
        chain = chain.when(F.col(flag).isNotNull(), answer(F.col(flag), flag))
    chain = chain.when(F.col("joint") | F.col("grouped"), answer(G.reading("asian"), "asian_pacific_grouped")).when(F.col("uk_census_label").isNotNull(), answer(F.col("uk_census_label"), "uk_census_label")).when(fragment.isNotNull(), answer(fragment, "slash_normalized"))
    for flag in ("european_label", "asian_label", "black_label"):
        chain = chain.when(F.col(flag).isNotNull() & (F.col(flag)["category"] != "west"), answer(F.col(flag), flag))
    out = kept(out.select("piece", chain.alias("r")), "label-readings")
    near = closest(out.filter(F.col("r").isNull() & ~F.lower("piece").isin(*WITHHELD)), "piece", [(w, w.lower()) for w, _, _ in _words(VOCABULARY)], 85.0, F.col("piece")).filter("outcome is not null")
    out = out.join(near.select("piece", F.col("outcome").alias("near")), "piece", "left").join(_vocabulary(spark, VOCABULARY, "near"), "near", "left")
    last = F.coalesce("r", F.when(F.col("near").isNotNull(), answer(word, "fuzzy_match", "medium")))
    return kept(out.select("piece", last.alias("r")).select("piece", "r.*"), "label-pieces")


def race_categories(labels: DataFrame, column: str) -> DataFrame:
    """(column, category, subcategory, confidence, flag, listed) of every distinct label that is not null.

    A race beside an ethnicity phrase first; then the order of read_texts(), with labels of several races (in the heritage template, or joined)
    before the census wordings, and one race in the heritage template after the closest word; else other, unmapped. listed: the races of a
    comma list, for the rules that look at a whole table. Labels are cut into pieces, each distinct piece is read once, and what a label means is
    folded over its pieces."""
    spark = labels.sparkSession
    base = labels.select(F.col(column).alias("_label")).filter("_label is not null").distinct().withColumn("text", clean_label(F.col("_label")))
    text, marks = F.col("text"), " -–—:,;()/."
    one_name = text
    for pattern, name in W.ONE_CATEGORY:
        one_name = F.regexp_replace(one_name, _any(pattern), name)
    heritage, several, joined = text.rlike(_any(W.HERITAGE)), one_name.rlike(_any(W.SEVERAL)), one_name.rlike(_any(W.SEVERAL_JOIN))
    glosses = F.regexp_extract_all(F.regexp_replace("text", _any(W.HERITAGE_COUNT), ""), F.lit(_any(W.HERITAGE_GLOSS)), F.lit(0))
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", _any(W.HERITAGE_COUNT), ""), _any(W.HERITAGE_GLOSS), " "), _any(W.HERITAGE), " ")
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(bare, r"(?i)(?:\s*,\s*|\s+)of\s+", ", "), r"\s*/\s*", "/"), r"\s+", " ")
    template = F.when(heritage & ~text.rlike(_any(W.NEGATION)) & ~F.exists(glosses, _no_answer), F.nullif(_strip(bare, " -–—:,/"), F.lit("")))
    joint = _strip(F.regexp_replace(F.regexp_replace(F.regexp_replace("text", _any(W.HERITAGE_COUNT), ""), _any(W.HERITAGE_GLOSS), " "), r"\s+", " "), " -–—:,/").rlike(_any(f"^(?:{W.GROUPED_JOINED})$"))
    base = base.select("_label", "text", one_name.alias("one_name"), heritage.alias("heritage"), several.alias("several"), joined.alias("joined"), template.alias("template"), joint.alias("joint"))
    none = F.array().cast("array<string>")
    some = lambda cond, xs: F.coalesce(F.when(cond, xs), none)
    tail = F.regexp_replace("template", _any(W.HERITAGE_MULTIPLE), "")
    multiple = F.col("template").rlike(_any(W.HERITAGE_MULTIPLE))
    ands = F.filter(F.split("template", _any(W.HERITAGE_PARTS)), lambda x: F.trim(x) != "")
    rest = F.regexp_replace(_strip(F.regexp_replace("one_name", _any(W.SEVERAL), ""), ") "), r"\s+", " ")
    spread = F.flatten(F.transform(_pieces(rest, _any(W.SEVERAL_PARTS), marks), lambda x: F.concat(F.array(x), _pieces(x, "/", marks))))
    units = {
        "whole": some(F.col("template").isNotNull(), F.array("template")),
        "part": some(F.size(ands) > 1, F.transform(ands, lambda x: _strip(x, " -–—:,"))),
        "tail": some(multiple, _pieces(tail, _any(W.HERITAGE_GROUPS), " -–—:,")),
        "label": F.array("text"),
        "joined": some(~F.col("heritage"), F.when(F.col("several"), spread).when(F.col("joined") & ~F.col("one_name").rlike(_any(f"^(?:{W.GROUPED_JOINED})$")), _pieces(F.col("one_name"), _any(W.SEVERAL_PARTS), marks))),
        "comma": some(~F.col("heritage") & ~F.col("several") & ~F.col("joined") & F.col("one_name").rlike("[,;]"), _pieces(F.col("one_name"), "[,;]", marks)),
    }
    tagged = lambda kind, xs: F.transform(xs, lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("unit"), x.alias("unit_text")))
    every = F.concat(*[tagged(k, xs) for k, xs in units.items()])
    rows = base.select("_label", F.explode(every).alias("u")).select("_label", "u.*")
    # A unit of the template: a race that qualifies it, and its groups; the rest of it is also read whole.
    in_template = F.col("kind").isin("whole", "part", "tail")
    qualifier = F.regexp_replace(F.regexp_extract(F.lower("unit_text"), _any(W.HERITAGE_QUALIFIER), 1), r"\s+", " ")
    after = F.regexp_replace("unit_text", _any(W.HERITAGE_QUALIFIER), "")
    rows = rows.select("*", F.when(in_template, qualifier).alias("qualifier"), F.when(in_template, after).alias("after"))
    piece = lambda role, x: F.struct(F.lit(role).alias("role"), x.alias("piece"))
    groups = F.transform(_pieces(F.col("after"), _any(W.HERITAGE_GROUPS), " -–—:,"), lambda x: piece("group", x))
    rows = rows.select("_label", "kind", "unit", "qualifier", F.explode(F.when(in_template, F.concat(groups, F.array(piece("rest", F.col("after")), piece("self", F.col("unit_text"))))).otherwise(F.array(piece("self", F.col("unit_text"))))).alias("p"))
    rows = kept(rows.select("_label", "kind", "unit", "qualifier", "p.*"), "label-rows")
    read = rows.join(read_texts(rows.select("piece").distinct()), "piece")
    # What the template writes short counts as read.
    key = F.trim(F.regexp_replace(F.lower("piece"), r"[.\s]+", " "))
    short = F.when(F.col("kind").isin("whole", "part", "tail"), F.try_element_at(F.create_map(*[F.lit(x) for kv in W.HERITAGE_SHORT.items() for x in kv]), key))
    read = read.withColumn("short", short).withColumns({"category": F.coalesce("short", "category"), "subcategory": F.when(F.col("short").isNull(), F.col("subcategory")), "confidence": F.when(F.col("short").isNotNull(), "high").otherwise(F.col("confidence")), "flag": F.when(F.col("short").isNull(), F.col("flag"))})
    group, high = F.col("role") == "group", F.coalesce(F.col("confidence") == "high", F.lit(False))
    named = F.coalesce(F.col("category").isin(*NAMED), F.lit(False))
    direction = F.regexp_replace(F.lower("piece"), r"\s+", " ").isin(*W.HERITAGE_DIRECTIONS)
    words = F.filter(F.split(F.lower("piece"), r"[\s.\-–—]+"), lambda w: w != "")
    evasive = F.col("piece").rlike(_any(W.NO_ANSWER)) | ((F.size(words) > 1) & F.exists(words, lambda w: w.isin(*W.SHORT_NO_ANSWERS)))
    strict, unread = F.col("kind") == "tail", F.col("category").isNull()
    wrong = group & ~direction & (evasive | F.when(unread, strict | F.col("piece").rlike("(?i)^[a-z]$")).otherwise(~named | (strict & ~high)))
    counted = group & ~direction & ~unread
    compact = group & ~direction & unread & F.regexp_replace(F.lower("piece"), r"[.\s]+", "").isin(*W.SHORT_NO_ANSWERS)
    as_whole = F.when((F.col("role") == "rest") & named & high & ~F.coalesce(F.col("flag") == "slash_normalized", F.lit(False)), F.struct("category", F.coalesce("subcategory", F.lit("")).alias("subcategory")))
    own = F.max(F.when((F.col("role") == "self") & high, F.col("category")))
    inherited = read.filter("kind in ('whole', 'part', 'tail')").groupBy("_label", "kind", "unit", "qualifier").agg(
        F.bool_or(wrong).alias("wrong"), F.collect_set(F.when(counted, F.col("category"))).alias("races"), F.collect_set(F.when(counted, F.coalesce("subcategory", F.lit(""))).when(group & direction, F.lit(""))).alias("subs"),
        F.count_if(group & ~direction & unread).alias("unread"), F.count_if(counted).alias("mapped"), F.bool_or(compact).alias("compact"), F.bool_or(counted & ~high).alias("medium"), F.max(as_whole).alias("as_whole"), own.alias("own"),
    )
    leading = F.try_element_at(F.create_map(*[F.lit(x) for kv in W.HERITAGE_QUALIFIERS.items() for x in kv]), F.col("qualifier"))
    needs_whole = leading.isNull() & (F.col("unread") > 0)
    whole = lambda c: F.when(needs_whole, F.array(F.col("as_whole")[c])).otherwise(none)
    races = F.array_distinct(F.array_compact(F.concat("races", F.array(leading), whole("category"))))
    subs = F.array_distinct(F.array_compact(F.concat("subs", whole("subcategory"))))
    fails = F.col("wrong") | (needs_whole & F.col("as_whole").isNull()) | (leading.isNull() & (F.col("mapped") == 0) & ~needs_whole) | (F.col("compact") & (F.col("mapped") == 0)) | (F.size(races) != 1)
    unit = F.when(~fails, F.struct(F.get(races, F.lit(0)).alias("category"), F.when(F.size(subs) == 1, F.nullif(F.get(subs, F.lit(0)), F.lit(""))).alias("subcategory"), F.when(F.col("medium"), "medium").otherwise("high").alias("confidence")))
    inherited = inherited.select("_label", "kind", F.when((F.col("kind") == "tail") & F.col("own").isin(*NAMED), F.struct(F.col("own").alias("category"), F.lit(None).cast("string").alias("subcategory"), F.lit("high").alias("confidence"))).when((F.col("kind") == "tail") & F.col("own").isNotNull(), None).otherwise(unit).alias("u"))
    kind = lambda k: F.col("kind") == k
    inherited = inherited.groupBy("_label").agg(
        F.max(F.when(kind("whole"), F.col("u"))).alias("one"), F.count_if(kind("tail")).alias("tails"), F.count_if(kind("tail") & F.col("u").isNull()).alias("tails_unread"),
        F.count_if(kind("part") & F.col("u").isNull()).alias("parts_unread"), F.collect_set(F.when(kind("part"), F.col("u.category"))).alias("part_races"),
    )
    alone, passed = F.when(named & high, F.col("category")), is_ethnicity_only(F.col("piece"))
    specific = F.when(F.col("category").isin(*SPECIFIC), F.col("category"))
    listing = F.when(F.col("flag") != "fuzzy_match", specific)
    plain = read.filter("kind not in ('whole', 'part', 'tail')").groupBy("_label").agg(
        F.max(F.when(kind("label"), F.struct("category", "subcategory", "confidence", "flag"))).alias("label"), F.collect_set(F.when(kind("joined"), alone)).alias("joined_races"),
        F.count_if(kind("joined") & alone.isNull() & ~passed).alias("joined_unread"), F.collect_set(F.when(kind("comma"), listing)).alias("listed"), F.count_if(kind("comma") & (listing.isNull() & ~passed | F.col("piece").rlike("(?i)^or "))).alias("listed_unread"),
    )
    out = base.join(plain, "_label", "left").join(inherited, "_label", "left")
    several_races = F.coalesce(F.when(F.col("several"), F.size(F.array_remove("joined_races", "more_than_one_race")) >= 2).otherwise((F.size("joined_races") >= 2) & (F.col("joined_unread") == 0)), F.lit(False))
    tailed = (F.col("tails") > 0) & (F.col("tails_unread") == 0)
    combined = F.coalesce(F.when(F.col("tails") > 0, tailed).otherwise(~F.col("joint") & (F.size("part_races") >= 2) & (F.col("parts_unread") == 0)), F.lit(False))
    early = F.coalesce(F.col("label.flag").isin("vocabulary", "mena_label", "aian_label", "nhpi_label", "asian_pacific_grouped"), F.lit(False))
    guarded = F.coalesce((F.col("label.flag") == "fuzzy_match") & F.col("heritage") & _no_answer(F.regexp_replace("text", _any(W.HERITAGE), " ")), F.lit(False))
    row = lambda c, sub, conf, f: F.struct(c.alias("category"), sub.cast("string").alias("subcategory"), conf.alias("confidence"), f.alias("flag"))
    many = lambda f: row(F.lit("more_than_one_race"), F.lit(None), F.lit("high"), F.lit(f))
    beside, _ = joint_label(F.col("_label"))
    also = _vocabulary(spark, VOCABULARY, "beside").withColumnsRenamed({"v_category": "j_category", "v_subcategory": "j_subcategory"})
    out = out.withColumn("beside", F.lower(beside)).join(also, "beside", "left")
    chain = (
        F.when(F.col("j_category").isNotNull(), row(F.col("j_category"), F.col("j_subcategory"), F.lit("high"), F.lit("split_from_combined")))
        .when(early, F.col("label"))
        .when(combined, many("heritage_label"))
        .when(several_races, many("multirace_label"))
        .when(F.col("label.category").isNotNull() & ~guarded, F.col("label"))
        .when(F.col("one").isNotNull(), row(F.col("one.category"), F.col("one.subcategory"), F.col("one.confidence"), F.lit("heritage_label")))
        .otherwise(row(F.lit("other"), F.lit(None), F.lit("low"), F.lit("unmapped")))
    )
    return out.withColumn("last", chain).select(F.col("_label").alias(column), "last.*", F.when((F.size("listed") >= 2) & (F.col("listed_unread") == 0), F.array_sort("listed")).alias("listed"))
