"""Evidence between documents, devices and studies: identifiers, name runs, tiers, reviews; all by equi-joins on extracted keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fuzzy import closest, token_set_ratio
from ..sources.folders import kept, numbered


#: Identifiers of studies and submissions, by kind; the group is the identifier where there is one.
IDENTIFIERS = {
    "nct": r"(?i)(?<![A-Za-z0-9])N\s?C\s?T[\s\-#:.]{0,3}((?:\d\s?){7}\d)(?![A-Za-z0-9])", "isrctn": r"\b(ISRCTN\s?\d{8})\b", "eudract": r"\b(20\d{2}-\d{6}-\d{2})\b", "chictr": r"\b(ChiCTR[-\w]{6,20})\b", "actrn": r"\b(ACTRN\d{14})\b", "drks": r"\b(DRKS\d{8})\b",
    "jprn_umin": r"\b(UMIN\d{9}|jRCT[s]?\d{9,10})\b", "ctri": r"\b(CTRI/\d{4}/\d{2,3}/\d{6})\b", "ide": r"\bIDE\s*(?:#|No\.?|number)?\s*:?\s*(G\d{6})\b", "doi": r"\b(10\.\d{4,9}/[^\s\"<>]{4,80})", "pmid": r"\bPMID:?\s*(\d{6,9})\b",
    "submission_number": r"(?<![A-Za-z0-9])(K\d{6}|DEN\d{6}|P\d{6}(?:/S\d{3})?)(?!\d)",
}
#: Sentences that deny a clinical study, describe one, or describe a test on data; and terms of demographics.
NO_STUDY = (
    r"(?i)\bno\s+(?:\w+\s+){0,2}clinical\s+(?:stud(?:y|ies)|testing|tests?|trials?|data|investigations?|evaluations?)\b|\bclinical\s+(?:stud(?:y|ies)|testing|tests?|trials?|data|investigations?|evaluations?)\s+(?:(?:was|were|is|are|has|have)\s+)?(?:been\s+)?not\s+(?:required|needed|necessary|performed|conducted|applicable|submitted|included|relied)"
    r"|\b(?:did|does|do)\s+not\s+(?:require|include|rely on)\s+(?:\w+\s+){0,2}clinical\s+(?:stud|test|trial|data)|\bclinical\s+(?:stud(?:y|ies)|testing|tests?|data)\s*[:\-]?\s*(?:not\s+applicable|n/a|none)\b"
)
HUMAN_STUDY = (
    r"(?i)\bclinical\s+(?:stud(?:y|ies)|trials?|investigations?|validation|evaluation)\b|\bpivotal\s+(?:stud(?:y|ies)|trials?)\b|\b(?:multi-?\s?reader|MRMC|reader)\s+(?:multi-?\s?case\s+)?(?:stud(?:y|ies)|evaluation)\b"
    r"|\b(?:prospective|retrospective)(?:ly)?[\s,\w-]{0,40}?\b(?:stud(?:y|ies)|trials?|cohorts?|collected|enrolled)\b|\b(?:subjects|patients|participants)\s+were\s+(?:enrolled|recruited|included|randomi[sz]ed)\b"
)
DATA_TEST = r"(?i)\bstand-?\s?alone\s+(?:performance|stud(?:y|ies)|testing|evaluation)\b|\b\d[\d,]{1,8}\s+(?:unique\s+)?(?:patients|subjects|participants|cases|exams|examinations|scans)\b"


def identifiers(pages: DataFrame, key: list[str], text: str, own: str | None = None, kinds: dict[str, str] = IDENTIFIERS) -> DataFrame:
    """(key, kind, identifier) of every match, each once; the key may hold the page. Spaces within a registry number and marks that end a
    sentence are no part of an identifier; `own`, a column with the document's own submission number, is not one of its citations."""

    def named(kind: str, pattern: str) -> Column:
        found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1))
        clean = lambda x: F.concat(F.lit("NCT"), F.regexp_replace(x, r"\s", "")) if kind == "nct" else F.regexp_replace(x, r"[.,;)]+$", "")
        return F.transform(found, lambda x: F.struct(F.lit(kind).alias("kind"), clean(x).alias("identifier")))

    carried = [*key, own] if own else key
    rows = pages.select(*carried, F.explode(F.concat(*[named(k, p) for k, p in kinds.items()])).alias("x"))
    if own:
        mine = (F.col("x.kind") == "submission_number") & (F.col("x.identifier").isin(F.col(own), F.split(own, "/")[0]))
        rows = rows.filter(~F.coalesce(mine, F.lit(False)))
    return rows.select(*key, "x.*").distinct()


def study_language(sentence: DataFrame, key: list[str]) -> DataFrame:
    """(key, n_human_study, n_data_test, n_no_study): a sentence that denies a study counts only as that."""
    no, human, data = (F.col("sentence").rlike(p) for p in (NO_STUDY, HUMAN_STUDY, DATA_TEST))
    return sentence.groupBy(*key).agg(F.count_if(human & ~no).alias("n_human_study"), F.count_if(data & ~no).alias("n_data_test"), F.count_if(no).alias("n_no_study"))


def study_description(readable: Column, cites: Column) -> Column:
    """What a document says about studies, over the columns of study_language(); cites: whether it names a registry identifier."""
    n = lambda c: F.coalesce(c, F.lit(0)) > 0
    return (
        F.when(~readable, "not_assessable_no_text").when(cites, "cites_registry_identifier").when(n("n_human_study") | n("n_data_test"), "describes_study_no_registry_identifier")
        .when(n("n_no_study"), "states_no_clinical_study_only").otherwise("no_study_language_found")
    )


def cited_numbers(fields: DataFrame, numbers: DataFrame) -> DataFrame:
    """fields: id, path, text; numbers: number ('K123456', 'P123456' or 'P123456/S001'). (id, path, number, supplement_cited) of every citation.

    Base numbers are taken out of the texts with what follows and joined by equality. A number is a whole token in any letter case.
    A supplement is cited by its base with that supplement after a slash, dash, space or nothing; its base alone is shown as supplement_cited
    = false; another supplement is another submission. An original is cited only where no supplement follows."""
    token = r"(?i)(?<![A-Za-z0-9])((?:K|DEN|P)\d{6})(\s*[/\u2010-\u2015-]?\s*S\d{3}(?![A-Za-z0-9])|(?![A-Za-z0-9]))(\s*[/\u2010-\u2015-]?\s*S\d|\s*/\s*(?![A-Z]{1,3}\d{6}(?![A-Za-z0-9]))[A-Za-z0-9])?"
    parts = [F.regexp_extract_all("text", F.lit(token), F.lit(i)) for i in (1, 2, 3)]
    found = fields.select("id", "path", F.explode(F.arrays_zip(*[p.alias(n) for p, n in zip(parts, ("base", "after", "rest"))])).alias("x")).select("id", "path", F.upper("x.base").alias("base"), F.upper(F.regexp_extract("x.after", r"(?i)S\d{3}", 0)).alias("cited"), F.coalesce(F.col("x.rest"), F.lit("")).alias("rest"))
    found = found.filter(~(F.col("base").startswith("P") & (F.col("cited") == "") & (F.col("rest") != ""))).drop("rest").distinct()
    sought = numbers.select("number", F.upper(F.split("number", "/")[0]).alias("base"), F.upper(F.coalesce(F.get(F.split("number", "/"), F.lit(1)), F.lit(""))).alias("wanted"))
    fits = F.when(F.col("wanted") == "", F.col("cited") == "").otherwise(F.col("cited").isin("") | (F.col("cited") == F.col("wanted")))
    return found.join(sought, "base").filter(fits).groupBy("id", "path", "number").agg(F.when(F.max("wanted") != "", F.bool_or(F.col("cited") != "")).alias("supplement_cited"))


def sentences(texts: DataFrame, key: list[str], text: str) -> DataFrame:
    """(key, nth, sentence), white space trimmed, empty ones left out."""
    rows = texts.select(*key, F.posexplode(F.split(F.coalesce(text, F.lit("")), r"[.!?]\s+")).alias("nth", "sentence"))
    return rows.withColumn("sentence", F.trim("sentence")).filter("sentence <> ''")


def term_mentions(sentence: DataFrame, key: list[str], term: str, negation: str) -> DataFrame:
    """For each document: sentences with the term, and whether a negated one wins over the plain ones."""
    hit = F.col("sentence").rlike(term)
    return sentence.groupBy(*key).agg(F.count_if(hit).alias("n_mentions"), F.count("*").alias("n_sentences"), F.max(F.when(hit, F.col("sentence").rlike(negation))).alias("negated")).withColumn("state", F.when(F.col("negated"), "negated").when(F.col("n_mentions") > 0, "stated").otherwise("not_mentioned")).drop("negated")


def word_list(text) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def run_lengths(forms: DataFrame, form: str) -> list[int]:
    """How many words the forms have, each number once."""
    return sorted(r["n"] for r in forms.select(F.size(word_list(form)).alias("n")).distinct().collect() if r["n"] > 0)


def word_runs(rows: DataFrame, key: list[str], text: str, lengths: list[int]) -> DataFrame:
    """(key, run): every run of so many whole words, once."""
    words = F.col("_words")  # a column of its own: read once a row, not once a run
    sizes = F.array(*[F.lit(n) for n in lengths]).cast("array<int>")
    runs = F.flatten(F.transform(sizes, lambda n: F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(F.array().cast("array<string>"))))
    return rows.withColumn("_words", word_list(text)).select(*key, F.explode(F.array_distinct(runs)).alias("run"))


FEW_FORMS = 100_000


def name_matches(forms: DataFrame, titles: DataFrame, longest: int = 4, common: int = 50) -> DataFrame:
    """forms (form, strength), titles (title_id, title): the strongest form that stands in a title as a run of words; forms with many hits are flagged.

    A form matches by its words, however many, or where up to `longest` words of the title equal it without spaces."""
    forms = kept(forms.withColumn("_w", word_list("form")).filter(F.size("_w") > 0), "forms")
    # Spark takes exploded runs for no larger than their titles: a few forms are broadcast, else nothing is
    by = F.broadcast if forms.count() <= FEW_FORMS else lambda x: x.hint("merge")
    near = word_runs(titles, ["title_id"], "title", list(range(1, longest + 1))).withColumn("run", F.replace("run", F.lit(" "), F.lit("")))
    far = word_runs(titles, ["title_id"], "title", [n for n in run_lengths(forms, "form") if n > longest])
    hits = near.join(by(forms.select(F.array_join("_w", "").alias("run"), "form", "strength")), "run")
    hits = hits.unionByName(far.join(by(forms.select(F.array_join("_w", " ").alias("run"), "form", "strength")), "run")).drop("run").distinct()
    n = hits.groupBy("form").agg(F.count_distinct("title_id").alias("n_titles"))
    best = Window.partitionBy("title_id").orderBy("strength", "form")
    return hits.join(by(n), "form").withColumn("nth", F.row_number().over(best)).filter("nth = 1").select("title_id", "form", "strength", "n_titles", (F.col("n_titles") >= common).alias("is_common"))


def exactly_one(rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """One row per key: its fields if exactly one record answers, else none and why."""
    g = rows.groupBy(key).agg(F.count("*").alias("n_records"), *[F.min(f).alias(f) for f in fields])
    one = F.col("n_records") == 1
    return g.select(key, "n_records", *[F.when(one, F.col(f)).alias(f) for f in fields], F.when(one, "available").otherwise("several_records").alias("state"))


def duplicate_class(rows: DataFrame, key: list[str], alias: list[str], substance: list[str]) -> DataFrame:
    """Keys with several rows: identical, alias_only, or substantive_conflict."""
    d = lambda c: F.count_distinct(F.coalesce(F.col(c).cast("string"), F.lit("\0")))
    conflict = sum((F.when(d(c) > 1, 1).otherwise(0) for c in substance), F.lit(0)) > 0
    renamed = sum((F.when(d(c) > 1, 1).otherwise(0) for c in alias), F.lit(0)) > 0
    return rows.groupBy(*key).agg(F.count("*").alias("n_rows"), F.when(conflict, "substantive_conflict").when(renamed, "alias_only").otherwise("identical").alias("duplicate_class")).filter("n_rows > 1")


def folded(rows: DataFrame, key: str, order: str, field: str, date: str) -> DataFrame:
    """One row per key: the first value shown, all values listed in order, the date only where all agree."""
    listed = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct(order, field))), lambda x: x[field]))
    return rows.groupBy(key).agg(F.min_by(field, order).alias("shown"), F.array_join(listed, "; ").alias("listed"), F.when(F.count_distinct(date) == 1, F.min(date)).alias("agreed"), F.count("*").alias("n_rows"))


def with_reviews(links: DataFrame, reviews: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(links with their review or 'unreviewed', reviews of links that no longer exist)."""
    joined = links.join(reviews, key, "left").withColumn("review_state", F.coalesce("decision", F.lit("unreviewed")))
    return joined, reviews.join(links, key, "left_anti")


def best_state(rows: DataFrame, key: str, state: str, order: list[str]) -> DataFrame:
    """The state of highest precedence for each key, and how many rows hold it."""
    rank = F.create_map(*[F.lit(x) for i, s in enumerate(order) for x in (s, i)])[F.col(state)]
    return rows.withColumn("_r", rank).groupBy(key).agg(F.min_by(state, "_r").alias("overall"), F.count("*").alias("n_routes"))


def differences(left: DataFrame, right: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, listed, official) wherever two tables disagree about a field; null against a value is a difference."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"a.{f}").cast("string").alias("listed"), F.col(f"b.{f}").cast("string").alias("official")) for f in fields])
    both = left.alias("a").join(right.alias("b"), F.col(f"a.{key}") == F.col(f"b.{key}"))
    return both.select(F.col(f"a.{key}").alias(key), F.explode(F.filter(pairs, lambda x: ~x["listed"].eqNullSafe(x["official"]))).alias("x")).select(key, "x.*")


GRAM, MOST_KEYWORDS = 3, 50_000


def keyword_rows(ontology: dict[str, dict[str, list[str]]]) -> list[tuple[str, str, str, int]]:
    """(keyword, primary, secondary, position) of an ontology of primary, secondary and keywords: a keyword's last categories hold, in its first place."""
    found: dict[str, tuple[str, str]] = {}
    for primary, secondaries in ontology.items():
        for secondary, words in secondaries.items():
            for word in words:
                found[word.lower()] = (primary, secondary)
    return [(w, *c, i) for i, (w, c) in enumerate(found.items())]


def plain_condition(text: Column) -> Column:
    """Lower case; punctuation but hyphens and slashes, and white space, as single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), r"(?U)[^\w\s/-]", " "), r"(?U)\s+", " "))


def keyword_hits(texts: DataFrame, text: str, plain: str, keywords: DataFrame) -> DataFrame:
    """(text, keyword, ...) wherever a keyword stands in a plain text, also within a word.

    Texts and keywords meet by equality of the keyword's first GRAM letters (all of a shorter one); what follows is compared then. A place of a text
    travels with as many letters as the longest keyword has, so that long texts cost no more than their length."""
    longest = keywords.agg(F.max(F.length("keyword"))).first()[0] or 0
    size = F.length(plain)
    places = texts.select(text, plain, F.explode(F.when(size > 0, F.sequence(F.lit(1), size))).alias("_i"))
    places = places.select(text, F.substring(plain, F.col("_i"), F.lit(longest)).alias("_rest"))
    grams = F.array_distinct(F.array(*[F.substring("_rest", F.lit(1), F.lit(n)) for n in range(1, GRAM + 1)]))
    places = places.select(text, "_rest", F.explode(grams).alias("_gram")).distinct()
    return places.join(keywords.withColumn("_gram", F.left("keyword", F.lit(GRAM))), "_gram").filter(F.startswith("_rest", "keyword")).drop("_gram", "_rest")


def longest_keyword(items: DataFrame, text: str, keywords: DataFrame, least: float = 85.0) -> DataFrame:
    """items with (primary, secondary) of the longest keyword that stands in the text, within words too, the first by position on ties; else of the
    keyword whose words resemble it most (a token-set ratio of `least`; ties as before); else Other / Uncategorized.

    keywords: keyword, primary, secondary, position. Those that are compared by likeness reach every task: a curated list of at most MOST_KEYWORDS."""
    distinct = items.select(text).distinct().withColumn("_plain", plain_condition(F.col(text))).filter("_plain <> ''")
    order = F.struct(F.length("keyword").alias("n"), (-F.col("position")).alias("p"), "primary", "secondary")
    best = keyword_hits(distinct, text, "_plain", keywords).groupBy(text).agg(F.max(order).alias("x"))
    words = [r["keyword"] for r in keywords.select("keyword", "position").distinct().orderBy(F.length("keyword"), F.desc("position")).limit(MOST_KEYWORDS + 1).collect()]
    if len(words) > MOST_KEYWORDS:
        raise ValueError(f"over {MOST_KEYWORDS} keywords to compare with")
    rest = distinct.join(best, text, "left_anti")
    near = closest(rest, text, [(w, w) for w in words], least, plain_condition(F.col(text)), token_set_ratio, rank={w: i for i, w in enumerate(words)}).filter("outcome is not null").select(text, F.col("outcome").alias("keyword"))
    near = near.join(keywords, "keyword").groupBy(text).agg(F.max(order).alias("x"))
    joined = items.join(best.unionByName(near), text, "left")
    return joined.select(*items.columns, F.coalesce("x.primary", F.lit("Other")).alias("primary"), F.coalesce("x.secondary", F.lit("Uncategorized")).alias("secondary"))


def most_frequent(rows: DataFrame, key: str, primary: str, secondary: str, order: Column) -> DataFrame:
    """The most frequent primary of each key, the alphabetically last on ties, and the first secondary of it in source order."""
    counted = rows.groupBy(key, primary).agg(F.count("*").alias("n"), F.min_by(secondary, order).alias(secondary))
    return counted.groupBy(key).agg(F.max(F.struct("n", primary, secondary)).alias("x")).select(key, f"x.{primary}", f"x.{secondary}", "x.n")


def review_queue(links: DataFrame, documents: DataFrame) -> DataFrame:
    """(tier, entity, n_evidence, rank): what to review first, nothing cut off. links: entity, method, validation; documents: entity, is_candidate,
    has_extraction, mentions_race, mentions_sex.

    Tiers: identifier-confirmed links; name-and-organisation links; candidates among documents of entities without an extraction; and entities with name-only
    or unresolved links only. By evidence, then entity; the third tier by confirmed links, then what its texts mention."""
    confirmed, strong = F.col("validation") == "identifier_confirmed", F.col("method") == "device_name_and_organisation_match"
    weak = ((F.col("method") == "device_name_match") & (F.col("validation") != "rejected_by_rule")) | (F.col("validation") == "identifier_not_resolved")
    n = links.groupBy("entity").agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in (("t1", confirmed), ("t2", strong), ("t4", weak))])
    d = documents.groupBy("entity").agg(F.bool_or("has_extraction").alias("done"), F.count_if("is_candidate").alias("t3"), *[F.coalesce(F.max(F.when(F.col("is_candidate"), F.col(c).cast("int"))), F.lit(0)).alias(c) for c in ("mentions_race", "mentions_sex")])
    both = n.join(d, "entity", "full").na.fill(0, ["t1", "t2", "t3", "t4", "mentions_race", "mentions_sex"])
    item = lambda tier, n, cond: F.when(cond, F.struct(F.lit(tier).alias("tier"), F.col(n).alias("n_evidence")))
    tiers = F.array_compact(F.array(item(1, "t1", F.col("t1") > 0), item(2, "t2", F.col("t2") > 0), item(3, "t3", (F.col("t3") > 0) & ~F.coalesce("done", F.lit(False))), item(4, "t4", (F.col("t4") > 0) & (F.col("t1") + F.col("t2") == 0))))
    rows = both.select("entity", F.when(F.col("t1") > 0, 1).otherwise(0).alias("c"), "mentions_race", "mentions_sex", F.explode(tiers).alias("x")).select("entity", "c", "mentions_race", "mentions_sex", "x.*")
    third = F.col("tier") == 3
    by = {f"_{c}": F.when(third, -F.col(c)).otherwise(0) for c in ("c", "mentions_race", "mentions_sex")} | {"_n": F.when(~third, -F.col("n_evidence")).otherwise(0)}
    placed = numbered(kept(rows.withColumns(by), "queue"), ["tier", *by, "entity"])  # ranges of all tiers, of like size
    first = placed.groupBy("tier").agg(F.min("position").alias("_first"))  # a row a tier
    return placed.join(F.broadcast(first), "tier").select("tier", "entity", "n_evidence", (F.col("position") - F.col("_first") + 1).cast("int").alias("rank"))


def cited_studies(citations: DataFrame, answers: DataFrame, parents: DataFrame) -> DataFrame:
    """citations: document, identifier; answers: identifier, status, own_id (of the record that came back); parents: document, parent. Every citation
    with its state, and whether the document itself cites it or only its parent does. Only 'resolves' supports a link."""
    own = citations.select("document", "identifier", F.lit(1).alias("own"))
    inherited = parents.join(citations.select(F.col("document").alias("parent"), "identifier"), "parent").select("document", "identifier", F.lit(0).alias("own"))
    both = own.unionByName(inherited).groupBy("document", "identifier").agg(F.max("own").alias("own"))
    state = (
        F.when(F.col("status").isNull(), "not_looked_up").when(F.col("status") == 404, "not_found").when((F.col("status") != 200) | F.col("own_id").isNull(), "lookup_failed")
        .when(F.col("own_id") == F.col("identifier"), "resolves").otherwise("resolved_to_different_id")
    )
    return both.join(answers, "identifier", "left").select("document", "identifier", F.when(F.col("own") == 1, "own_document").otherwise("parent_document").alias("cited_by"), state.alias("state"))


def document_type(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, int]], markers: list[str], summary: str, letters: list[str], needed: int = 3) -> DataFrame:
    """(document, type, basis, page): what a document is, by its pages' text. pages: document, page from 1, text; labels: document, label_type.

    The first rule (type, pattern, leading pages or 0 for all) that any page matches decides, on its first such page. Where none or only a letter's
    does, `needed` different section markers make it a summary. A label gives the type of a document without text, of text that no rule
    matches, and of a letter with pages that could not be read."""
    t = F.coalesce("text", F.lit(""))
    hits = F.array_compact(F.array(*[F.when(t.rlike(p) & ((F.col("page") <= n) | (n == 0)), F.lit(i)) for i, (_, p, n) in enumerate(rules)]))
    marks = F.array_compact(F.array(*[F.when(t.rlike(p), F.lit(i)) for i, p in enumerate(markers)]))
    seen = pages.select("document", "page", hits.alias("hits"), marks.alias("marks"), (F.length(F.regexp_replace(t, "[^A-Za-z0-9]", "")) < 20).alias("blank"))
    rule = seen.select("document", "page", F.explode("hits").alias("rule")).groupBy("document").agg(F.min(F.struct("rule", "page")).alias("r"))
    votes = seen.select("document", "page", F.explode("marks").alias("m")).groupBy("document", "m").agg(F.min("page").alias("page")).groupBy("document").agg(F.count("*").alias("votes"), F.min("page").alias("first_mark"))
    whole = seen.groupBy("document").agg(F.every("blank").alias("no_text"), F.bool_or("blank").alias("some_blank")).join(rule, "document", "left").join(votes, "document", "left").join(labels, "document", "left")
    name = F.get(F.array(*[F.lit(x) for x, _, _ in rules]), F.col("r.rule"))
    letter = F.coalesce(name.isin(*letters), F.lit(False))
    voted = (F.coalesce("votes", F.lit(0)) >= needed) & (F.col("r").isNull() | letter)
    unread = letter & ~voted & F.col("label_type").isNotNull() & ~F.col("label_type").isin(*letters) & F.col("some_blank")
    row = lambda kind, basis, page: F.struct(kind.alias("type"), F.lit(basis).alias("basis"), page.cast("int").alias("page"))
    label, none = F.col("label_type"), F.lit(None)
    found = (
        F.when(F.col("no_text"), F.when(label.isNotNull(), row(label, "official_label_only", none)).otherwise(row(F.lit("unclassified_no_text"), "none", none)))
        .when(voted, row(F.lit(summary), "text", F.col("first_mark"))).when(unread, row(label, "official_label_unread_pages", F.col("r.page"))).when(F.col("r").isNotNull(), row(name, "text", F.col("r.page")))
        .when(label.isNotNull(), row(label, "official_label_text_unmatched", none)).otherwise(row(F.lit("other"), "text", none))
    )
    return whole.select("document", found.alias("x")).select("document", "x.*")
