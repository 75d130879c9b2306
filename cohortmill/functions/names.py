"""Names of sponsors, organisations, devices and phases in comparable form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Legal forms that end a sponsor's name. 'kgaa' is not among them: it tells two companies apart.
LEGAL_FORMS = "incorporated inc llc llp ltd limited gmbh ag plc corp corporation co company sa nv bv ab oy kk spa sas".split()
#: Company patterns in order, the first that matches decides.
COMPANIES = [
    (r"upjohn.*mylan.*viatris|^viatris", "Viatris"),
    (r"merck kgaa|merck serono|merck healthcare kgaa|^emd serono", "Merck KGaA"),
    (r"^organon", "Organon"),
    (r"mead johnson", "Mead Johnson"),
    (r"wyeth|hospira|array ?biopharma|king pharmaceuticals|^pharmacia|medivation|anacor|^pfizer|seagen", "Pfizer"),
    (r"glaxo|smithkline|^gsk\b|stiefel.*gsk|human genome sciences.*gsk|sirtris.*gsk", "GlaxoSmithKline"),
    (r"hoffmann-la roche|^roche\b|roche pharma|roche-genentech|roche diagnostics|roche farma", "Roche"),
    (r"merck sharp|^msd\b|schering-plough|subsidiary of merck & co|merck frosst|acceleron pharma", "Merck Sharp & Dohme"),
    (r"^sanofi|sanofi-synthelabo|aventis|genzyme|bioverativ|^ablynx|principia biopharma", "Sanofi"),
    (r"bristol-?myers|^celgene|juno therapeutics.*(bristol|celgene)|karuna.*bristol|adnexus.*bristol", "Bristol-Myers Squibb"),
    (r"^astrazeneca|medimmune|^alexion", "AstraZeneca"),
    (r"^abbvie|pharmacyclics|abbvie \(prior sponsor", "AbbVie"),
    (r"^abbott", "Abbott"),
    (r"^novartis", "Novartis"),
    (r"^janssen|johnson & johnson", "Johnson & Johnson"),
    (r"^boehringer", "Boehringer Ingelheim"),
    (r"eli lilly|^lilly\b", "Eli Lilly and Company"),
    (r"novo nordisk", "Novo Nordisk"),
    (r"^takeda", "Takeda"),
    (r"^amgen", "Amgen"),
    (r"^bayer", "Bayer"),
    (r"gilead", "Gilead Sciences"),
    (r"^biogen", "Biogen"),
    (r"^astellas", "Astellas Pharma"),
]
#: Endings stripped from other company names, without a word boundary, four times.
COMPANY_ENDINGS = r"[ ,]*(inc|corp|corporation|co|company|ltd|limited|llc|l\.l\.c|lp|l\.p|plc|gmbh|ag|s\.?a|s\.?p\.?a|a/s|n\.?v|ulc|k\.k|s\.r\.o|sas|pharmaceuticals?|pharma)\.?$"
#: How a registry name says whose subsidiary it is.
SUBSIDIARY = r"(?i)^(.+?),?\s+(?:is\s+)?(?:now\s+)?(?:a\s+)?(?:wholly[- ]owned\s+)?subsidiar\w+\s+of\s+(.+)$"
PHASES = [("earlyphase1", "Phase 1"), ("^phase1$", "Phase 1"), ("phase1phase2", "Phase 1/2"), ("^phase2$", "Phase 2"), ("phase2phase3", "Phase 2/3"), ("^phase3$", "Phase 3"), ("^phase4$", "Phase 4")]


def squashed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def first_match(text: Column, rules: list[tuple[str, str]], otherwise: Column) -> Column:
    """The outcome of the first pattern that matches, in order."""
    chain = F.when(text.rlike(rules[0][0]), rules[0][1])
    for pattern, outcome in rules[1:]:
        chain = chain.when(text.rlike(pattern), outcome)
    return chain.otherwise(otherwise)


def phase_name(text: Column) -> Column:
    return first_match(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[_\s|,/]+", ""), PHASES, F.lit("N/A or other"))


def sponsor_key(name: Column) -> Column:
    """Lower case, no punctuation, '&' as 'and', trailing legal forms and 'and' gone in one anchored pass."""
    s = squashed(F.regexp_replace(F.regexp_replace(F.lower(F.trim(name)), "[.,;:()\"']", " "), "&", " and "))
    return F.trim(F.regexp_replace(s, rf"(\s+({'|'.join(['and', *LEGAL_FORMS])}))+$", ""))


def subsidiary(name: Column) -> tuple[Column, Column]:
    """(entity, ultimate parent), keys; a plain name is its own entity and has no parent. Chains of any length lead to their last link."""
    sub = F.nullif(F.regexp_extract(name, SUBSIDIARY, 1), F.lit(""))
    last = F.regexp_extract(name, r"(?i)^.*subsidiar\w+\s+of\s+(.+)$", 1)
    last = F.regexp_replace(F.regexp_replace(last, r"\(.*?\)\s*$", ""), r"^[ ,.]+|[ ,.]+$", "")
    return sponsor_key(F.coalesce(sub, name)), F.when(sub.isNotNull(), sponsor_key(last))


def company(name: Column) -> Column:
    raw = squashed(F.coalesce(name, F.lit("")))
    rest = raw
    for _ in range(4):
        rest = F.trim(F.regexp_replace(rest, f"(?i){COMPANY_ENDINGS}", ""))
    return first_match(raw, [(f"(?i){p}", c) for p, c in COMPANIES], squashed(rest))


def organisation_key(name: Column, legal_forms: list[str], connectives: list[str]) -> Column:
    """d/b/a and c/o tails and parentheses cut, dotted initials joined, legal forms and connectives dropped wherever they stand; never reduced to nothing."""
    s = F.regexp_replace(F.regexp_replace(name, r"(?i)\bd/b/a\b.*$", ""), r"(?i)\bc/o\b.*$", "")
    s = F.lower(F.regexp_replace(s, r"\([^)]*\)", " "))
    s = F.regexp_replace(s, r"\b([a-z])[./](?=[a-z]\b)", "$1")
    tokens = F.filter(F.split(F.regexp_replace(F.regexp_replace(s, "&", " and "), "[^a-z0-9]+", " "), " "), lambda t: t != "")
    kept = F.filter(tokens, lambda t: ~F.array_contains(F.array(*[F.lit(x) for x in [*legal_forms, *connectives]]), t))
    return F.array_join(F.when(F.size(kept) > 0, kept).otherwise(tokens), " ")


def pathway(number: Column) -> Column:
    """The regulatory pathway that a submission number's prefix stands for."""
    n = F.upper(F.trim(number))
    return F.when(n.startswith("DEN"), "de_novo").when(n.startswith("P"), F.when(n.contains("/S"), "pma_supplement").otherwise("pma")).when(n.startswith("K") | n.startswith("BK"), "510k").otherwise("unknown")


def stable_id(prefix: str, *parts: Column) -> Column:
    return F.concat(F.lit(prefix), F.left(F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("None")) for p in parts]), 256), F.lit(16)))
