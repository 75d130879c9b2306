"""Row labels and table titles of posted baseline tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import bound

#: Patterns of sex and gender labels, one list for each outcome. The order of the outcomes below is the rule.
STRUCTURAL = [
    r"^(all|both|neither|total|overall|any|sex|gender|count|multiple|two or more|na|n/a)$", r"^(all|both|any|either) ?genders?$", r"\bany gender\b", r"\ball genders?\b",
    r"^sex/gender baseline$", r"^single gender identity$", r"more than one (category|categories|race)", r"^number of participants$",
    r"^(patients?|participants?|subjects?|pharmacies|sites?|providers?|clinicians?)$", r"patients for whom", r"participants for whom",
    r"^(father|fathers|mother|mothers|grandmother|grandfather|parent|parents)$", r"^(child|children|infant|infants|neonates?)$", r"excluded from analysis",
    r"participated in [0-9]{4}", r"never treated", r"core participants", r"^pregnant$", r"^censored$",
]
CONTEXT = [r"white|black|african|asian|hispanic|latin[oax]|caucasian|american indian", r"native hawaiian|pacific islander|alaska native|middle eastern", r"\bcohort\b", r"\bextension\b", r"\barm\b", r"withdrew|withdrawn", r"^phase [ivx0-9]+ ?-"]
UNKNOWN = [
    r"unknown", r"not reported", r"unreported", r"not available", r"unavailable", r"not listed", r"not collected", r"not specified", r"unspecified", r"undifferentiated", r"not provided", r"not obtained",
    r"not documented", r"not measured", r"not captured", r"not recorded", r"not stated", r"not indicated", r"not given", r"not identif(ied|ies)\b", r"not asked", r"not known", r"no data", r"\bno\b[^.]{0,25}\bdata\b",
    r"did not (report|identify|collect|give|state|answer|respond|disclose|complete)", r"no (answer|response|selected answer)", r"\bmissing\b", r"prefer(s|red)? not", r"prefer not", r"(choose|chose|chooses) not to",
    r"do(es)? not wish", r"did not wish", r"refus", r"declin", r"de-?identified", r"undisclosed", r"not disclosed", r"\bnot sure\b", r"\bunsure\b",
]
CIS_TRANS = [r"cisgender|transgender|trans-|cis-|\bcis\b|\btrans\b|trandgender"]
SEX_WORD = [r"female|male|wom[ae]n|\bm[ae]n\b|girl|boy"]
DIVERSE = [
    r"non[- ]?binary", r"nonconforming", r"non[- ]?conforming", r"gender ?queer", r"gender ?diverse", r"gender ?fluid", r"gender[- ]?expansive", r"gender[- ]?variant", r"gender[- ]?minorit",
    r"sexual or gender minorit", r"sex(ual)? and gender minorit", r"agender", r"bigender", r"pangender", r"third gender", r"another gender", r"other gender", r"two-? ?spirit", r"intersex", r"\bothers?\b",
    r"cisgender", r"transgender", r"trandgender", r"\btrans\b", r"trans[- /]?(man|men|wom[ae]n|masc|femin|person|people|ftm|mtf)", r"androgynous", r"\bfluid\b", r"\bdiverse\b", r"^ambiguous$",
    r"multi[- ]?gender", r"multiple gender", r"more than one gender", r"gender different from sex assigned at birth", r"self[- ]?(describe|described|identify|identifies|identification)", r"prefer to self",
    r"identify in another way", r"(another|different|additional) (identity|identification|description)", r"additional sex or gender", r"something else", r"(none|null) of (these|the above|the listed)",
    r"do not identify as any", r"tgncnb", r"\btgnc\b", r"questioning",
]
ORIENTATION = [r"bisexual", r"\bqueer\b", r"\bgay\b", r"lesbian", r"asexual", r"pansexual", r"homosexual", r"heterosexual", r"\bstraight\b", r"sexual orientation"]
FEMALE, MALE = [r"\bfemal|wom[ae]n|girl"], [r"male|\bm[ae]n\b|boy"]
#: Words of units and parameters that mean shares, not people.
PERCENT_WORDS = "%|percent"


def _has(z: Column, patterns: list[str]) -> Column:
    return z.rlike("|".join(patterns))


def label_key(label: Column) -> Column:
    """Lower case, white space squashed, trailing footnote marks gone."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.trim(label)), r"\s+", " "), "[*†‡]+$", ""))


def _group_row(z: Column) -> Column:
    return _has(z, CONTEXT) & ~_has(z, SEX_WORD) & ~_has(z, CIS_TRANS) & ~_has(z, DIVERSE) & ~_has(z, UNKNOWN)


def sex_bucket(label: Column) -> Column:
    """female, male, unknown, gender_diverse, ambiguous, or '' for what is excluded or not recognised."""
    return bound(label_key(F.coalesce(label, F.lit(""))), _bucket)


def _bucket(z: Column) -> Column:
    return (
        F.when((z == "") | _has(z, STRUCTURAL) | _group_row(z), "")
        .when(_has(z, UNKNOWN), "unknown")
        .when(_has(z, CIS_TRANS) & _has(z, SEX_WORD), "ambiguous")
        .when(_has(z, DIVERSE), "gender_diverse")
        .when(_has(z, ORIENTATION), "")
        .when(_has(z, FEMALE) | (z == "f"), "female")
        .when(_has(z, MALE) | (z == "m"), "male")
        .otherwise("")
    )


def unmapped_reason(label: Column) -> Column:
    z = label_key(F.coalesce(label, F.lit("")))
    return (
        F.when(z == "", "empty")
        .when(sex_bucket(label) != "", "mapped")
        .when(_has(z, STRUCTURAL) | _group_row(z), "structural_or_group")
        .when(_has(z, ORIENTATION), "sexual_orientation")
        .otherwise("unrecognized")
    )


def measure_type(title: Column) -> Column:
    t = F.lower(title)
    return F.when(t.startswith("sex:") | (t == "sex"), "sex").when(t.contains("customized"), "sex_gender_customized").when(t.startswith("gender"), "gender").when(t.isNotNull(), "other")


def is_sex_gender(title: Column) -> Column:
    return F.coalesce(title.rlike("(?i)sex|gender"), F.lit(False))


def is_percentage(unit: Column, parameter: Column) -> Column:
    return F.lower(F.coalesce(unit, F.lit(""))).rlike(PERCENT_WORDS) | F.lower(F.coalesce(parameter, F.lit(""))).rlike("percent")


def unit_class(unit: Column, parameter: Column) -> Column:
    p = F.upper(F.coalesce(parameter, F.lit("")))
    return F.when(p == "COUNT_OF_UNITS", "count_of_units").when(p.isin("MEAN", "MEDIAN"), "mean_or_median").when(is_percentage(unit, parameter), "percent").otherwise("participant_like")


def clean_label(label: Column) -> Column:
    """Without invisible characters, a 'Race (n, % White)' wrapper and trailing ', %' or ', n'."""
    visible = F.trim(F.translate(label, "​‌‍﻿⁠", ""))
    inner = F.regexp_extract(visible, r"(?i)^[^()]*\(\s*(?:n\s*,\s*%|%|n)\s*,?\s+([^()]+)\)$", 1)
    return F.trim(F.regexp_replace(F.when(inner != "", F.trim(inner)).otherwise(visible), r"(?i),\s*(%|n|n \(%\))$", ""))
