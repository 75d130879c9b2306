"""Race labels with the readings that the written rules give them."""

import pytest
from pyspark.sql import functions as F

from cohortmill.functions import race, racegrammar
from cohortmill.plans.dimensions import RACE_LABELS

#: Not labels of several races, whatever else they are.
ONE = [
    "Asian and Pacific Islander", "Asian & Other Pacific Islander", "Black and African American", "Asian and Asian American", "American Indian and Alaska Native", "White and Hispanic", "White and Other", "Black and Unknown", "White, Asian", "Asian, Pacific Islander",
    "White or Black", "Black/White", "Multiple - child", "Mixed Asian", "Mixed - Any other mixed background", "Asian, Indigenous, Native Hawaiian and Pacific Islander, non-Hispanic", "Native Hawaiian and Other Pacific Islander",
]
#: By grammar: a label and its subcategory, None for none, False where the grammar does not read it.
GRAMMARS = {
    "mena_label": [("Arab/Middle Eastern", "middle_eastern"), ("Iranian/Persian", "middle_eastern_persian"), ("North African descent", "north_african"), ("Native Arab", False), ("Other: Arabic", False), ("Middle Eastern or North African/Mediterranean", False), ("Midwest", False)],
    "aian_label": [("Navajo Nation", None), ("Tribal members", False), ("Aboriginal", False), ("Canadian Aboriginal", None), ("Native Mexican", False), ("North, South or Central American Native", None)],
    "nhpi_label": [("Māori", None), ("Hawaiian-Pacific", None), ("Torres Strait Islander", False), ("Native Hawaiian or", False), ("Samoan", "samoan")],
    "uk_census_label": [("Mixed ethnic group / Other", False), ("(Mixed ethnic group:) White / Other", None), ("Mixed ethnic group and Other ethnic group", False), ("Mixed: White and Black Caribbean", None), ("Black / African / Caribbean / Black British - Caribbean", "caribbean"), ("British", False), ("Asian Welsh", None), ("Black or White British", False)],
    "european_label": [("North/Mid/East European", "european"), ("NZ European/Pākehā", "european"), ("New Zealander, European", "european"), ("European or New Zealander", False), ("North or European", False), ("White: Western European", "european_western"), ("Irish Traveller", None), ("Spanish", False), ("Eastern European or British", "european"), ("White British", False)],
    "asian_label": [("East/South East Asian", None), ("Asian (other than Chinese or Japanese)", None), ("Asian, Bangladeshi", "south_asian_bangladeshi"), ("Asian (China, Philippines, Vietnam, Korea, etc.)", None), ("Indian or Pakistani", "south_asian"), ("Indian (American)", False), ("Asian: Central/South", None), ("West Indian Asian", False), ("Asian )", False)],
    "black_label": [("Black (or African American)", None), ("Black (Caribbean or Haitian)", "caribbean"), ("Black (or Haitian)", None), ("Caribbean (Haitian)", "caribbean_haitian"), ("Black (Haitian, Jamaican, or other)", None), ("Black (Haitian or other Caribbean)", "caribbean"), ("Black (African) (e.g. Haitian)", "african"), ("Black including Haitian", None), ("Black (or Indigenous)", False),
                    ("Black or unspecified", False), ("Indigenous Caribbean", False), ("Race and Ethnicity : Black", None), ("all participants or Race: Black", False), ("Black (Haitian or other race)", False), ("South African", False), ("Black African (Nigerian, Ghanaian, or other)", "african")],
}


def test_labels(spark):
    labels = [(x[0],) for x in RACE_LABELS] + [(x,) for x in ONE] + [(None,), ("",)]
    got = {r.text: r for r in race.race_categories(spark.createDataFrame(labels, "text string"), "text").collect()}
    assert len(got) == len({x for x, in labels}) - 1
    for label, category, subcategory, flag in RACE_LABELS:
        assert (got[label].category, got[label].subcategory, got[label].flag) == (category or "other", subcategory, flag), label
    assert not [x for x in ONE if got[x].flag == "multirace_label"]
    assert got[""].flag == "unmapped"


@pytest.mark.parametrize("name", sorted(GRAMMARS))
def test_grammar(spark, name):
    df = spark.createDataFrame([(x,) for x, _ in GRAMMARS[name]], "label string")
    for column, made in racegrammar.READERS[name]("label", "r"):
        df = df.withColumn(column, made)
    got = {r.label: False if r.r is None or r.r.category == "west" else r.r.subcategory for r in df.select("label", F.col("r")).collect()}
    assert got == dict(GRAMMARS[name])
