"""Condition terms of a study document, and the state of their indexing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mesh_state(document: Column) -> Column:
    """no_derived and no_module: the key is missing. malformed: it holds null or no object. not_indexed: no terms. indexed."""
    v = F.try_parse_json(document)
    kind = lambda path: F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    top, derived = kind("$"), kind("$.derivedSection")
    has = lambda schema, key: schema.contains(f"{key}:")
    module, terms = kind("$.derivedSection.conditionBrowseModule"), F.try_variant_get(v, "$.derivedSection.conditionBrowseModule.meshes", "array<struct<id string, term string>>")
    return (
        F.when(~has(top, "derivedSection"), "no_derived")
        .when(~derived.startswith("OBJECT"), "malformed")
        .when(~has(derived, "conditionBrowseModule"), "no_module")
        .when(F.coalesce(~module.startswith("OBJECT"), F.lit(True)), "malformed")
        .when(has(module, "meshes") & terms.isNull(), "malformed")
        .when(F.coalesce(F.size(terms), F.lit(0)) > 0, "indexed")
        .otherwise("not_indexed")
    )
