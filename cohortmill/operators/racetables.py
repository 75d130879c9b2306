"""Rules over the rows of one race table: what a label means beside the others, and rows that count again what another row counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import clean_label
from ..functions.race import SPECIFIC
from ..functions.racegrammar import plain

#: Wordings of the rules below.
ASIAN_AND_PACIFIC = r"^(?:asians?(?: americans?)?\s*(?:&|\+|and)\s*(?:native )?(?:hawaiians?|pacific).*|(?:native )?(?:hawaiians?|(?:other )?pacific islanders?)[^&+]*?\s*(?:&|\+|and)\s*asians?(?: americans?)?)$"
WEST_ASIAN = r"^west(?:ern)?\s+asians?$"
NEAR_EAST_OR_SOUTH = r"arab|middle\s*east|north\s*afric|persian|iran|afghan|turk|south\s*asia|indian?(?![a-z])|pakistan|bangladesh|sri\s*lanka|sub\s*continent"
UNQUALIFIED = r"^(?:indigenous|aborigin(?:al|als|e|es)|natives?)(?:(?:\s*(?:/|,|&|or|and)\s*|\s+)(?:indigenous|aborigin(?:al|als|e|es)|natives?))*(?:\s+(?:people|peoples|person|persons|population))?$"


def table_rules(rows: DataFrame, by: list[str]) -> DataFrame:
    """rows: by (a trial and table), label, its reading (category, subcategory, confidence, flag, listed), region (where the trial's
    sites are). The readings as the table makes them:

    a comma list is several races where a row names one of them alone; Asian joined to Pacific is the old joint category where no
    row names either apart; West Asian is the subcontinent where the other Asian rows are East and Southeast Asian and no row names
    what lies between; Indigenous peoples of no named place are American Indian where all sites are in the Americas, other where none is."""
    w = Window.partitionBy(*by)
    z, cat, sub, flag = plain(clean_label(F.col("label"))), F.col("category"), F.col("subcategory"), F.col("flag")
    read = F.col("confidence") != "low"
    any_ = lambda cond: F.coalesce(F.max(cond).over(w), F.lit(False))
    alone = F.collect_set(F.when(F.col("listed").isNull() & (F.col("confidence") == "high") & cat.isin(*SPECIFIC) & (flag != "asian_pacific_grouped"), cat)).over(w)
    comma = F.coalesce(F.arrays_overlap("listed", alone), F.lit(False))
    apart = any_(read & (((cat == "asian") & ~z.rlike("pacific|hawai|islander")) | ((cat == "native_hawaiian_pacific_islander") & ~z.rlike("asian"))))
    grouped = (cat == "more_than_one_race") & z.rlike(ASIAN_AND_PACIFIC) & ~apart
    west = (flag == "unmapped") & z.rlike(WEST_ASIAN)
    elsewhere = any_(~west & (cat != "american_indian_alaska_native") & z.rlike(NEAR_EAST_OR_SOUTH))
    asian = ~west & (cat == "asian") & read
    peers = F.coalesce(sub.isin("east_asian", "southeast_asian"), F.lit(False))
    template = west & ~elsewhere & any_(asian & peers) & ~any_(asian & ~peers)
    unqualified = z.rlike(UNQUALIFIED) & z.rlike("indigenous|aborigin")
    row = lambda c, s, f: F.struct(F.lit(c).alias("category"), F.lit(s).cast("string").alias("subcategory"), F.lit(f).alias("flag"))
    change = (
        F.when(comma, row("more_than_one_race", None, "multirace_comma_list"))
        .when(grouped, row("asian", None, "asian_pacific_grouped"))
        .when(template, row("asian", "south_asian", "west_asian_template"))
        .when(unqualified & (F.col("region") == "americas"), row("american_indian_alaska_native", None, "indigenous_in_the_americas"))
        .when(unqualified & (F.col("region") == "outside_americas"), row("other", None, "indigenous_outside_americas"))
    )
    out = rows.withColumn("_change", change)
    keep = F.col("_change").isNull()
    return out.withColumns({c: F.when(keep, F.col(c)).otherwise(F.col(f"_change.{c}")) for c in ("category", "subcategory", "flag")}).drop("_change")


def breakdown_rows(rows: DataFrame, by: list[str], population: str, order: str) -> DataFrame:
    """Adds left_out: rows that count again the Asian participants of another row.

    Only where the table adds up to more than its population, and to exactly that without them: the largest Asian row is the parent
    (of equal ones a reading older than the label rules, then one without subcategory, then the first), the others are its breakdown
    if they add up to no more. Those that the label rules read are left out; if only the parent is such, it is."""
    w = Window.partitionBy(*by)
    asian, new = F.col("category") == "asian", (F.col("category") == "asian") & F.col("flag").isin("asian_label", "west_asian_template")
    n = F.col("value")
    rank = F.row_number().over(w.orderBy(asian.desc(), F.when(asian, n).desc(), new, F.col("subcategory").isNotNull(), order))
    out = rows.withColumns({"_parent": asian & (rank == 1), "_new": new})
    others = F.sum(F.when(asian & ~F.col("_parent"), n)).over(w)
    top, all_ = F.max(F.when(F.col("_parent"), n)).over(w), F.sum(n).over(w)
    nested = (F.sum(F.when(asian, 1)).over(w) >= 2) & F.max("_new").over(w) & (top >= others) & (all_ > F.col(population)) & (all_ - others == F.col(population))
    new_others = F.coalesce(F.max(F.col("_new") & ~F.col("_parent")).over(w), F.lit(False))
    gone = F.when(new_others, F.col("_new") & ~F.col("_parent")).otherwise(F.col("_parent"))
    return out.withColumn("left_out", F.coalesce(nested, F.lit(False)) & gone).drop("_parent", "_new")
