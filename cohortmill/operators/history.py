"""From week to week: what changed, what is still open, which snapshots and revisions stay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.folders import kept


def changes(before: DataFrame, now: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Added, removed and changed keys with both values; equal ones are left out."""
    a, b = before.select(*keys, F.col(value).alias("before"), F.lit(True).alias("_a")), now.select(*keys, F.col(value).alias("after"), F.lit(True).alias("_b"))
    both = a.join(b, keys, "full").filter(~F.col("before").eqNullSafe(F.col("after")) | F.col("_a").isNull() | F.col("_b").isNull())
    kind = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").otherwise("changed")
    return both.select(*keys, "before", "after", kind.alias("change"))


def with_cause(changed: DataFrame, rules_before: Column, rules_now: Column, edited: Column) -> DataFrame:
    """registry_edit, rules_change, both, unknown, or no_prior where there is nothing to compare with."""
    rules = rules_before != rules_now
    return changed.withColumn("cause", F.when(rules_before.isNull(), "no_prior").when(rules & edited, "both").when(rules, "rules_change").when(edited, "registry_edit").otherwise("unknown"))


def inbox(seen: DataFrame, key: list[str], week: str, as_of: Column) -> DataFrame:
    """For every key: when it was first and last seen, whole weeks since the first, and whether it is open (seen in the latest week)."""
    ever = seen.groupBy(*key).agg(F.min(week).alias("first_seen"), F.max(week).alias("last_seen"), F.count_distinct(week).alias("n_weeks"))
    return ever.withColumns({"weeks_open": F.floor(F.datediff(as_of, F.col("first_seen")) / 7), "is_open": F.col("last_seen") == as_of})


def exits(prior: DataFrame, now: DataFrame, key: str, rules_changed: bool) -> DataFrame:
    """Items of the prior inbox (key, prior_n, first_seen, resolved: a curator's note or null) that are open no more, with the cause.
    now: every key of this week with its bucket, null where it is still unrecognised."""
    both = prior.join(now.withColumn("is_there", F.lit(True)), key, "left")
    is_open = F.coalesce(F.col("is_there") & F.col("bucket").isNull() & F.col("resolved").isNull(), F.lit(False))
    mapped = F.lit("mapped_by_rules_change") if rules_changed else F.when(F.col("bucket").isNotNull(), "mapped_unknown_cause").otherwise("reason_changed")
    cause = F.when(F.col("resolved").isNotNull(), "resolved_by_curator").when(F.col("is_there"), mapped).otherwise("no_longer_in_registry")
    return both.filter(~is_open).select(key, "prior_n", "first_seen", cause.alias("cause"), F.col("bucket").alias("bucket_after"))


def metric_delta(before: DataFrame, now: DataFrame) -> DataFrame:
    """(metric, now, prior, delta) of two (metric, value) tables; what one lacks is null, not zero."""
    both = now.select("metric", F.col("value").alias("now")).join(before.select("metric", F.col("value").alias("prior")), "metric", "full")
    return both.withColumn("delta", F.col("now") - F.col("prior"))


def head_revisions(revisions: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last revision of each key."""
    last = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    return revisions.withColumn("nth", F.row_number().over(last)).filter("nth = 1").drop("nth")


def upsert(state: DataFrame, heads: DataFrame, key: str, revision: str, withdrawn: Column) -> DataFrame:
    """The action each head takes on the state: insert, update, keep (replayed or older), delete or ignore; and untouched rows."""
    s = state.select(key, F.col(revision).alias("held"))
    h = heads.withColumn("_w", withdrawn).select(key, F.col(revision).alias("offered"), "_w")
    both = s.join(h, key, "full")
    action = (
        F.when(F.col("offered").isNull(), "untouched")
        .when(F.col("_w") & F.col("held").isNull(), "ignore")
        .when(F.col("held").isNull(), "insert")
        .when(F.col("offered") <= F.col("held"), "keep")
        .when(F.col("_w"), "delete")
        .otherwise("update")
    )
    return both.select(key, "held", "offered", action.alias("action"))


def supersession(records: DataFrame, rounds: int = 64) -> DataFrame:
    """records: id, replaces (the id that it supersedes, or null), withdrawn. (id, head, depth, state) of every id, each once.

    head: the last record of the chain that begins with the id, found by doubling pointers, so that chains of any length take steps in the
    logarithm of it; each round is written. depth: how many records lie between. state: current (nothing replaces it), superseded, withdrawn (the head
    is a tombstone), or quarantined: the id lies on a cycle or leads into one, or into an id that several records replace, or is itself given twice with
    different contents. A record that replaces itself or an id that is not there is quarantined; what it names is left as it is."""
    given = records.select("id", "replaces", F.coalesce("withdrawn", F.lit(False)).alias("withdrawn")).distinct()
    once = given.groupBy("id").agg(F.count("*").alias("_n"), F.min("replaces").alias("replaces"), F.bool_or("withdrawn").alias("withdrawn"))
    there = once.select(F.col("id").alias("replaces"), F.lit(True).alias("_there"))
    once = once.join(there, "replaces", "left").withColumn("_stray", (F.col("_n") > 1) | F.coalesce(F.col("replaces") == F.col("id"), F.lit(False)) | (F.col("replaces").isNotNull() & F.col("_there").isNull()))
    by = once.filter("replaces is not null and not _stray").groupBy(F.col("replaces").alias("id")).agg(F.count("*").alias("_by"), F.min("id").alias("_next"))
    links = once.join(by, "id", "left").select("id", "withdrawn", (F.col("_stray") | (F.coalesce("_by", F.lit(0)) > 1)).alias("bad"), F.when(F.col("_by") == 1, F.col("_next")).alias("next"))
    links = kept(links.select("id", "withdrawn", "bad", "next", F.when(F.col("next").isNotNull(), 1).otherwise(0).cast("long").alias("depth"), F.coalesce("next", "id").alias("head")), "chains")
    moving, moved = links.filter("next is not null").count(), None
    while moving and moving != moved and rounds:  # a longer chain would have ended some rows in the last round: where none did, what still moves goes round
        ahead = links.filter("next is not null").select(F.col("id").alias("head"), F.col("head").alias("_head"), F.col("depth").alias("_depth"), F.col("bad").alias("_bad"))
        stepped = links.drop("moved").join(ahead, "head", "left").select("id", "withdrawn", (F.col("bad") | F.coalesce("_bad", F.lit(False))).alias("bad"), "next", (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"), F.coalesce("_head", "head").alias("head"), (F.col("next").isNotNull() & F.col("_head").isNotNull()).alias("moved"))
        links, rounds, moved = kept(stepped, "chains"), rounds - 1, moving
        moving = links.filter("moved").count()
    ends = links.select(F.col("id").alias("head"), F.col("next").isNotNull().alias("_round"), F.col("withdrawn").alias("_gone"), F.col("bad").alias("_end_bad"))
    out = links.join(ends, "head", "left")
    bad = F.col("bad") | F.coalesce("_round", F.lit(False)) | F.coalesce("_end_bad", F.lit(False))
    state = F.when(bad, "quarantined").when(F.coalesce("_gone", F.lit(False)), "withdrawn").when(F.col("head") == F.col("id"), "current").otherwise("superseded")
    return out.select("id", F.when(~bad, F.col("head")).alias("head"), F.when(~bad, F.col("depth")).alias("depth"), state.alias("state"))


def appended(history: DataFrame, now: DataFrame, batch: str) -> DataFrame:
    """The rows that a batch adds to an append-only history of (id, head, state): ids whose head or state is new. A batch sent again adds nothing."""
    last = Window.partitionBy("id").orderBy(F.desc("batch"))
    held = history.withColumn("_k", F.row_number().over(last)).filter("_k = 1").select("id", F.col("head").alias("_head"), F.col("state").alias("_state"), F.lit(True).alias("_held"))
    fresh = now.join(held, "id", "left").filter(F.col("_held").isNull() | ~F.col("head").eqNullSafe(F.col("_head")) | (F.col("state") != F.col("_state")))
    return fresh.select("id", "head", "state", F.lit(batch).alias("batch"))


def retention(dates: DataFrame, latest: Column, epoch: str, fortnights: int) -> DataFrame:
    """Snapshots to keep: the earliest of each of the newest fortnights, and the newest of each month these leave uncovered."""
    old = dates.select("date").distinct().filter(F.col("date") < latest).withColumns({"fortnight": F.floor(F.datediff("date", F.lit(epoch).cast("date")) / 14), "month": F.date_format("date", "yyyy-MM")})
    newest = Window.orderBy(F.desc("fortnight"))  # over one date a fortnight
    complete = old.groupBy("fortnight").agg(F.min("date").alias("date")).withColumn("nth", F.row_number().over(newest)).filter(F.col("nth") <= fortnights).select("date")
    covered = complete.select(F.date_format("date", "yyyy-MM").alias("month"))
    monthly = old.join(complete, "date", "left_anti").join(covered, "month", "left_anti").filter(F.col("month") != F.date_format(latest, "yyyy-MM")).groupBy("month").agg(F.max("date").alias("date")).select("date")
    return complete.withColumn("kept_as", F.lit("complete")).unionByName(monthly.withColumn("kept_as", F.lit("aggregate")))
