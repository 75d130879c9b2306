"""Contracts of paths over nested records: 'a.b' is a field, 'a[]' all elements of an array, 'a[].b' a field of each.

A list of paths is compiled to one projection, to one comparison, or to one count of what records lack; each is a single pass."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from .folders import kept

_PATH = re.compile(r"\w+(\[\])?(\.\w+(\[\])?)*")


def steps(path: str) -> list[str]:
    """'a[].b' as a, [], b."""
    if not _PATH.fullmatch(path):
        raise ValueError(f"malformed path: {path!r}")
    return re.findall(r"\[\]|\w+", path)


def tree(paths: list[str]) -> dict:
    """The paths as nested dicts; an empty one keeps its value whole. A path within another is kept by that one.

    Refused: a path that is malformed or listed twice, and two paths of which one reads a list where the other reads an object."""
    if twice := {p for p in paths if paths.count(p) > 1}:
        raise ValueError(f"listed twice: {sorted(twice)}")
    split = [steps(p) for p in paths]
    root: dict = {}
    for s in split:
        if any(len(o) < len(s) and s[: len(o)] == o for o in split):
            continue
        node = root
        for step in s:
            node = node.setdefault(step, {})
    check(root, "")
    return root


def check(node: dict, at: str) -> None:
    if "[]" in node and len(node) > 1:
        raise ValueError(f"{at or 'the record'} is read as a list and as an object")
    for step, inner in node.items():
        check(inner, at + step if step == "[]" or not at else f"{at}.{step}")


def projected(value: Column, of: DataType, node: dict) -> Column:
    """What the tree keeps of a value: structs within transforms, so that only these columns are read. null stays null."""
    if not node:
        return value
    if "[]" in node:
        if not isinstance(of, ArrayType):
            raise ValueError(f"no list: {of.simpleString()[:80]}")
        return F.transform(value, lambda x: projected(x, of.elementType, node["[]"]))
    if not isinstance(of, StructType) or (absent := [k for k in node if k not in of.names]):
        raise ValueError(f"no such fields: {absent if isinstance(of, StructType) else list(node)}")
    return F.when(value.isNotNull(), F.struct(*[projected(value[k], of[k].dataType, inner).alias(k) for k, inner in node.items()]))


def project(records: DataFrame, key: str, record: str, paths: list[str]) -> DataFrame:
    """key and the record with the paths of the contract alone."""
    return records.select(key, projected(F.col(record), records.schema[record].dataType, tree(paths)).alias(record))


def split(records: DataFrame, key: str, record: str, classes: dict[str, list[str]]) -> dict[str, DataFrame]:
    """A table for each class of paths; an array that several classes read has all of its elements, in order, in each. Refused: a path in two classes."""
    tree([p for paths in classes.values() for p in paths])
    return {name: project(records, key, record, paths) for name, paths in classes.items()}


def united(a: Column, of_a: DataType, b: Column, of_b: DataType) -> Column:
    if isinstance(of_a, StructType) and isinstance(of_b, StructType):
        one = lambda k: united(a[k], of_a[k].dataType, b[k], of_b[k].dataType) if k in of_a.names and k in of_b.names else a[k] if k in of_a.names else b[k]
        names = [*of_a.names, *[k for k in of_b.names if k not in of_a.names]]
        return F.when(a.isNotNull() | b.isNotNull(), F.struct(*[one(k).alias(k) for k in names]))
    if isinstance(of_a, ArrayType) and isinstance(of_b, ArrayType):
        whole = lambda x, t: F.coalesce(x, F.array().cast(t))
        return F.when(a.isNotNull() | b.isNotNull(), F.zip_with(whole(a, of_a), whole(b, of_b), lambda x, y: united(x, of_a.elementType, y, of_b.elementType)))
    return F.coalesce(a, b)


def merge(parts: dict[str, DataFrame], key: str, record: str) -> DataFrame:
    """The records of a split put together again, arrays by position; a record that some class lacks has what the others hold."""

    def two(left: DataFrame, right: DataFrame) -> DataFrame:
        both = left.join(right.withColumnRenamed(record, "_other"), key, "full")
        return both.select(key, united(F.col(record), left.schema[record].dataType, F.col("_other"), right.schema[record].dataType).alias(record))

    return reduce(two, parts.values())


def _at(value: Column, way: list[str]) -> Column:
    if not way:
        return value
    return F.transform(value, lambda x: _at(x, way[1:])) if way[0] == "[]" else _at(value[way[0]], way[1:])


def losses(whole: DataFrame, merged: DataFrame, key: str, record: str, paths: list[str]) -> DataFrame:
    """(path, n_records, n_lost, example): records whose value at a path is not that of the whole, and the smallest such key."""
    both = whole.select(key, F.col(record).alias("_a")).join(merged.select(key, F.col(record).alias("_b")), key, "left")
    differs = [~_at(F.col("_a"), steps(p)).eqNullSafe(_at(F.col("_b"), steps(p))) for p in paths]
    one = both.agg(F.count("*").alias("n"), *[c for i, d in enumerate(differs) for c in (F.count_if(d).alias(f"n{i}"), F.min(F.when(d, F.col(key))).alias(f"k{i}"))])
    rows = F.array(*[F.struct(F.lit(p).alias("path"), F.col("n").alias("n_records"), F.col(f"n{i}").alias("n_lost"), F.col(f"k{i}").alias("example")) for i, p in enumerate(paths)])
    return one.select(F.inline(rows))


def _field(level: Column, name: str) -> Column:
    return F.transform(level, lambda x: F.try_variant_get(x, f"$['{name}']", "variant"))


def lack(record: Column, path: str) -> Column:
    """Why a VARIANT record fails a path, or null: 'no <key>' or '<key> is not a list'. A key may hold null or an empty list; each element of a
    list is held to what follows. What is wrong nearest to the record is told."""
    level, why = F.array(record), []
    way = steps(path)
    for i, step in enumerate(way):
        if step == "[]":
            lists = F.transform(level, lambda x: F.try_variant_get(x, "$", "array<variant>"))
            why.append(F.when(F.exists(lists, lambda x: x.isNull()), f"{way[i - 1]} is not a list"))
            level = F.flatten(lists)
        else:
            level = _field(level, step)
            why.append(F.when(F.exists(level, lambda x: x.isNull()), f"no {step}"))
    return F.coalesce(*why)


def presence(records: DataFrame, text: str, paths: list[str]) -> DataFrame:
    """(path, reason, n): how many JSON records fail a path and why, reason null for those that have it; one pass over the records.
    A record that is no JSON fails every path as 'not json'; what follows a first whole value is not looked at."""
    v = records.select(F.try_parse_json(text).alias("_v"))
    told = F.array(*[F.struct(F.lit(p).alias("path"), F.when(F.col("_v").isNull(), "not json").otherwise(lack(F.col("_v"), p)).alias("reason")) for p in paths])
    return v.select(F.inline(told)).groupBy("path", "reason").agg(F.count("*").alias("n"))


def _shape(node: dict) -> str:
    """The schema that reads what the tree keeps of a JSON text; values that no path looks into stay as they are."""
    if not node:
        return "variant"
    if "[]" in node:
        return f"array<{_shape(node['[]'])}>"
    return f"struct<{', '.join(f'{k}: {_shape(inner)}' for k, inner in node.items())}>"


def archived(texts: DataFrame, key: str, text: str, paths: list[str], ids: DataFrame) -> DataFrame:
    """(key, text) of the listed ids alone (a column named as the key): JSON records cut to the paths of a contract, in its order. A field that a record lacks
    stays away, one that holds null stays null, and extra columns go.

    Refused, with three examples: a null id, an id listed twice, one whose record is missing, no JSON object, or there several times."""
    listed = ids.groupBy(F.col(key)).agg(F.count("*").alias("_listed"))
    node = tree(paths)
    read = texts.select(key, F.when(F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT"), F.from_json(text, _shape(node))).alias("_r"))
    found = listed.join(read.withColumn("_has", F.lit(1)), key, "left")
    found = kept(found.withColumn("_n", F.count("*").over(Window.partitionBy(key))).select(key, F.to_json("_r").alias(text), "_listed", "_n", F.col("_has").isNotNull().alias("_found")), "archive")
    why = F.when(F.col(key).isNull(), "is null").when(F.col("_listed") > 1, "is listed twice").when(~F.col("_found"), "has no record").when(F.col(text).isNull(), "has no readable record").when(F.col("_n") > 1, "has several records")
    if bad := found.select(key, why.alias("why")).filter("why is not null").limit(3).collect():
        raise ValueError("; ".join(f"{r[key]} {r['why']}" for r in bad))
    return found.select(key, text)


def dropped(source: DataFrame, archive: DataFrame, key: str, text: str, paths: list[str]) -> DataFrame:
    """(path, n_records, n_dropped, example): what an archive lacks although its source record has it, and the smallest such key. What
    the source lacks too is no loss. Records of the archive alone are compared; a source that is no JSON has nothing to lose."""
    both = archive.select(key, F.try_parse_json(text).alias("_b")).join(source.select(key, F.try_parse_json(text).alias("_a")), key)
    gone = [F.col("_a").isNotNull() & lack(F.col("_a"), p).isNull() & (F.col("_b").isNull() | lack(F.col("_b"), p).isNotNull()) for p in paths]
    one = both.agg(F.count("*").alias("n"), *[c for i, d in enumerate(gone) for c in (F.count_if(d).alias(f"n{i}"), F.min(F.when(d, F.col(key))).alias(f"k{i}"))])
    rows = F.array(*[F.struct(F.lit(p).alias("path"), F.col("n").alias("n_records"), F.col(f"n{i}").alias("n_dropped"), F.col(f"k{i}").alias("example")) for i, p in enumerate(paths)])
    return one.select(F.inline(rows))
