"""Joins with checks: one to one, containment, lookups with defaults, ordered gathers, enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.functions.keys import present


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def one_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """A join that raises ValueError if a key occurs twice on either side."""
    for name, df in (("left", left), ("right", right)):
        bad = duplicates(df, keys).first()
        if bad is not None:
            raise ValueError(f"{name} side has repeated keys, such as {bad.asDict()}")
    return left.join(right, list(keys), how)


def lookup(df: DataFrame, dim: DataFrame, key: str, value: str, default: object, name: str | None = None) -> DataFrame:
    """Adds a looked-up value, or the default where the key is missing or unknown. dim has one row per key."""
    d = dim.select(F.col(key), F.col(value).alias("_v"))
    return df.join(d, key, "left").withColumn(name or value, F.coalesce("_v", F.lit(default))).drop("_v")


def known(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key), key, "left_semi")


def unknown(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among the ids; a null key is not (unlike NOT IN)."""
    return df.join(ids.select(key), key, "left_anti")


def require_subset(part: DataFrame, whole: DataFrame, key: str) -> None:
    """Raises ValueError if some key of `part` is not in `whole`."""
    bad = part.join(whole.select(key), key, "left_anti").first()
    if bad is not None:
        raise ValueError(f"{key} {bad[key]!r} is not in the frame")


def gather(ids: Sequence, store: DataFrame, key: str, strict: bool = False) -> DataFrame:
    """Store rows in the order of a list of ids, with pos and found; ids the store lacks have found = false.

    With strict, ids that the store lacks or holds more than once raise ValueError.
    """
    spark = store.sparkSession
    want = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], f"pos int, {key} {dict(store.dtypes)[key]}")
    if strict:
        held = store.join(F.broadcast(want.select(key).distinct()), key).groupBy(key).count().collect()  # a row per id asked for
        if len(held) != len(set(ids)) or any(r["count"] != 1 for r in held):
            raise ValueError(f"{len(set(ids))} ids are asked for, {len(held)} are stored, {sum(r['count'] > 1 for r in held)} of them more than once")
    return want.join(store.withColumn("found", F.lit(True)), key, "left").withColumn("found", F.coalesce("found", F.lit(False))).orderBy("pos")


def by_definition(df: DataFrame, definition: DataFrame, key: str, flag: str, yes: str = "1") -> tuple[DataFrame, DataFrame]:
    """(kept, dropped): rows whose definition says yes, and all others, without the definition's columns.

    Columns of the table that the definition has too are taken for leftovers of an earlier run and left out. definition has one row per key.
    """
    plain = df.drop(*[c for c in definition.columns if c != key and c in df.columns])
    joined = plain.join(definition.select(key, F.trim(F.col(flag).cast("string")).alias("_flag")), key, "left")
    good = F.coalesce(F.col("_flag") == yes, F.lit(False))
    return joined.where(good).drop("_flag"), joined.where(~good).drop("_flag")


def enrich(target: DataFrame, reference: DataFrame, key: str, column: str, rule: Column) -> DataFrame:
    """Adds column and label_source: the reference's value wins, then the rule's, else yt_only."""
    r = reference.select(key, present(column).alias("_ref"))
    return target.join(r, key, "left").withColumn(column, F.coalesce("_ref", rule)).withColumn("label_source", F.when(F.col("_ref").isNotNull(), "ref_join").when(rule.isNotNull(), "title_rule").otherwise("yt_only")).drop("_ref")


def conflicts(a: DataFrame, b: DataFrame, key: str, column: str) -> DataFrame:
    """(key, a_value, b_value): keys for which two sources disagree, both being present."""
    return a.select(key, F.col(column).alias("a_value")).join(b.select(key, F.col(column).alias("b_value")), key).where("a_value <> b_value")


def side_merge(main: DataFrame, side: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Main rows with the side file's present values in the named columns; side has one row per key."""
    s = side.select(key, *(present(c).alias(f"_{c}") for c in columns))
    return main.join(s, key, "left").select(*(F.coalesce(f"_{c}", c).alias(c) if c in columns else F.col(c) for c in main.columns))


def union_tagged(tables: Sequence[tuple[str, DataFrame]], tag: str = "source_name") -> DataFrame:
    """All rows with the table's name; columns are matched by name, absent ones are null."""
    if not tables:
        raise ValueError("no table")
    out = None
    for name, df in tables:
        one = df.withColumn(tag, F.lit(name))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out
