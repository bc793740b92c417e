"""Reproducible samples: an order by hash of (seed, id) stands for a random order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.functions.keys import group_id
from siftline.operators.prefix import quantiles


def lot(seed: int | str, key: str) -> Column:
    """The place of a row in the seeded order."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def hash_sample(df: DataFrame, n: int, seed: int | str, key: str) -> DataFrame:
    """n rows, or all; a top-n, not a sort."""
    return df.withColumn("_lot", lot(seed, key)).orderBy("_lot", key).limit(n).drop("_lot")


def sample_per_group(df: DataFrame, group: str, sizes: Mapping[str, int] | int, seed: int | str, key: str) -> DataFrame:
    """Up to n rows of each group, or of each listed group its own number."""
    w = Window.partitionBy(group).orderBy(lot(seed, key), key)
    ranked = df.withColumn("_n", F.row_number().over(w))
    if isinstance(sizes, int):
        return ranked.where(F.col("_n") <= sizes).drop("_n")
    limit = None
    for g, n in sizes.items():
        limit = F.when(F.col(group) == g, n) if limit is None else limit.when(F.col(group) == g, n)
    return ranked.where(F.col("_n") <= limit.otherwise(0)).drop("_n")


def balanced_sample(df: DataFrame, label: str, classes: Sequence[str], most: int, seed: int | str, key: str) -> DataFrame:
    """The same number of every class: the smallest class, or most / classes."""
    counts = {r[0]: r[1] for r in df.where(F.col(label).isin(*classes)).groupBy(label).count().collect()}
    n = min([most // len(classes), *(counts.get(c, 0) for c in classes)])
    return sample_per_group(df.where(F.col(label).isin(*classes)), label, n, seed, key)


def quantile_bands(df: DataFrame, value: str, cuts: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Adds band: from the highest quantile cut down, value >= quantile; cuts fall, and names has one more entry."""
    q = quantiles(df, value, cuts).agg(F.reverse(F.array_sort(F.collect_list("value"))).alias("q"))
    case = None
    for i, name in enumerate(names[:-1]):
        hit = F.col(value) >= F.col("q")[i]
        case = F.when(hit, name) if case is None else case.when(hit, name)
    return df.crossJoin(F.broadcast(q)).withColumn("band", F.when(F.col(value).isNotNull(), case.otherwise(names[-1]))).drop("q")  # one row


def spread_sample(df: DataFrame, n: int, seed: int | str, key: str, spread: str, value: str, strata: int = 5, exclude: DataFrame | None = None, on: str | None = None) -> DataFrame:
    """n rows with `spread` unique, drawn in turn from equal strata of `value`; adds sample_stratum.

    Strata are cut at exact quantiles. Rows with a null spread or value take no part, nor do rows whose `on` (by default
    the key) is in the table `exclude`, such as rows that have a label.
    """
    if exclude is not None:
        df = df.join(exclude.select(on or key).distinct(), on or key, "left_anti")
    cuts = [i / strata for i in range(strata - 1, 0, -1)]
    d = quantile_bands(df.where(F.col(value).isNotNull() & F.col(spread).isNotNull()), value, cuts, [str(strata - i) for i in range(strata)])
    one = d.withColumn("_n", F.row_number().over(Window.partitionBy(spread).orderBy(lot(seed, key), key))).where("_n = 1")
    turn = one.withColumn("_n", F.row_number().over(Window.partitionBy("band").orderBy(lot(seed, key), key)))
    return turn.orderBy("_n", "band").limit(n).withColumnRenamed("band", "sample_stratum").drop("_n")


def active_routes(df: DataFrame, score: str, action: str, sizes: Mapping[str, int], seed: int | str, key: str, vector: str | None = None) -> DataFrame:
    """Rows for review by route: boundary (score nearest 0.5), diverse_keep, drop_overturn; no row in two routes.

    diverse_keep picks kept rows far apart: k-center on the vectors of at most 20 times as many rows drawn by hash,
    or the hash order alone where there is no vector.
    """
    boundary = df.where(F.col(score).isNotNull()).withColumn("_d", F.abs(F.col(score) - 0.5)).orderBy("_d", key).limit(sizes.get("boundary", 0)).drop("_d").withColumn("route", F.lit("boundary"))
    rest = df.join(boundary.select(key), key, "left_anti")
    kept = rest.where(F.col(action) == "keep_candidate")
    k = sizes.get("diverse_keep", 0)
    if vector is None:
        diverse = hash_sample(kept, k, seed, key)
    else:
        pool = hash_sample(kept.where(F.col(vector).isNotNull()), 20 * max(k, 1), seed, key)
        diverse = kept.join(F.broadcast(k_center(pool, key, vector, k)), key, "left_semi")  # of at most 20 k rows
    dropped = hash_sample(rest.where(F.col(action) == "drop"), sizes.get("drop_overturn", 0), seed, key)
    return boundary.unionByName(diverse.withColumn("route", F.lit("diverse_keep"))).unionByName(dropped.withColumn("route", F.lit("drop_overturn")))


def k_center(pool: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """(key): k rows far apart, each the farthest from those before, the smallest key first. The pool is one task: bound it before."""
    kind = dict(pool.dtypes)[key]
    return pool.where(F.col(vector).isNotNull()).select(key, vector).groupBy(F.lit(0).alias("one")).applyInPandas(_k_center(key, vector, k), f"{key} {kind}")


def _k_center(key: str, vector: str, k: int):
    def pick(pool):
        import numpy as np

        pool = pool.sort_values(key)
        x = np.stack(pool[vector].to_numpy()).astype(np.float64)
        chosen = [0]
        far = ((x - x[0]) ** 2).sum(1)
        while len(chosen) < min(k, len(x)):
            chosen.append(int(far.argmax()))
            far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(1))
        return pool.iloc[chosen[:k]][[key]]

    return pick


def fold(key: str, label: str, k: int, seed: int | str) -> Column:
    """Stratified fold of a row: its rank in the seeded order of a part of its class, modulo k.

    Classes are ranked in 64 parts by hash, each starting at another fold, so that no class is one task.
    """
    part = F.pmod(F.xxhash64(F.lit(str(seed)), F.col(key)), F.lit(64))
    return ((F.row_number().over(Window.partitionBy(label, part).orderBy(lot(seed, key), key)) + part) % k).cast("int")


def hold_out(df: DataFrame, key: str, label: str, share: float, seed: int | str) -> DataFrame:
    """Adds held: true for a share of each class, by the seeded order, to within a row in each of 64 parts of a class."""
    part = F.pmod(F.xxhash64(F.lit(str(seed)), F.col(key)), F.lit(64))
    r = F.row_number().over(Window.partitionBy(label, part).orderBy(lot(seed, key), key)) + part / 64.0
    return df.withColumn("held", F.floor(r * share) > F.floor((r - 1) * share))


def labelled_split(df: DataFrame, groups: Sequence[Column | str], key: str, shares: Mapping[str, float], seed: int | str, conflicts: DataFrame | None = None) -> DataFrame:
    """Adds label_group and split: whole groups go to one split, rows whose key is in `conflicts` to review.

    The group is the first present of several columns; a row without any is a group of its own.
    """
    own = F.concat(F.lit("row "), F.col(key).cast("string"))
    out = df.withColumn("label_group", F.coalesce(group_id(*groups), own))
    split = group_split(F.col("label_group"), shares, seed)
    if conflicts is None:
        return out.withColumn("split", split)
    bad = conflicts.select(key).distinct().withColumn("_bad", F.lit(True))
    return out.join(bad, key, "left").withColumn("split", F.when(F.col("_bad"), "review").otherwise(split)).drop("_bad")


def group_split(group: Column, shares: Mapping[str, float], seed: int | str) -> Column:
    """The split of a whole group, from a hash of it: rows of one group never part."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), group)), 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))
    total, bound, case = sum(shares.values()), 0.0, None
    names = list(shares)
    for name in names[:-1]:
        bound += shares[name] / total
        case = F.when(h < bound, name) if case is None else case.when(h < bound, name)
    return F.lit(names[-1]) if case is None else case.otherwise(names[-1])
