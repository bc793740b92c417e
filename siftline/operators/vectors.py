"""Operators on embedding vectors (array<float>): prototypes, margins, decisions, nearest neighbours.

Few prototypes travel as literals inside one expression, so that scoring is a projection of the scan. Against a
large bank, blocks of vectors are multiplied in numpy, and each row keeps only its best matches.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_LITERALS = 64  # prototypes that are written into an expression


def dot(a: Column, b: Column) -> Column:
    """Inner product in double; null for a null vector."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def vector_literal(v: Sequence[float]) -> Column:
    return F.array(*(F.lit(float(x)) for x in v))


def centroids(df: DataFrame, group: str, vector: str, size: int) -> DataFrame:
    """(group, centroid array<double>): element-wise means, as one aggregation without exploding."""
    means = F.array(*(F.avg(F.col(vector)[i].cast("double")) for i in range(size)))
    return df.where(F.col(vector).isNotNull()).groupBy(group).agg(means.alias("centroid"))


def cosine(a: Column, b: Column) -> Column:
    n = norm(a) * norm(b)
    return F.when(n > 0, dot(a, b) / n)


def margins(df: DataFrame, vector: str, pairs: Mapping[str, tuple[Sequence[float], Sequence[float]]]) -> DataFrame:
    """Adds one column per question: cosine to the positive minus cosine to the negative prototype."""
    if len(pairs) * 2 > MAX_LITERALS:
        raise ValueError("too many prototypes for literals; use nearest()")
    v = F.col(vector)
    return df.withColumns({q: cosine(v, vector_literal(a)) - cosine(v, vector_literal(b)) for q, (a, b) in pairs.items()})


def decide(df: DataFrame, thresholds: Mapping[str, float], require: Sequence[str], ok: str | None = None, names: tuple[str, str, str] = ("clip_pass", "clip_fail", "no_thumb")) -> DataFrame:
    """Adds clip_decision: pass if all required margins reach their thresholds; no picture is a state of its own, never a fail."""
    good = F.lit(True)
    for q in require:
        good = good & (F.col(q) >= F.lit(float(thresholds.get(q, 0.0))))
    state = F.when(F.coalesce(good, F.lit(False)), names[0]).otherwise(names[1])
    return df.withColumn("clip_decision", state if ok is None else F.when(F.coalesce(F.col(ok), F.lit(False)), state).otherwise(names[2]))


def tiers(score: Column, high: float, mid: float) -> Column:
    return F.when(score >= high, "high").when(score >= mid, "mid").when(score.isNotNull(), "low")


def max_similarity(vector: Column, prototypes: Sequence[Sequence[float]]) -> Column:
    """Largest inner product with a few prototypes."""
    if not prototypes or len(prototypes) > MAX_LITERALS:
        raise ValueError("needs between one and MAX_LITERALS prototypes")
    sims = [dot(vector, vector_literal(p)) for p in prototypes]
    return sims[0] if len(sims) == 1 else F.greatest(*sims)


def _top(ids: np.ndarray, bank: np.ndarray, groups: np.ndarray, k: int, per_group: bool, skip_self: bool):
    def top(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        labels = np.unique(groups)
        for b in batches:
            out = []
            for at in range(0, len(b), 1024):
                part = b.iloc[at : at + 1024]
                x = np.stack(part["vector"].to_numpy()).astype(np.float64)
                sim = x @ bank.T
                own = part["id"].to_numpy()
                if skip_self:
                    sim[own[:, None] == ids[None, :]] = -np.inf
                for g in labels if per_group else [None]:
                    cols = np.flatnonzero(groups == g) if per_group else np.arange(len(ids))
                    s = sim[:, cols]
                    # Ties go to the smaller id: bank rows are sorted by id.
                    order = np.argsort(-np.round(s, 12), axis=1, kind="stable")[:, :k]
                    for r in range(order.shape[1]):
                        c = order[:, r]
                        v = s[np.arange(len(part)), c]
                        good = np.isfinite(v)
                        out.append(pd.DataFrame({"id": own[good], "rank": r + 1, "match_id": ids[cols[c]][good], "match_group": groups[cols[c]][good], "similarity": v[good]}))
            if out:
                yield pd.concat(out)

    return top


def _block_top(k: int, per_group: bool, skip_self: bool):
    def top(query: pd.DataFrame, bank: pd.DataFrame) -> pd.DataFrame:
        columns = ["id", "rank", "match_id", "match_group", "similarity"]
        if not len(query) or not len(bank):
            return pd.DataFrame({c: [] for c in columns})
        bank = bank.sort_values("bank_id")
        x = np.stack(bank["bank_vector"].to_numpy()).astype(np.float64)
        got = list(_top(bank["bank_id"].to_numpy(), x, bank["bank_group"].to_numpy(), k, per_group, skip_self)(iter([query])))
        return pd.concat(got)[columns] if got else pd.DataFrame({c: [] for c in columns})

    return top


def nearest(df: DataFrame, bank: DataFrame, k: int = 1, per_group: bool = False, skip_self: bool = False, block: int = 20_000) -> DataFrame:
    """(id, rank, match_id, match_group, similarity): each row's k nearest bank rows, in all or per bank group.

    df has id and vector, bank has id, vector and group. A bank of at most `block` rows is broadcast. A larger one is cut
    into blocks of that size by hash, and so are the rows: each pair of blocks is a task, and a row's best matches of all blocks are
    merged, so that neither side passes the driver or need fit in one task. Null vectors match nothing.
    Ties go to the smaller bank id. An empty bank gives an empty result.
    """
    spark = df.sparkSession
    rows = bank.where("vector is not null").select(F.col("id").cast("bigint").alias("id"), "vector", F.col("group").cast("string").alias("group"))
    count = rows.count()
    schema = "id bigint, rank int, match_id bigint, match_group string, similarity double"
    if not count:
        return spark.createDataFrame([], schema)
    query = df.where("vector is not null").select(F.col("id").cast("bigint").alias("id"), "vector")
    if count <= block:
        got = rows.toPandas().sort_values("id")
        return query.mapInPandas(_top(got["id"].to_numpy(), np.stack(got["vector"].to_numpy()).astype(np.float64), got["group"].to_numpy(), k, per_group, skip_self), schema)
    blocks, chunks = -(-count // block), max(1, -(-query.count() // block))
    q = query.withColumn("c", F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int")).withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    r = rows.select(F.col("id").alias("bank_id"), F.col("vector").alias("bank_vector"), F.col("group").alias("bank_group"))
    r = r.withColumn("b", F.pmod(F.xxhash64("bank_id"), F.lit(blocks)).cast("int")).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    found = q.groupBy("c", "b").cogroup(r.select(F.col("c").alias("bank_c"), F.col("b").alias("bank_b"), "bank_id", "bank_vector", "bank_group").groupBy("bank_c", "bank_b")).applyInPandas(_block_top(k, per_group, skip_self), schema)
    w = Window.partitionBy(*(["id", "match_group"] if per_group else ["id"])).orderBy(F.desc(F.round("similarity", 12)), "match_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def prototype_scores(df: DataFrame, key: str, vector: str, keep: Column, drop: Column, most: int = 20, tau: float = 0.08) -> DataFrame:
    """(key, sim_keep, sim_drop, score): rows scored by their nearest picks, up to `most` rows that satisfy `keep` and as many `drop`.

    Picks are taken by key; a row that satisfies both is a keep. ValueError if a side has none. Null vectors have null scores.
    """
    from siftline.functions.scoring import contrast

    have = df.where(F.col(vector).isNotNull())
    sides = [[r[0] for r in have.where(rule).orderBy(key).limit(most).select(vector).collect()] for rule in (keep, drop & ~keep)]  # `most` rows
    if not all(sides):
        raise ValueError("each side needs a pick")
    sims = df.select(key, max_similarity(F.col(vector), sides[0]).alias("sim_keep"), max_similarity(F.col(vector), sides[1]).alias("sim_drop"))
    return sims.withColumn("score", contrast("sim_keep", "sim_drop", tau))


def loo_contrast(nearest_per_group: DataFrame, keep: str, drop: str, tau: float = 0.08) -> DataFrame:
    """(id, sim_keep, sim_drop, score) from the best match per group, own row left out by `nearest(skip_self=True)`."""
    from siftline.functions.scoring import contrast

    best = nearest_per_group.where("rank = 1").groupBy("id").agg(F.max(F.when(F.col("match_group") == keep, F.col("similarity"))).alias("sim_keep"), F.max(F.when(F.col("match_group") == drop, F.col("similarity"))).alias("sim_drop"))
    return best.withColumn("score", contrast("sim_keep", "sim_drop", tau))


def fingerprint(df: DataFrame, id_col: str) -> DataFrame:
    """(rows, ids_key): the number of ids and a key of their set that does not depend on order or partitioning."""
    h = F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 15), 16, 10).cast("bigint")
    return df.agg(F.count(id_col).alias("rows"), F.bit_xor(h).alias("ids_key"))


def missing_ids(wanted: DataFrame, store: DataFrame, key: str) -> DataFrame:
    """Keys of `wanted` that the store lacks: what an incremental run has to compute."""
    return wanted.select(key).where(F.col(key).isNotNull()).distinct().join(store.select(key), key, "left_anti")
