"""Rejection tags: normalisation against a registry, proposals, conflicts, and trust metrics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.functions.scoring import confidence_band


def aliases(registry: DataFrame) -> DataFrame:
    """(alias, canonical): ids, labels and aliases of the registry; deprecated ids lead to what they map to.

    registry has id, label_zh, status, aliases array<string>, maps_to; of two entries for an alias the smaller id wins.
    """
    target = F.when((F.col("status") == "deprecated") & F.col("maps_to").isNotNull(), F.col("maps_to")).otherwise(F.col("id"))
    names = F.array_compact(F.concat(F.array("id", "label_zh"), F.coalesce("aliases", F.array().cast("array<string>"))))
    flat = registry.select("id", target.alias("canonical"), F.explode(names).alias("alias"))
    return flat.groupBy(F.lower(F.trim("alias")).alias("alias")).agg(F.min(F.struct("id", "canonical"))["canonical"].alias("canonical"))


def normalise(df: DataFrame, key: str, tags: str, registry: DataFrame, unknown: str = "provisional:") -> DataFrame:
    """(key, pos, raw, tag): each tag of a comma- or bar-separated list, in its order, in canonical form.

    Unknown tags get the prefix; with an empty prefix they are left out. Repeated canonical tags keep their first place.
    """
    flat = df.select(key, F.posexplode(F.split(F.coalesce(tags, F.lit("")), r"[,|]")).alias("pos", "raw")).withColumn("raw", F.trim("raw")).where("raw <> ''")
    other = F.when(F.col("raw").startswith(unknown), F.col("raw")).otherwise(F.concat(F.lit(unknown), "raw")) if unknown else F.lit(None).cast("string")
    named = flat.withColumn("alias", F.lower("raw")).join(aliases(registry), "alias", "left").withColumn("tag", F.coalesce("canonical", other)).where("tag is not null")
    return named.groupBy(key, "tag").agg(F.min(F.struct("pos", "raw")).alias("x")).select(key, "x.pos", "x.raw", "tag")


def picture_tag(verdict: Column | str, evidence: Column | str, words: Mapping[str, str], other: str = "provisional:thumb_fail") -> Column:
    """The tag of a rejected picture: the first word that its evidence holds names one, else `other`; null unless rejected."""
    v, e = (F.col(c) if isinstance(c, str) else c for c in (verdict, evidence))
    tag = F.lit(other)
    for word, name in reversed(words.items()):
        tag = F.when(F.lower(F.coalesce(e, F.lit(""))).contains(word), name).otherwise(tag)
    return F.when(F.upper(F.trim(v)) == "F", tag)


def propose(dropped: DataFrame, key: str, tag: Column, score: Column, modality: str, source: str) -> DataFrame:
    """Proposals from dropped rows: key, reject_tag, modality, propose_source, confidence_band."""
    return dropped.where(tag.isNotNull()).select(key, tag.alias("reject_tag"), F.lit(modality).alias("modality"), F.lit(source).alias("propose_source"), confidence_band(score).alias("confidence_band"))


def merge_proposals(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """One proposal per (key, tag, modality, source); the older one stays."""
    cols = [key, "reject_tag", "modality", "propose_source"]
    both = old.withColumn("_age", F.lit(0)).unionByName(new.withColumn("_age", F.lit(1)), allowMissingColumns=True)
    rest = [c for c in both.columns if c not in cols and c != "_age"]
    return both.groupBy(*cols).agg(F.min(F.struct("_age", *rest)).alias("_r")).select(*cols, *(F.col(f"_r.{c}").alias(c) for c in rest))


def metrics(proposed: DataFrame, validated: DataFrame, min_validated: int = 30, max_overturn: float = 0.35) -> DataFrame:
    """Per (reject_tag, modality, propose_source): proposals, validations, precision proxy, overturn rate and trust.

    validated has the same keys and reject_action (confirm, correct, overturn). Ratios are null without validations.
    """
    keys = ["reject_tag", "modality", "propose_source"]
    p = proposed.groupBy(*keys).agg(F.count("*").alias("n_proposed"))
    act = F.col("reject_action")
    v = validated.groupBy(*keys).agg(F.count("*").alias("n_validated"), F.count(F.when(act == "confirm", 1)).alias("n_confirm"), F.count(F.when(act == "correct", 1)).alias("n_correct"), F.count(F.when(act == "overturn", 1)).alias("n_overturn"))
    m = p.join(v, keys, "full").fillna(0, ["n_proposed", "n_validated", "n_confirm", "n_correct", "n_overturn"])
    some = F.col("n_validated") > 0
    m = m.withColumn("precision_proxy", F.when(some, (F.col("n_confirm") + F.col("n_correct")) / F.greatest("n_validated", F.lit(1)))).withColumn("overturn_rate", F.when(some, F.col("n_overturn") / F.greatest("n_validated", F.lit(1))))
    trust = F.when(F.col("n_validated") < min_validated, "untrusted").when(F.col("overturn_rate") > max_overturn, "untrusted").otherwise("trusted")
    advice = F.when(F.col("n_validated") < min_validated, "collect_more_validation").when(F.col("overturn_rate") > max_overturn, "review_rule").otherwise("keep")
    return m.withColumn("trust_status", trust).withColumn("suggestion", advice)


def totals(proposed: DataFrame, validated: DataFrame) -> DataFrame:
    """One row: counts, tags, and the sorted tags that have proposals but no validation."""
    v = validated.select("reject_tag").distinct().withColumn("_v", F.lit(1))
    per = proposed.groupBy("reject_tag").agg(F.count("*").alias("n")).join(v, "reject_tag", "left")
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_proposed"), F.count("*").alias("n_tags"), F.array_sort(F.collect_set(F.when(F.col("_v").isNull(), F.col("reject_tag")))).alias("tags_with_prop_no_val"))


def modality_counts(proposed: DataFrame) -> DataFrame:
    """(reject_tag, n, by_modality map): counts first, one small map per tag after."""
    c = proposed.groupBy("reject_tag", "modality").agg(F.count("*").alias("n"))
    return c.groupBy("reject_tag").agg(F.sum("n").alias("n"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("modality", "n")))).alias("by_modality"))


def boundary(samples: DataFrame, order: str, hits: str, consecutive: int = 2) -> DataFrame:
    """One row: whether the last `consecutive` samples all had no hit (n is how many there were)."""
    last = samples.orderBy(F.desc(order)).limit(consecutive)
    return last.agg(F.count("*").alias("n"), F.coalesce(F.sum(hits), F.lit(0)).alias("hits")).select("n", ((F.col("n") == consecutive) & (F.col("hits") == 0)).alias("boundary"))
