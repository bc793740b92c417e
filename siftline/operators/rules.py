"""Keep and drop rules: compiled patterns, ordered attribution, hit counts and pattern scores.

Rules are data (name, field, patterns); a section's patterns become one alternation, so that a filter costs one
match per section, and attribution is one ordered CASE. Fields are matched in lower case.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.functions.text import filled

NEVER = r"[^\s\S]"


@dataclass(frozen=True)
class Section:
    """One step of a cleaner. exact: the field equals one of the patterns, as text."""

    name: str
    field: str
    patterns: Sequence[str]
    exact: bool = False
    category: str = ""

    def predicate(self) -> Column:
        if not self.patterns:
            return F.lit(False)
        low = F.lower(filled(self.field))
        if self.exact:
            return F.trim(low).isin(*(p.lower() for p in self.patterns))
        return low.rlike("|".join(f"(?:{p})" for p in self.patterns))


def check_patterns(patterns: Sequence[str]) -> None:
    """Raises RuntimeError that names the first pattern that does not compile."""
    for p in patterns:
        try:
            re.compile(re.sub(r"\\p\{[A-Z][a-z]?\}", "x", p))
        except re.error as e:
            raise RuntimeError(f"bad pattern {p!r}: {e}") from e


def order_by_hits(patterns: Sequence[str], hits: Mapping[str, int]) -> list[str]:
    """Most-hit first; patterns without a count keep their order behind."""
    return sorted(patterns, key=lambda p: -hits.get(p, 0))


def alternation(patterns: Sequence[str]) -> str:
    """One pattern for all; an empty section matches nothing."""
    return "|".join(f"(?:{p})" for p in patterns) if patterns else NEVER


def attribute(df: DataFrame, sections: Sequence[Section]) -> DataFrame:
    """Adds decision (keep or drop), drop_step and drop_category: the first section that matches."""
    check_patterns([p for s in sections if not s.exact for p in s.patterns])
    step = category = None
    for s in sections:
        hit = s.predicate()
        step = F.when(hit, s.name) if step is None else step.when(hit, s.name)
        category = F.when(hit, s.category or s.name) if category is None else category.when(hit, s.category or s.name)
    none = F.lit(None).cast("string")
    out = df.withColumn("drop_step", none if step is None else step).withColumn("drop_category", none if category is None else category)
    return out.withColumn("decision", F.when(F.col("drop_step").isNull(), "keep").otherwise("drop"))


def summary(attributed: DataFrame) -> DataFrame:
    """Rows per step (null: kept), and their share of all rows in per cent."""
    n = attributed.groupBy("decision", "drop_step").agg(F.count("*").alias("n"))
    total = attributed.agg(F.count("*").alias("total"))  # one row
    return n.crossJoin(F.broadcast(total)).select("decision", "drop_step", "n", F.round(F.col("n") * 100.0 / F.greatest("total", F.lit(1)), 1).alias("pct"))


def hit_counts(df: DataFrame, field: str, patterns: Sequence[str]) -> DataFrame:
    """(pattern, hits) in one pass over the table."""
    check_patterns(patterns)
    low = F.lower(filled(field))
    one = df.agg(*(F.count(F.when(low.rlike(p), 1)).alias(f"h{i}") for i, p in enumerate(patterns)))
    pairs = F.array(*(F.struct(F.lit(p).alias("pattern"), F.col(f"h{i}").alias("hits")) for i, p in enumerate(patterns)))
    return one.select(F.inline(pairs))


def pattern_scores(df: DataFrame, field: str, label: str, patterns: Sequence[str], min_f: int = 3) -> DataFrame:
    """(pattern, n_f, n_t, n_u, addable): hits by label; addable with enough F and neither T nor U."""
    low = F.lower(filled(field))
    aggs = [F.count(F.when(low.rlike(p) & (F.col(label) == k), 1)).alias(f"{k}{i}") for i, p in enumerate(patterns) for k in ("F", "T", "U")]
    one = df.agg(*aggs)
    rows = F.array(*(F.struct(F.lit(p).alias("pattern"), F.col(f"F{i}").alias("n_f"), F.col(f"T{i}").alias("n_t"), F.col(f"U{i}").alias("n_u")) for i, p in enumerate(patterns)))
    out = one.select(F.inline(rows))
    return out.withColumn("addable", (F.col("n_f") >= min_f) & (F.col("n_t") == 0) & (F.col("n_u") == 0))


def mine_ngrams(df: DataFrame, field: str, label: str, n: int = 2, min_f: int = 3) -> DataFrame:
    """(ngram, n_f): word n-grams of F rows that no T or U row has, with the number of F rows that do."""
    words = F.filter(F.split(F.lower(filled(field)), r"[^\p{L}\p{N}_]+"), lambda w: w != "")
    grams = F.when(F.size("w") >= n, F.array_distinct(F.transform(F.sequence(F.lit(0), F.size("w") - n), lambda i: F.array_join(F.slice("w", i + 1, n), " "))))
    flat = df.where(F.col(label).isin("F", "T", "U")).withColumn("w", words).select(label, F.explode(grams).alias("ngram"))
    counts = flat.groupBy("ngram").agg(F.count(F.when(F.col(label) == "F", 1)).alias("n_f"), F.count(F.when(F.col(label) != "F", 1)).alias("n_other"))
    return counts.where((F.col("n_f") >= min_f) & (F.col("n_other") == 0)).select("ngram", "n_f")


def route(df: DataFrame, noise: Mapping[str, str], industries: Mapping[str, str], field: str = "title") -> DataFrame:
    """Adds stage (l1_drop, candidate, unrouted), drop_category, industries and industry_primary.

    Certain noise comes first; then all matching industries are listed in the mapping's order, the first is primary.
    """
    low = F.lower(filled(field))
    drop = None
    for name, p in noise.items():
        drop = F.when(low.rlike(p), name) if drop is None else drop.when(low.rlike(p), name)
    drop = F.lit(None).cast("string") if drop is None else drop
    found = F.array_compact(F.array(*(F.when(low.rlike(p), name) for name, p in industries.items())))
    out = df.withColumn("drop_category", drop).withColumn("industries", F.when(F.col("drop_category").isNull(), found).otherwise(F.array().cast("array<string>")))
    out = out.withColumn("industry_primary", F.try_element_at("industries", F.lit(1)))
    return out.withColumn("stage", F.when(F.col("drop_category").isNotNull(), "l1_drop").when(F.size("industries") > 0, "candidate").otherwise("unrouted"))


def rescued(field: str, keep: Sequence[str], rescue: Sequence[str], block: Sequence[str]) -> Column:
    """Whether a text holds a keep pattern and a rescue pattern and no blocking one, so that no threshold may drop it."""
    low = F.lower(filled(field))
    return low.rlike(alternation(keep)) & low.rlike(alternation(rescue)) & ~low.rlike(alternation(block))


def classify(text: Column, classes: Mapping[str, str], source: str = "title_rule") -> tuple[Column, Column]:
    """(class, source): the first class whose pattern the lower-cased text holds, and where it came from; null and empty if none."""
    out = first_match([(name, F.lower(filled(text)).rlike(p)) for name, p in classes.items()], "")
    return F.nullif(out, F.lit("")), F.when(out != "", source).otherwise("")


def first_match(cases: Sequence[tuple[str, Column]], default: str) -> Column:
    """The name of the first condition that holds."""
    out = None
    for name, c in cases:
        out = F.when(c, name) if out is None else out.when(c, name)
    return F.lit(default) if out is None else out.otherwise(default)


def prefilter_reason(duration: Column, channel: Column, title: Column, blocked: Sequence[str], shortest: int, longest: int, words: Sequence[str]) -> Column:
    """Why a row is passed over before any costly step, or null."""
    case = F.when(F.lower(F.trim(channel)).isin(*(b.lower() for b in blocked)), F.lit("l0:channel_blacklist"))
    case = case.when(duration < shortest, F.concat(F.lit("l0:too_short:"), duration.cast("bigint").cast("string"), F.lit("s")))
    case = case.when(duration > longest, F.concat(F.lit("l0:too_long:"), duration.cast("bigint").cast("string"), F.lit("s")))
    for w in words:
        case = case.when(F.lower(filled(title)).contains(w), F.lit(f"l0:title:{w}"))
    return case
