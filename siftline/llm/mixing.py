"""Problem 9: mixing sources to target shares of all tokens, by Pareto order sampling.

Each distinct text counts once, with the tokens that a public tokenizer gives it. The mix is as large as
the scarcest source allows at its cap of repeats. A source's quota is met by whole copies of all its texts
and a sample for the rest: with inclusion probabilities L proportional to the sampling weight (tokens by
default, capped at 1) and a uniform U per text, texts are ranked by (U / (1 - U)) / (L / (1 - L)), and the
first ones are taken up to the tokens that are due, to the nearest text. U is a hash of the text, so the result is repeatable.

Ranking is distributed: rows are sorted by range over (source, rank), tokens are summed per partition, and
only the partition in which a source's quota ends is looked into row by row.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftline.functions.keys import present, strip
from siftline.session import materialise

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the byte-level vocabulary cuts a text before it merges bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_BLANKS = re.compile(r"\s{1000,}")
MAX_SOURCES = 10_000  # sources and their targets are broadcast up to this number


def _encoder(path: str) -> Callable[[list[str]], list[int]]:
    """Token counts of texts, by a `.tiktoken` file of ranks or a `.json` tokenizer file; special tokens count as text."""
    if path.endswith(".tiktoken"):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        encoding = tiktoken.Encoding("mixing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

        def size(text: str) -> int:
            """The pattern recurses over a run of blanks; a long one is a token run of its own but for its last blank."""
            total = at = 0
            for m in LONG_BLANKS.finditer(text):
                end = m.end() - (m.end() < len(text))
                total += len(encoding.encode_ordinary(text[at : m.start()])) + len(encoding._encode_single_piece(text[m.start() : end]))
                at = end
            return total + len(encoding.encode_ordinary(text[at:]))

        return lambda texts: [size(t) for t in texts]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda texts: [len(e.ids) for at in range(0, len(texts), 256) for e in tokenizer.encode_batch_fast(texts[at : at + 256], add_special_tokens=False)]


def _counter(path: str):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = _encoder(path)
        for b in batches:
            yield b[["doc_id", "source"]].assign(tokens=size(b["text"].tolist()))

    return count


def text_sizes(documents: DataFrame, sources: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, source, tokens, u): each distinct text of the wanted sources once.

    A text that several documents or sources hold belongs to its smallest doc_id. Missing texts and
    sources are left out. Sources are compared trimmed and in lower case.
    """
    d = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.lower(strip(present("source"))).alias("source"), present("text").alias("text"))
    d = d.where("doc_id is not null and source is not null and text is not null").join(sources.select("source"), "source", "left_semi")
    # Copies are found by key, so that no text is shuffled more than once and none is tokenised twice.
    first = d.groupBy(F.md5("text").alias("key")).agg(F.min(F.struct("doc_id", "source")).alias("first"), F.min_by("text", F.struct("doc_id", "source")).alias("text"))
    flat = first.select(F.col("first.doc_id").alias("doc_id"), F.col("first.source").alias("source"), "text")
    sizes = flat.mapInPandas(_counter(tokenizer), "doc_id bigint, source string, tokens bigint")
    return sizes.where("tokens > 0")


def _plan(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: share, cap, available tokens, whole copies and the tokens due beyond them."""
    have = sizes.groupBy("source").agg(F.sum("tokens").alias("available"), F.count("*").alias("texts"))
    p = targets.join(have, "source", "left").withColumn("available", F.coalesce("available", F.lit(0)))
    every = Window.partitionBy(F.lit(1))  # one row per source
    usable = (F.col("available") > 0) & (F.col("pct") > 0) & (F.col("cap") > 0)
    p = p.withColumn("share", F.when(usable, F.col("pct")) / F.sum(F.when(usable, F.col("pct"))).over(every))
    p = p.withColumn("total", F.min(F.col("cap") * F.col("available") / F.col("share")).over(every))
    p = p.withColumn("quota", F.coalesce(F.col("share") * F.col("total"), F.lit(0.0)))
    whole = F.least("cap", F.floor(F.col("quota") / F.greatest("available", F.lit(1)) + 1e-9))
    return p.withColumn("whole", F.when(usable, whole).otherwise(0).cast("int")).withColumn("due", F.greatest(F.lit(0.0), F.col("quota") - F.col("whole") * F.col("available")))


def _scales(sizes: DataFrame, plan: DataFrame, power: float) -> DataFrame:
    """(source, scale): inclusion probabilities min(1, scale * tokens ^ power) then expect the tokens that are due.

    Solved on one histogram of sizes per source: with the k largest sizes certain, the rest share what is left; the
    smallest k holds for which no other probability reaches 1.
    """
    h = sizes.groupBy("source", "tokens").agg(F.count("*").alias("n"))  # a row per source and size
    t = F.col("tokens").cast("double")
    h = h.withColumn("g", F.pow(t, F.lit(power))).withColumn("w", t * F.col("n")).withColumn("gw", F.col("g") * F.col("w"))
    by = Window.partitionBy("source").orderBy(F.desc("g"), F.desc("tokens"))
    h = h.withColumn("k", F.row_number().over(by)).withColumn("certain", F.sum("w").over(by.rowsBetween(Window.unboundedPreceding, 0)) - F.col("w")).withColumn("rest", F.sum("gw").over(by.rowsBetween(0, Window.unboundedFollowing)))
    tried = h.join(plan.select("source", "due"), "source").withColumn("scale", F.greatest(F.lit(0.0), F.col("due") - F.col("certain")) / F.col("rest"))
    first = tried.where(F.col("scale") * F.col("g") < 1).groupBy("source").agg(F.min(F.struct("k", "scale"))["scale"].alias("scale"))
    return plan.select("source").join(first, "source", "left").select("source", F.coalesce("scale", F.lit(1e300)).alias("scale"))


def mix(documents: DataFrame, targets: DataFrame, tokenizer: str = TOKENIZER, seed: int = 0, power: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """(selection, report). selection: doc_id, source, tokens, copies of every text in the mix.

    `power` is the exponent of the tokens in the sampling weight; 0 makes all texts equally likely. targets has
    source, target_pct, max_repeats; null, zero or negative targets and caps exclude a source, of several rows of
    a source the first by target and cap holds. Sources without texts get nothing and the others share their part.
    report: source, target_share (of the sources that have texts), texts, available, quota, copies, tokens, share.
    A quota is missed by half a text at most. Empty tables give empty or zero results.
    """
    spark = documents.sparkSession
    goal = targets.select(F.lower(strip("source")).alias("source"), F.col("target_pct").cast("double").alias("pct"), F.col("max_repeats").cast("int").alias("cap")).where("source is not null and pct is not null and cap is not null")
    goal = materialise(goal.groupBy("source").agg(F.max(F.struct("pct", "cap")).alias("x")).select("source", "x.pct", "x.cap"), "targets")
    small = goal.count() <= MAX_SOURCES

    def dim(t: DataFrame) -> DataFrame:
        return F.broadcast(t) if small else t

    sizes = materialise(text_sizes(documents, dim(goal), tokenizer), "sizes")
    plan = materialise(_plan(sizes, goal), "plan")
    scale = _scales(sizes, plan, power)
    g = F.pow(F.col("tokens").cast("double"), F.lit(power))
    u = (F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))
    chance = F.least(F.lit(1.0), F.col("scale") * g)
    rank = F.when(chance >= 1, F.lit(0.0)).when(chance <= 0, F.lit(float("inf"))).otherwise((u / (1 - u)) / (chance / (1 - chance)))
    ranked = sizes.join(dim(scale), "source").select("source", "doc_id", "tokens", rank.alias("rank"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranked = materialise(ranked.repartitionByRange(parts, "source", "rank", "doc_id").withColumn("part", F.spark_partition_id()), "ranked")
    sums = ranked.groupBy("source", "part").agg(F.sum("tokens").alias("w"))  # partitions times sources at most
    placed = sums.withColumn("before", F.sum("w").over(Window.partitionBy("source").orderBy("part")) - F.col("w")).join(plan.select("source", "due", "whole"), "source")
    inside = ranked.join(placed.select("source", "part", "before", "due", "whole", (F.col("before") + F.col("w") <= F.col("due")).alias("all")), ["source", "part"])
    cut = inside.where(~F.col("all") & (F.col("before") < F.col("due")))
    run = F.sum("tokens").over(Window.partitionBy("source", "part").orderBy("rank", "doc_id"))
    cut = cut.withColumn("extra", (F.col("before") + run - F.col("tokens") / 2 < F.col("due")) & (F.col("rank") < float("inf")))
    rest = inside.where(F.col("all") | (F.col("before") >= F.col("due"))).withColumn("extra", F.col("all") & (F.col("due") > 0))
    chosen = cut.unionByName(rest).select("doc_id", "source", "tokens", (F.col("whole") + F.col("extra").cast("int")).alias("copies")).where("copies > 0")
    chosen = materialise(chosen, "mix")
    got = chosen.groupBy("source").agg(F.sum("copies").cast("bigint").alias("copies"), F.max("copies").alias("most"), F.sum(F.col("tokens") * F.col("copies")).alias("tokens"))
    whole = Window.partitionBy(F.lit(1))
    report = plan.join(got, "source", "left").select(
        "source", "pct", F.coalesce("share", F.lit(0.0)).alias("target_share"), F.coalesce("texts", F.lit(0)).alias("texts"), "available", F.floor("quota").alias("quota"),
        F.coalesce("copies", F.lit(0)).alias("copies"), F.coalesce("most", F.lit(0)).alias("most_repeated"), F.coalesce("tokens", F.lit(0)).alias("tokens"),
        (F.coalesce("tokens", F.lit(0)) / F.greatest(F.sum("tokens").over(whole), F.lit(1))).alias("share"),
    )
    return chosen, report
