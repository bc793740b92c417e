"""Text features: TF-IDF over words and in-word character n-grams, and feature vectors for models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.functions.text import filled
from siftline.operators.vectors import MAX_LITERALS, max_similarity


def tokens(text: Column | str) -> Column:
    """Lower-cased words of two characters or more."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(filled(c)), F.lit(r"[\p{L}\p{N}_]{2,}"), 0)


def strip_accents(text: Column) -> Column:
    """Latin letters without their diacritics (the common precomposed ones)."""
    return F.translate(text, "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ", "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY")


def word_ngrams(words: Column, first: int, last: int) -> Column:
    """All runs of `first` to `last` words, joined by a blank."""

    def runs(n: int) -> Column:
        at = F.sequence(F.lit(0), F.size(words) - n)
        return F.when(F.size(words) >= n, F.transform(at, lambda i: F.array_join(F.slice(words, i + 1, n), " "))).otherwise(F.array().cast("array<string>"))

    return F.concat(*(runs(n) for n in range(first, last + 1)))


def char_wb_ngrams(text: Column, first: int, last: int) -> Column:
    """Character n-grams inside words, each word framed by blanks; framed words shorter than n give none."""
    words = F.filter(F.split(F.lower(filled(text)), r"\s+"), lambda w: w != "")

    def grams(w: Column) -> Column:
        framed = F.concat(F.lit(" "), w, F.lit(" "))
        size = F.length(framed)

        def runs(n: int) -> Column:
            cut = F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.substring(framed, i, F.lit(n)))
            return F.when(size >= n, cut).otherwise(F.array().cast("array<string>"))

        return F.flatten(F.array(*(runs(n) for n in range(first, last + 1))))

    return F.flatten(F.transform(words, grams))


def tfidf(df: DataFrame, key: str, terms: Column, min_df: int = 1, max_df: float = 1.0, max_features: int | None = None, sublinear: bool = True) -> DataFrame:
    """(key, term, weight): (1 + ln tf) * (ln((1 + N) / (1 + df)) + 1), each row's weights of unit length.

    Terms in fewer than min_df rows or in more than max_df of all rows are left out; with max_features the terms of
    most occurrences stay, ties by term. Everything is one count per (key, term) and joins on the term.
    """
    n = df.agg(F.count("*").alias("n_rows"))  # one row
    tf = df.select(key, F.explode(terms).alias("term")).groupBy(key, "term").agg(F.count("*").alias("tf"))
    vocab = tf.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("total")).crossJoin(F.broadcast(n))
    vocab = vocab.where((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df) * F.col("n_rows")))
    if max_features:
        vocab = vocab.orderBy(F.desc("total"), "term").limit(max_features)
    vocab = vocab.select("term", (F.log((1 + F.col("n_rows")) / (1 + F.col("df"))) + 1).alias("idf"))
    w = tf.join(vocab, "term").select(key, "term", ((1 + F.log("tf") if sublinear else F.col("tf")) * F.col("idf")).alias("raw"))
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(key)))
    return w.select(key, "term", (F.col("raw") / length).alias("weight"))


def feature_array(vector: str, positives: Sequence[Sequence[float]], negatives: Sequence[Sequence[float]], duration: Column) -> Column:
    """The vector, its best similarity to positive and to negative prototypes, and log1p of the duration."""
    if len(positives) + len(negatives) > MAX_LITERALS:
        raise ValueError("too many prototypes")
    v = F.col(vector)
    extra = F.array(max_similarity(v, positives), max_similarity(v, negatives), F.log1p(F.coalesce(duration, F.lit(0.0))))
    return F.concat(F.transform(v, lambda x: x.cast("double")), extra)
