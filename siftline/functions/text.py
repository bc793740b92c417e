"""Text columns: concatenations, token markers, flags and length features. All are plain column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftline.functions.keys import _col, present


def squeeze(c: Column | str) -> Column:
    """White space runs become one blank; none at the ends."""
    return F.trim(F.regexp_replace(_col(c), r"\s+", " "))


def filled(c: Column | str) -> Column:
    """Empty instead of null."""
    return F.coalesce(_col(c), F.lit(""))


def title_with(other: Column | str, title: Column | str = "title") -> Column:
    """Title and another field, missing ones empty."""
    return squeeze(F.concat_ws(" ", filled(title), filled(other)))


def title_and_description(limit: int = 800, title: Column | str = "title", description: Column | str = "description") -> Column:
    """Title and the first `limit` characters of the description, cut before white space is squeezed."""
    return squeeze(F.concat_ws(" ", filled(title), F.substring(filled(description), 1, limit)))


def title_keyword_tokens(title: Column | str = "title", keyword: Column | str = "keyword") -> Column:
    """Title and keyword without exclusion terms (`-word`), and marker tokens for years in the title."""
    kept = F.regexp_replace(filled(keyword), r"(^|\s)-[A-Za-z0-9*?]+", " ")
    film = F.when(filled(title).rlike(r"\(\s*(19|20)[0-9]{2}\s*\)"), F.lit("FILM_YEAR_TOKEN"))
    year = F.when(filled(title).rlike(r"(^|[^\p{L}\p{N}_])[0-9]{4}([^\p{L}\p{N}_]|$)"), F.lit("HAS_YEAR_TOKEN"))
    return squeeze(F.concat_ws(" ", filled(title), kept, film, year))


def title_keyword_or_channel(title: Column | str = "title", keyword: Column | str = "keyword", channel: Column | str = "channel") -> Column:
    """Title and keyword, or the channel where the keyword is blank."""
    return squeeze(F.concat_ws(" ", filled(title), F.coalesce(F.nullif(F.trim(filled(keyword)), F.lit("")), filled(channel))))


def joined(fields: Sequence[str]) -> Column:
    """All present fields, joined by a blank."""
    return squeeze(F.concat_ws(" ", *(present(f) for f in fields)))


def parse_fields(spec: str) -> list[str]:
    """Field names of a comma-separated list; raises ValueError where there is none."""
    names = [x.strip() for x in spec.split(",") if x.strip()]
    if not names:
        raise ValueError("no text field named")
    return names


def whole_word(words: Sequence[str]) -> str:
    """A pattern that finds any of the words between characters that are no letters, digits or underscores."""
    return r"(^|[^\p{L}\p{N}_])(" + "|".join(re.escape(w) for w in words) + r")([^\p{L}\p{N}_]|$)"


def word_flags(c: Column | str, words: Sequence[str]) -> list[Column]:
    """One 0/1 column `has_<word>` per word, over the lower-cased text."""
    low = F.lower(filled(c))
    return [low.rlike(whole_word([w])).cast("int").alias(f"has_{w}") for w in words]


def word_count(c: Column | str) -> Column:
    """Words between white space; 0 for a blank text."""
    t = squeeze(filled(c))
    return F.when(t == "", 0).otherwise(F.size(F.split(t, " ")))


def number(c: str) -> Column:
    """The number that a text column holds; null where it holds none, or NaN."""
    x = F.expr(f"try_cast({c} as double)")
    return F.when(~F.isnan(x), x)


def length_features(title: Column | str = "title", description: Column | str = "description", duration: Column | str = "duration_seconds") -> list[Column]:
    """title_len, desc_len, duration_min, has_desc, title_wc, duration_log."""
    seconds = number(duration) if isinstance(duration, str) else duration.cast("double")
    size = F.length(filled(description))
    return [
        F.length(filled(title)).alias("title_len"), size.alias("desc_len"), (F.coalesce(seconds, F.lit(0.0)) / 60).alias("duration_min"),
        (size > 20).cast("int").alias("has_desc"), word_count(title).alias("title_wc"),
        F.log1p(F.greatest(F.lit(1.0), F.least(F.lit(86400.0), F.coalesce(seconds, F.lit(600.0))))).alias("duration_log"),
    ]


def contains_flag(c: Column | str, part: str) -> Column:
    return filled(c).contains(part).cast("int")
