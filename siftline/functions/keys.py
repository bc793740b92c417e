"""Key expressions: missing values, video ids and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Unicode has it; trim() alone knows the blank only.
BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without surrounding white space (any Unicode blank)."""
    return F.trim(_col(c), F.lit(BLANKS))


def present(c: Column | str) -> Column:
    """The value, or null where it is missing: null, blank, or `nan` in any case."""
    t = strip(c)
    return F.when((t != "") & (F.lower(t) != "nan"), _col(c))


def bare_video_id(c: Column | str) -> Column:
    """The id without blanks and without an address before it; null where missing."""
    t = strip(present(c))
    return F.nullif(F.regexp_replace(t, r"^.*(?:/v/|watch\?v=)", ""), F.lit(""))


def name_key(c: Column | str) -> Column:
    """Equal for the same name: no address, no leading @, no white space, no case; null where missing."""
    t = F.regexp_replace(strip(present(c)), r"^(?:.*/(?=@)|[A-Za-z][A-Za-z0-9+.-]*://[^/]*/?)", "")
    t = F.ltrim(F.translate(t, BLANKS, ""), F.lit("@"))
    return F.nullif(F.lower(t), F.lit(""))


def group_id(*columns: Column | str) -> Column:
    """The first present of several columns, such as channel, source_ref, video_id."""
    return F.coalesce(*(present(c) for c in columns))
