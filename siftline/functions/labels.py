"""Label normalisation and the loaders that accept several label columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.functions.keys import _col

# Spellings of the human verdicts.
PASS_WORDS = ("t", "合格", "pass")
FAIL_WORDS = ("f", "不合格", "fail")


def strict_label(c: Column | str) -> Column:
    """T for T or PASS, F for texts that begin with F unless they say that the video cannot be played; else null."""
    u = F.upper(F.trim(_col(c)))
    dead = u.contains("无法播放") | u.contains("UNPLAYABLE")
    return F.when(u.isin("T", "PASS"), "T").when(u.startswith("F") & ~dead, "F")


def human_label(c: Column | str) -> Column:
    """pass, fail or null."""
    low = F.lower(F.trim(_col(c)))
    return F.when(low.isin(*PASS_WORDS), "pass").when(low.isin(*FAIL_WORDS), "fail")


def bool_label(c: Column | str) -> Column:
    """True, false or null (unsure, blank)."""
    low = F.lower(F.trim(_col(c)))
    return F.when(low.isin("t", "true"), True).when(low.isin("f", "false"), False)


def kind(c: Column | str) -> Column:
    """T, F or U; null for ERROR, blank and anything else. Human words count as T and F."""
    u = F.upper(F.trim(_col(c)))
    return F.when(u.isin("T", "F", "U"), u).when(human_label(c) == "pass", "T").when(human_label(c) == "fail", "F")


def answer(c: Column | str) -> Column:
    """The verdict letter that stands alone in a model's answer, or ERROR."""
    found = F.regexp_extract(F.coalesce(_col(c), F.lit("")), r"(?:^|[^\p{L}\p{N}_])([TtFfUu])(?:[^\p{L}\p{N}_]|$)", 1)
    return F.when(found == "", "ERROR").otherwise(F.upper(found))


@dataclass(frozen=True)
class Loader:
    """Which label columns count, in which order, and what they may say.

    The first column counts that exists and, where `needs_value` is set, holds a kept value in some row.
    """

    columns: Sequence[str]
    kept: Sequence[str] = ("T", "F", "U")
    negative: str = "F"
    needs_value: bool = False
    keep: str = "first"

    def load(self, tables: Sequence[tuple[str, DataFrame]], key: str = "video_id") -> DataFrame:
        """All tables' labelled rows with label_kind, y and the table's name; one row per key.

        Raises ValueError for a table without the key or any label column. Rows are kept by table order, then
        by `row_ordinal` where the table has it (else by all columns), because tables have no order of their own.
        """
        from siftline.operators.dedup import keep_by_order

        parts = []
        for i, (name, df) in enumerate(tables):
            have = [c for c in self.columns if c in df.columns]
            if key not in df.columns or not have:
                raise ValueError(f"{name}: needs {key} and one of {', '.join(self.columns)}")
            chosen = have[0]
            if self.needs_value:
                for c in have:
                    if not df.where(F.upper(F.trim(c)).isin(*self.kept)).isEmpty():
                        chosen = c
                        break
            k = F.upper(F.trim(chosen))
            rows = df.where(k.isin(*self.kept)).withColumn("label_kind", k).withColumn("y", (k != self.negative).cast("int"))
            if "row_ordinal" not in df.columns:
                rows = rows.withColumn("row_ordinal", F.xxhash64(*df.columns))
            parts.append(rows.withColumn("qc_round", F.lit(name)).withColumn("source_ordinal", F.lit(i)))
        if not parts:
            raise ValueError("no table")
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p, allowMissingColumns=True)
        return keep_by_order(out, [key], ["source_ordinal", "row_ordinal"], last=self.keep == "last").drop("source_ordinal", "row_ordinal")


def pending(status: Column | str, retry_errors: bool = False) -> Column:
    """Whether a row still has to be judged: no status, or an error that is to be tried again."""
    s = F.upper(F.trim(F.coalesce(_col(status), F.lit(""))))
    return s.isin("", "ERROR") if retry_errors else s == ""


def fill_blank(column: str, value: Column, name: str, source: str) -> list[Column]:
    """The column with its blanks filled from `value`, and where each filled value came from."""
    have = F.nullif(F.trim(column), F.lit(""))
    return [F.coalesce(have, value).alias(column), F.when(have.isNull() & value.isNotNull(), name).alias(source)]


def error_kind(c: Column | str, transient: Sequence[str], permanent: Sequence[str]) -> Column:
    """transient, permanent or unknown, by parts of the error text; passing failures come first."""
    low = F.lower(F.coalesce(_col(c), F.lit("")))

    def has(parts: Sequence[str]) -> Column:
        out = F.lit(False)
        for p in parts:
            out = out | low.contains(p)
        return out

    return F.when(has(transient), "transient").when(has(permanent), "permanent").otherwise("unknown")
