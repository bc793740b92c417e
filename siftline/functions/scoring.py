"""Scores to actions, bands, bounds and other closed forms."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftline.functions.keys import _col


def action(score: Column | str, drop_below: float, keep_from: float, names: tuple[str, str, str] = ("drop", "keep_candidate", "uncertain")) -> Column:
    """Below `drop_below` drop, from `keep_from` keep, else uncertain; a null score is uncertain, never dropped."""
    s = _col(score)
    return F.when(s < drop_below, names[0]).when(s >= keep_from, names[1]).otherwise(names[2])


def confidence_band(score: Column | str, high_to: float = 0.2, mid_to: float = 0.5) -> Column:
    """Confidence of a rejection: high for low scores."""
    s = _col(score)
    return F.when(s <= high_to, "high").when(s <= mid_to, "mid").when(s.isNotNull(), "low")


def contrast(keep: Column | str, drop: Column | str, tau: float = 0.08) -> Column:
    """Logistic contrast of two similarities, clipped to [1e-6, 1 - 1e-6]; null if either is."""
    x = (_col(keep) - _col(drop)) / F.lit(max(tau, 1e-6))
    return F.when(x.isNotNull(), F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), 1 / (1 + F.exp(-x)))))


def sample_indices(total: Column | str, n: int) -> Column:
    """n evenly spread indices, all where total <= n."""
    t = _col(total).cast("bigint")
    spread = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.floor((i + 0.5) * t / n).cast("bigint"))
    return F.when(t <= 0, F.array().cast("array<bigint>")).when(t <= n, F.sequence(F.lit(0).cast("bigint"), t - 1)).otherwise(spread)


def wilson_lower(k: Column | str, n: Column | str, confidence: float = 0.9) -> Column:
    """Lower end of the two-sided Wilson interval; 0 where n is 0."""
    z = NormalDist().inv_cdf(0.5 + confidence / 2)
    kk, nn = _col(k).cast("double"), _col(n).cast("double")
    m = F.greatest(nn, F.lit(1.0))
    p = kk / m
    low = (p + z * z / (2 * m) - z * F.sqrt(p * (1 - p) / m + z * z / (4 * m * m))) / (1 + z * z / m)
    return F.when(nn > 0, F.greatest(F.lit(0.0), low)).otherwise(0.0)


def retention(kept: Column | str, total: Column | str) -> Column:
    """Per cent kept, one decimal, 0 for an empty input."""
    n = _col(total)
    return F.when(n > 0, F.round(_col(kept) * 100.0 / n, 1)).otherwise(0.0)
