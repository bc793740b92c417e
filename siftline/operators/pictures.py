"""Pictures as raw pixels: how much they look like text overlays. Decoding is a plug-in, because no decoder is at hand."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCORES = "stroke_high_ratio double, lap_std double, text_score double"
STRONG_EDGE, FULL_STROKES, FULL_LAP = 96, 0.12, 60.0  # brightness step of a stroke; values at which a part of the score is full


def text_signals(gray: np.ndarray) -> tuple[float, float, float]:
    """(stroke_high_ratio, lap_std, text_score) of brightness 0 to 255: share of pixels at strong edges, spread of the Laplacian, and their mean, 0 to 1."""
    g = gray.astype(np.float64)
    if min(g.shape) < 3:
        return 0.0, 0.0, 0.0
    dx, dy = np.abs(g[1:-1, 2:] - g[1:-1, :-2]), np.abs(g[2:, 1:-1] - g[:-2, 1:-1])
    strokes = float((np.maximum(dx, dy) >= STRONG_EDGE).mean())
    lap = float((g[1:-1, 2:] + g[1:-1, :-2] + g[2:, 1:-1] + g[:-2, 1:-1] - 4 * g[1:-1, 1:-1]).std())
    return strokes, lap, (min(1.0, strokes / FULL_STROKES) + min(1.0, lap / FULL_LAP)) / 2


def middle_tile(rows: int, columns: int, tiles: int) -> int:
    """The tile of a storyboard sheet that stands for the video: the middle one, or the first where the sheet is not full."""
    at = rows * columns // 2
    return at if at < tiles else 0


def crop(gray: np.ndarray, index: int, columns: int, width: int, height: int) -> np.ndarray | None:
    """A tile of a sheet; None where it lies outside."""
    y, x = divmod(index, columns)
    part = gray[y * height : (y + 1) * height, x * width : (x + 1) * width]
    return part if part.shape[:2] == (height, width) else None


def text_heaviness(df: DataFrame, key: str, pixels: str = "pixels", width: str = "width", height: str = "height") -> DataFrame:
    """(key, SCORES) of pictures given as rows of one byte a pixel (gray) or three (red, green, blue).

    Null pictures and pictures whose size does not fit have null scores.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for data, w, h in zip(b["pixels"], b["width"], b["height"], strict=True):
                x = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
                bad = data is None or not w or not h or len(x) not in (w * h, 3 * w * h) or pd.isna(w) or pd.isna(h)
                out.append((None, None, None) if bad else text_signals(x.reshape(int(h), int(w), -1).mean(2)))
            yield pd.concat([b[["key"]].reset_index(drop=True), pd.DataFrame(out, columns=["stroke_high_ratio", "lap_std", "text_score"], dtype=float)], axis=1).rename(columns={"key": key})

    rows = df.select(F.col(key).alias("key"), F.col(pixels).alias("pixels"), F.col(width).alias("width"), F.col(height).alias("height"))
    return rows.mapInPandas(run, f"{key} {dict(df.dtypes)[key]}, {SCORES}")
