"""The valid score of a video."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.functions.keys import bare_video_id


def valid_scores(scored: DataFrame) -> DataFrame:
    """(video, score): the latest ml_score from 0 to 1 of each video.

    Null, NaN and out-of-range scores and rows without a video are ignored; a null time counts as the
    oldest; of several valid scores at the latest time the highest holds. Repeated rows change nothing.
    """
    s = scored.select(bare_video_id("video_id").alias("video"), F.col("ml_score").cast("double").alias("score"), "scored_at")
    s = s.where("video is not null and score >= 0 and score <= 1 and not isnan(score)")
    return s.groupBy("video").agg(F.max(F.struct("scored_at", "score"))["score"].alias("score"))
