"""The valid score of a video, as the core defines it."""

from siftline.operators.scores import valid_scores

__all__ = ["valid_scores"]
