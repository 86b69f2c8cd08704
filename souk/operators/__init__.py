"""Generic DataFrame operators the reports are composed of."""

from souk.operators.ordered import (
    Sort, asc, desc, lag_lead, moving, rank_by_key, rank_within, running_max, running_sum, running_sums, segments,
)
from souk.operators.threshold import above, above_mean, above_percentile, equal_to_max, percentile_cont
from souk.operators.topk import top_k

__all__ = [
    "Sort", "asc", "desc", "lag_lead", "moving", "rank_by_key", "rank_within", "running_max", "running_sum",
    "running_sums", "segments",
    "above", "above_mean", "above_percentile", "equal_to_max", "percentile_cont", "top_k",
]
