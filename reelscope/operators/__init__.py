from reelscope.operators.genres import explode_genres, with_year
from reelscope.operators.joins import (
    bounded_broadcast,
    broadcast_bytes,
    cohort,
    with_movie,
    with_occupation,
)
from reelscope.operators.stats import count_by, count_map, rating_stats, rating_totals, row_count
from reelscope.operators.topk import by_count, by_mean, top_k, top_k_per_group

__all__ = [
    "by_count",
    "by_mean",
    "bounded_broadcast",
    "broadcast_bytes",
    "cohort",
    "count_by",
    "count_map",
    "explode_genres",
    "rating_stats",
    "rating_totals",
    "row_count",
    "top_k",
    "top_k_per_group",
    "with_movie",
    "with_occupation",
    "with_year",
]
