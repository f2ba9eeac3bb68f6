from reelscope.functions.columns import (
    AGE_BANDS,
    UNKNOWN_YEAR,
    YEAR_PATTERN_PLAIN,
    YEAR_PATTERN_TWO_WORD,
    age_band_label,
    split_genres,
    title_name,
    title_pattern_name,
    title_year,
)

__all__ = [
    "AGE_BANDS",
    "UNKNOWN_YEAR",
    "YEAR_PATTERN_PLAIN",
    "YEAR_PATTERN_TWO_WORD",
    "age_band_label",
    "split_genres",
    "title_name",
    "title_pattern_name",
    "title_year",
]
