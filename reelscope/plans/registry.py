"""Query keys -> analyses with the reference's default parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame

from reelscope.functions.columns import YEAR_PATTERN_PLAIN, YEAR_PATTERN_TWO_WORD
from reelscope.plans import analyses as a
from reelscope.plans import distributed as d
from reelscope.sources.tables import Tables

ANALYSES: dict[str, Callable[[Tables], DataFrame]] = {
    # requirement 1
    "r1_table_counts": a.table_counts,
    "r1_users_by_occupation": a.users_by_occupation,
    "r1_joined_user_count": a.joined_user_count,
    # requirement 2
    "r2_user_movie_count": a.user_movie_count,
    "r2_user_movies": a.user_movies,
    "r2_user_movies_brief": a.user_movies_brief,
    # requirement 3
    "r3_top_avg": a.top_avg,
    "r3_top_avg_detail": a.top_avg_detail,
    "r3_top_avg_detail_brief": a.top_avg_detail_brief,
    "r3_top_watched": a.top_watched,
    "r3_top_watched_detail": a.top_watched_detail,
    "r3_top_watched_detail_brief": a.top_watched_detail_brief,
    "r3_decoded_rating_stats": a.decoded_rating_stats,
    # requirement 4
    "r4_top_total_female": partial(a.top_total_by_gender, gender="F"),
    "r4_top_total_male": partial(a.top_total_by_gender, gender="M"),
    "r4_top_avg_detail_female": partial(a.top_avg_detail_by_gender, gender="F"),
    "r4_top_avg_detail_male": partial(a.top_avg_detail_by_gender, gender="M"),
    "r4_top_avg_named_female": partial(a.top_avg_named_by_gender, gender="F"),
    "r4_top_avg_named_male": partial(a.top_avg_named_by_gender, gender="M"),
    # requirement 5
    "r5_cohort_user_count": a.cohort_user_count,
    "r5_rating_count": a.rating_count,
    "r5_cohort_rating_count": a.cohort_rating_count,
    "r5_cohort_top_avg": a.cohort_top_avg,
    "r5_cohort_top_avg_brief": a.cohort_top_avg_brief,
    "r5_cohort_top_named": a.cohort_top_named,
    "r5_cohort_top_named_brief": a.cohort_top_named_brief,
    "r5_cohort_multikey": a.cohort_multikey,
    "r5_cohort_semi_count": a.cohort_semi_count,
    "r5_cohort_semi_top100": a.cohort_semi_top,
    # requirements 6-8
    "r6_genre_counts": a.genre_counts,
    "r7_year_counts_two_word": partial(a.year_counts, pattern=YEAR_PATTERN_TWO_WORD),
    "r7_year_counts": partial(a.year_counts, pattern=YEAR_PATTERN_PLAIN),
    "r7_title_parts": a.title_parts,
    "r8_year_genre_lookup": a.year_genre_lookup,
    "r8_year_genre_counts_two_word": partial(a.year_genre_counts, pattern=YEAR_PATTERN_TWO_WORD),
    "r8_year_genre_counts": partial(a.year_genre_counts, pattern=YEAR_PATTERN_PLAIN),
    # requirements 9-10
    "r9_occupation_genre_counts": a.occupation_genre_counts,
    "r10_occupation_genre_sink": a.occupation_genre_sink_rows,
    # requirement texts 4 and 5 ask for every gender / age band: one pass each
    "x_all_age_top10": a.top_avg_per_age,
    "x_all_gender_top10": a.top_avg_per_gender,
}

# The same questions and their extensions by mechanisms made for a cluster.
DISTRIBUTED: dict[str, Callable[[Tables], DataFrame]] = {
    "r3_movie_positions": d.movie_positions,
    "r8_year_genre_positions": d.year_genre_positions,
    "r8_year_movie_pages": d.year_movie_pages,
    "r8_year_genre_counts_from_pages": d.year_genre_counts_from_pages,
    "r4_top_total_female_threshold": partial(d.top_total_by_threshold, gender="F"),
    "r4_top_total_male_threshold": partial(d.top_total_by_threshold, gender="M"),
    "x_rating_levels": d.rating_levels,
    "x_report_lists": d.report_lists,
    "r5_cohort_bitmap_count": d.cohort_bitmap_count,
    "x_cohort_overlaps": d.cohort_overlaps,
    "r9_occupation_genre_counts_split": d.occupation_genre_counts_split,
    "r3_exact_thirds": d.exact_thirds,
    "r3_stats_from_state": d.stats_from_state,
    "r3_stats_after_withdrawal": d.stats_after_withdrawal,
    "r1_record_faults": d.record_faults,
    "r1_good_record_stats": d.stats_of_good_records,
    "r10_sink_written_twice": d.sink_rows_written_twice,
}

# Those that write intermediate tables, or count keys, while they are built; all others start no job.
STAGED = set(DISTRIBUTED) - {"x_rating_levels", "r5_cohort_bitmap_count", "x_cohort_overlaps", "r3_exact_thirds"}

QUERIES = ANALYSES | DISTRIBUTED
