"""Run the analyses of one requirement and show their results.

    python scripts/run_requirement.py DATA_DIR N [--star] [--older] [--rows 20]
                                      [--user-id 18] [--age 1] [--k 10]
                                      [--encoding ISO-8859-1] [--mode fail|drop]

``DATA_DIR`` holds ``ratings.dat users.dat movies.dat occupations.dat``
(``::``-delimited), or with ``--star`` the parquet star-schema tables.
``--older`` shows the older programs' output shapes where they differ.
"""

from __future__ import annotations

import argparse
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from reelscope.functions import YEAR_PATTERN_PLAIN  # noqa: E402
from reelscope.plans import analyses as a  # noqa: E402
from reelscope.session import build_session  # noqa: E402
from reelscope.sources.dat import dat_tables, line_counts  # noqa: E402
from reelscope.sources.star import star_tables  # noqa: E402


def requirement(n: int, t, args, spark) -> list[tuple[str, object]]:
    k, older = args.k, args.older
    if n == 1:
        counts = a.table_counts(t) if args.star else line_counts(spark, args.data_dir)
        return [
            ("table sizes", counts),
            ("users with their occupation", a.users_by_occupation(t)),
            ("users with a known occupation", a.joined_user_count(t)),
        ]
    if n == 2:
        movies = a.user_movies_brief if older else a.user_movies
        return [
            (f"ratings by user {args.user_id}", a.user_movie_count(t, args.user_id)),
            (f"titles rated by user {args.user_id}", movies(t, args.user_id)),
        ]
    if n == 3:
        return [
            ("best mean rating", a.top_avg(t, k)),
            ("best mean rating, details", (a.top_avg_detail_brief if older else a.top_avg_detail)(t, k)),
            ("most ratings", a.top_watched(t, k)),
            ("most ratings, details", (a.top_watched_detail_brief if older else a.top_watched_detail)(t, k)),
        ]
    if n == 4:
        out = []
        for g, label in (("F", "women"), ("M", "men")):
            out.append((f"largest rating total, {label}", a.top_total_by_gender(t, g, k)))
        for g, label in (("F", "women"), ("M", "men")):
            detail = a.top_avg_named_by_gender if older else a.top_avg_detail_by_gender
            out.append((f"best mean rating, {label}", detail(t, g, k)))
        return out
    if n == 5:
        age = args.age
        if older:
            return [
                (f"best mean rating, age band {age}", a.cohort_top_avg_brief(t, age, k)),
                (f"best mean rating with names, age band {age}", a.cohort_top_named_brief(t, age, k)),
            ]
        return [
            (f"users in age band {age}", a.cohort_user_count(t, age)),
            ("ratings", a.rating_count(t)),
            (f"ratings by age band {age}", a.cohort_rating_count(t, age)),
            (f"best mean rating, age band {age}", a.cohort_top_avg(t, age, k)),
            (f"best mean rating with names, age band {age}", a.cohort_top_named(t, age, k)),
            ("by mean, count, title", a.cohort_multikey(t, age, k)),
            (f"ratings by age band {age} (semi-join)", a.cohort_semi_count(t, age)),
            ("best 100 by mean, count, id as text", a.cohort_semi_top(t, age)),
            ("every age band at once", a.top_avg_per_age(t, k)),
        ]
    if n == 6:
        return [("titles per genre", a.genre_counts(t))]
    if n == 7:
        kwargs = {"pattern": YEAR_PATTERN_PLAIN} if older else {}
        return [("titles per year", a.year_counts(t, **kwargs))]
    if n == 8:
        kwargs = {"pattern": YEAR_PATTERN_PLAIN} if older else {}
        return [("titles per year and genre", a.year_genre_counts(t, **kwargs))]
    if n in (9, 10):
        name = "rows for the result(occ, mtype, nums) sink" if n == 10 else "ratings per occupation and genre"
        df = a.occupation_genre_sink_rows(t) if n == 10 else a.occupation_genre_counts(t)
        return [(name, df)]
    raise SystemExit(f"requirement must be 1..10, not {n}")


def main() -> None:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("data_dir")
    p.add_argument("requirement", type=int)
    p.add_argument("--star", action="store_true", help="read the parquet star-schema tables")
    p.add_argument("--older", action="store_true", help="older output shapes")
    p.add_argument("--rows", type=int, default=20)
    p.add_argument("--k", type=int, default=a.DEFAULT_K)
    p.add_argument("--user-id", type=int, default=a.DEFAULT_USER_ID)
    p.add_argument("--age", type=int, default=a.DEFAULT_AGE)
    p.add_argument("--encoding", default="UTF-8")
    p.add_argument("--mode", default="fail", choices=("fail", "drop"))
    p.add_argument("--master", default=None)
    args = p.parse_args()

    spark = build_session(master=args.master, app_name=f"requirement-{args.requirement}")
    if args.star:
        t = star_tables(spark, args.data_dir)
    else:
        t = dat_tables(spark, args.data_dir, mode=args.mode, encoding=args.encoding)
    for title, df in requirement(args.requirement, t, args, spark):
        print(f"== {title}")
        df.show(args.rows, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
