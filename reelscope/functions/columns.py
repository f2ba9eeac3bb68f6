"""Pure ``Column`` expressions.  All JVM-side built-ins, so they stay inside
whole-stage code generation; none needs a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The title-year patterns of the two program generations,
# matched with find semantics (the match may start and end anywhere).
# Group 2 is the bracketed year "(dddd)"; ".*" is greedy, so the last
# " (dddd)" wins.  The current programs want a space before the name group,
# so a one-word title such as "Heat (1995)" has no year under that pattern.
YEAR_PATTERN_TWO_WORD = r" (.*) (\(\d{4}\))"
YEAR_PATTERN_PLAIN = r"(.*) (\(\d{4}\))"
UNKNOWN_YEAR = -1

# Separator inside a genre list and before the year in a title.
GENRE_SEPARATOR = "|"
TITLE_YEAR_SEPARATOR = " ("

# The age band codes and what they stand for.
AGE_BANDS = {
    1: "Under 18",
    18: "18-24",
    25: "25-34",
    35: "35-44",
    45: "45-49",
    50: "50-55",
    56: "56+",
}


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_genres(genres: str | Column) -> Column:
    """Split ``A|B|C`` into an array the way ``String.split("\\|")`` does.

    Spark's ``split`` keeps trailing empty pieces, the reference's split drops
    them: ``"Drama|"`` -> ``[Drama]``, ``"|"`` -> ``[]``, ``""`` -> ``[""]``;
    inner and leading empties stay (``"|Drama"`` -> ``["", Drama]``).
    Repeated genres stay repeated; they are counted twice.
    """
    g = _col(genres)
    stripped = F.regexp_replace(g, r"[|]+$", "")
    return (
        F.when(g == F.lit(""), F.array(F.lit("")))
        .when(stripped == F.lit(""), F.array().cast("array<string>"))
        .otherwise(F.split(stripped, r"[|]"))
    )


def title_year(title: str | Column, pattern: str = YEAR_PATTERN_TWO_WORD) -> Column:
    """Release year from a title, ``-1`` when the pattern does not match."""
    bracketed = F.regexp_extract(_col(title), pattern, 2)
    return (
        F.when(bracketed == F.lit(""), F.lit(UNKNOWN_YEAR))
        .otherwise(F.substring(bracketed, 2, 4).cast("int"))
        .alias("year")
    )


def title_pattern_name(title: str | Column, pattern: str = YEAR_PATTERN_TWO_WORD) -> Column:
    """Group 1 of a year pattern: the text before the last ``" (dddd)"``
    (after the first space for the two-word pattern); ``''`` without a match."""
    return F.regexp_extract(_col(title), pattern, 1)


def title_name(title: str | Column) -> Column:
    """Title cut at the first ``" ("``; a title without one is kept whole
    (the reference would throw there)."""
    return F.substring_index(_col(title), TITLE_YEAR_SEPARATOR, 1)


def age_band_label(age: str | Column) -> Column:
    """Readable label of an age band code; null for an unknown code."""
    mapping = F.create_map(*[F.lit(x) for kv in AGE_BANDS.items() for x in kv])
    return F.try_element_at(mapping, _col(age))
