"""Analyses written to the relational sink."""

from __future__ import annotations

from reelscope.plans.analyses import occupation_genre_sink_rows
from reelscope.sinks.jdbc import as_sink, write_jdbc
from reelscope.sources.schema import RESULT_SINK
from reelscope.sources.tables import Tables


def write_occupation_genre_counts(
    t: Tables, url: str, table: str = "result", mode: str = "append", **options
) -> int:
    """Occupation x genre counts into ``result(occ, mtype, nums)``; rows sent."""
    return write_jdbc(as_sink(occupation_genre_sink_rows(t), RESULT_SINK), url, table, mode, **options)
