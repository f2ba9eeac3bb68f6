"""An aggregating analysis over a growing folder of ``::`` files."""

import os
import tempfile
import uuid

from reelscope.plans import analyses as a
from reelscope.sources import schema as S
from reelscope.sources.tables import Tables
from reelscope.streaming import checkpoint_location, read_dat_stream


def test_genre_counts_update_as_files_arrive(spark):
    folder = tempfile.mkdtemp(prefix="reelscope-stream-")
    with open(os.path.join(folder, "a.dat"), "w", encoding="utf-8") as f:
        f.write("1::Toy Story (1995)::Animation|Comedy\n2::Heat (1995)::Action|Crime|\n\n")
    movies = read_dat_stream(spark, folder, S.MOVIES)
    empty = {
        "ratings": spark.createDataFrame([], S.RATINGS),
        "users": spark.createDataFrame([], S.USERS),
        "occupations": spark.createDataFrame([], S.OCCUPATIONS),
    }
    t = Tables(movies=movies, **empty)
    # a fresh checkpoint per run: a reused one would resume the old stream
    run = f"genre_counts_{uuid.uuid4().hex[:8]}"
    q = (
        a.genre_counts(t)
        .writeStream.outputMode("complete")
        .format("memory")
        .queryName("genre_counts_stream")
        .option("checkpointLocation", checkpoint_location(spark, run))
        .start()
    )
    try:
        q.processAllAvailable()
        first = {r.genre: r.n for r in spark.sql("select * from genre_counts_stream").collect()}
        assert first == {"Animation": 1, "Comedy": 1, "Action": 1, "Crime": 1}
        with open(os.path.join(folder, "b.dat"), "w", encoding="utf-8") as f:
            f.write("3::Seven (Se7en) (1995)::Crime|Thriller\n")
        q.processAllAvailable()
        second = {r.genre: r.n for r in spark.sql("select * from genre_counts_stream").collect()}
        assert second == {"Animation": 1, "Comedy": 1, "Action": 1, "Crime": 2, "Thriller": 1}
    finally:
        q.stop()


def test_checkpoint_location_is_under_the_session_folder(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    base = configured or spark.sparkContext.getCheckpointDir()
    assert base
    loc = checkpoint_location(spark, "q1")
    assert loc == f"{base.rstrip('/')}/streams/q1"
