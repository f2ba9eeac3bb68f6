"""Failed tasks are retried and give the same results (deterministic plans)."""

from pyspark import TaskContext

from reelscope.plans import analyses as a
from reelscope.sources.star import star_tables
from reelscope.sources.tables import Tables


def test_results_survive_task_failures(spark, sf001_dir):
    # defined here so it is shipped to the Python workers by value
    def _fail_first_attempt(batches):
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("injected task failure")
        yield from batches

    t = star_tables(spark, sf001_dir)
    flaky = Tables(
        ratings=t.ratings.repartition(4).mapInPandas(_fail_first_attempt, schema=t.ratings.schema),
        users=t.users,
        movies=t.movies,
        occupations=t.occupations,
    )
    for analysis in (a.top_avg_detail, a.cohort_semi_top, a.occupation_genre_counts):
        assert sorted(analysis(flaky).collect()) == sorted(analysis(t).collect()), analysis.__name__
