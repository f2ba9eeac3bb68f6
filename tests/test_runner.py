"""The per-requirement runner builds and runs every requirement's analyses."""

import importlib.util
import os
import types

import pytest

from reelscope.sources.star import star_tables

HERE = os.path.dirname(os.path.abspath(__file__))
spec = importlib.util.spec_from_file_location(
    "run_requirement", os.path.join(HERE, "..", "scripts", "run_requirement.py")
)
runner = importlib.util.module_from_spec(spec)
spec.loader.exec_module(runner)


@pytest.mark.parametrize("older", [False, True])
@pytest.mark.parametrize("n", range(1, 11))
def test_requirement_runs(spark, smoke_dir, n, older):
    args = types.SimpleNamespace(
        k=10, older=older, star=True, data_dir=smoke_dir, user_id=18, age=1
    )
    results = runner.requirement(n, star_tables(spark, smoke_dir), args, spark)
    assert results
    for title, df in results:
        assert title and df.columns
        df.limit(3).collect()
