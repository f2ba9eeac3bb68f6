import pytest

from reelscope.session import MB, scale_settings


TB = 1 << 40


def test_scale_settings_for_100_tb_on_a_large_cluster():
    s = scale_settings(100 * TB, total_cores=8000)
    split = int(s["spark.sql.files.maxPartitionBytes"])
    reducers = int(s["spark.sql.shuffle.partitions"])
    tasks = -(-100 * TB // split)
    assert tasks <= 100_000 and split <= 2048 * MB
    assert 16_000 <= reducers <= 25_000
    assert tasks * reducers / 8 < 512 * MB  # map statuses on the driver
    assert 10 * TB / reducers <= 512 * MB
    assert s["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == str(reducers)


def test_reducers_follow_the_bytes_that_move():
    few = scale_settings(100 * TB, 1000, shuffle_bytes=TB)
    many = scale_settings(100 * TB, 1000, shuffle_bytes=20 * TB)
    assert int(few["spark.sql.shuffle.partitions"]) == 2048
    assert int(many["spark.sql.shuffle.partitions"]) == 40960
    assert few["spark.sql.files.maxPartitionBytes"] == many["spark.sql.files.maxPartitionBytes"]


def test_scale_settings_small_input_keeps_two_waves():
    s = scale_settings(10 * MB, total_cores=8)
    assert s["spark.sql.shuffle.partitions"] == "16"
    assert s["spark.sql.files.maxPartitionBytes"] == str(128 * MB)


def test_tune_leaves_the_callers_settings_alone(spark):
    from reelscope.session import PLAN_DEFAULTS, tune

    assert "spark.sql.session.timeZone" not in PLAN_DEFAULTS
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "7m")
    try:
        assert tune(spark).conf.get(key) == "7m"
    finally:
        spark.conf.set(key, old)


def test_scale_settings_rejects_bad_input():
    with pytest.raises(ValueError):
        scale_settings(-1, 8)
    with pytest.raises(ValueError):
        scale_settings(1, 0)


def test_checkpoint_dir_comes_from_the_session(spark):
    from reelscope.session import ensure_checkpoint_dir

    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    got = ensure_checkpoint_dir(spark)
    if configured:
        assert got == configured
    else:
        assert got
