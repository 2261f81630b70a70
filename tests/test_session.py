from hearth.session import ensure_checkpoint_dir, recommended_conf


def test_recommended_conf_scales_with_input():
    small, big = recommended_conf(1 << 30), recommended_conf(100 * (1 << 40))
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert int(big["spark.sql.shuffle.partitions"]) == 524288  # 100 TiB / 200 MiB
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert "spark.checkpoint.dir" not in big


def test_checkpoint_dir_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    d = ensure_checkpoint_dir(spark)
    if configured:
        assert d == configured
    assert spark.sparkContext.getCheckpointDir() is not None
    assert spark.range(3).checkpoint().count() == 3
