"""Session helpers: cluster settings and the checkpoint folder."""
from churnlens.session import MAX_SHUFFLE_PARTITIONS, ensure_checkpoint_dir, scale_conf


def test_scale_conf_bounds():
    tb = 1024 ** 4
    big = scale_conf(100 * tb, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == MAX_SHUFFLE_PARTITIONS
    small = scale_conf(1024 ** 3, 64)
    assert int(small["spark.sql.shuffle.partitions"]) == 3 * 64      # at least 3 waves
    mid = scale_conf(10 * tb, 1000)
    assert int(mid["spark.sql.shuffle.partitions"]) == 10 * tb // (256 * 1024 ** 2) + 1
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_checkpoint_dir_is_the_sessions(spark):
    d = ensure_checkpoint_dir(spark)
    assert d and d == ensure_checkpoint_dir(spark)                   # stable within a session
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:                                                    # a cluster-style setting wins
        assert d.startswith(configured.rstrip("/")) or configured.rstrip("/") in d
