from revlens.session import ensure_checkpoint_dir, scale_conf


def test_no_checkpoint_folder_is_invented(spark):
    before = spark.sparkContext.getCheckpointDir()
    assert ensure_checkpoint_dir(spark) == before
    if "spark.checkpoint.dir" not in dict(spark.sparkContext.getConf().getAll()):
        assert spark.sparkContext.getCheckpointDir() == before


def test_scale_conf_sizes_partitions():
    conf = scale_conf(8 * 10**12, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == -(-8 * 10**12 // (256 * 1024 * 1024))
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    small = scale_conf(10**6, 16)
    assert int(small["spark.sql.shuffle.partitions"]) == 32  # never below 2 x cores
