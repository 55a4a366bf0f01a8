from strata.session import MIN_PARTITION_SIZE_KEY, apply_query_defaults, checkpoint_root, scale_conf


def test_scale_conf_sizes_by_volume_and_cores():
    c = scale_conf(100 * 2**40, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 << 20)
    assert int(scale_conf(1 << 20, 64)["spark.sql.shuffle.partitions"]) == 3 * 64


def test_query_defaults_pin_utc_and_keep_explicit_settings(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    spark.conf.set(MIN_PARTITION_SIZE_KEY, "2MB")
    apply_query_defaults(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get(MIN_PARTITION_SIZE_KEY) == "2MB"  # an explicit choice is kept
    spark.conf.set(MIN_PARTITION_SIZE_KEY, "64k")


def test_checkpoint_root_reads_the_session(spark):
    root = checkpoint_root(spark)
    ck = spark.sparkContext.getCheckpointDir()
    assert ck is not None and ck.rstrip("/").rsplit("/", 1)[0] == root
