from bursa.session import checkpoint_dir, get_session


def test_session_keeps_cluster_settings(spark):
    # the session exists (fixture); get_session returns it unchanged
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    assert get_session("local[2]", 3) is spark
    assert spark.conf.get("spark.sql.shuffle.partitions") == "7"
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_checkpoint_dir_is_read_from_the_session(spark):
    d = checkpoint_dir(spark)
    assert d and d == spark.conf.get("spark.checkpoint.dir")
