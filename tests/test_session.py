from tunelake.session import ensure_checkpoint_dir, shared_dir


def test_shared_dir_uses_cluster_checkpoint_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a != b                                   # a fresh folder per call
    assert a.startswith(base.rstrip("/") + "/tunelake/x/")
    assert ensure_checkpoint_dir(spark)


def test_checkpoint_cuts_lineage(spark):
    ensure_checkpoint_dir(spark)
    df = spark.range(100).selectExpr("id % 7 AS k").groupBy("k").count().checkpoint()
    assert df.count() == 7
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
