from pyspark.sql import functions as F

from tunelake.llm import common


def test_fresh_names():
    assert common.fresh(["a", "KEPT", "kept_"], "kept") == "kept__"
    assert common.fresh([], "kept") == "kept"


def test_store_and_forget(spark):
    df = spark.range(10).withColumn("x", F.lit(None).cast("string"))
    kept, path = common.store_at(df, "test")
    assert kept.schema.names == ["id", "x"] and kept.count() == 10
    assert common.store(df.limit(0), "test").count() == 0
    common.forget(spark, path)
    p, fs = common.hadoop_path(spark, path)
    assert not fs.exists(p)


def test_join_by_id_keeps_rows_without_id(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "id long, t string")
    right = spark.createDataFrame([(1, 10), (None, 20)], "id long, v int")
    both = sorted(map(tuple, common.join_by_id(left, right, "id").collect()), key=str)
    assert both == [(1, "a", 10), (2, "c", None), (None, "b", None)]
    assert [r["id"] for r in common.join_by_id(left, right, "id", "left_semi").collect()] == [1]
    assert {r["id"] for r in common.join_by_id(left, right, "id", "left_anti").collect()} == {2, None}


def test_smallest_by_hash_is_bounded_and_stable(spark):
    rows = spark.range(5000)
    a = {r[0] for r in common.smallest_by_hash(rows, 1, "id", 100).collect()}
    b = {r[0] for r in common.smallest_by_hash(rows.repartition(7), 1, "id", 100).collect()}
    assert a == b and len(a) == 100
    assert common.smallest_by_hash(rows.limit(30), 1, "id", 100).count() == 30
    assert common.smallest_by_hash(rows.limit(0), 1, "id", 100).count() == 0


def test_smallest_by_hash_never_gives_fewer(spark):
    """Rows with the largest hashes of many, so that none is below a bound made from their number."""
    place = F.pmod(F.xxhash64(F.lit(3), "node"), F.lit(1 << 40))
    late = [r[0] for r in spark.range(3000).toDF("node").orderBy(place.desc()).limit(300).collect()]
    for size in (1, 5, 50, 300):
        rows = spark.createDataFrame([(i,) for i in late[:size]], "node long")
        for n in (1, 2, 40):
            got = [r[0] for r in common.smallest_by_hash(rows, 3, "node", n).collect()]
            assert got == late[:size][::-1][:n]
    same = spark.range(500).select(F.lit(7).alias("node"))
    assert common.smallest_by_hash(same, 3, "node", 2).count() == 2
