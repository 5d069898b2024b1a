"""Hot-key behaviour: one key holds a third of all rows. Results must stay
whole and exact, and the plans must reduce the hot key before shuffling."""

from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tunelake.operators import analysis as A
from tunelake.operators import ml as M
from tunelake.operators import quality as Q

from conftest import plan_text

N = 30000


def _skewed(spark):
    # key 0 holds a third of the rows; the rest spread over 1000 keys.
    return (spark.range(N)
                 .withColumn("key", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1))
                 .withColumn("val", (F.col("id") * 7919 % 10007).cast("int"))
                 .withColumn("label", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 2).cast("int")))


def test_keep_first_hot_key_exact_and_partial_limit(spark):
    df = _skewed(spark)
    out = Q.keep_first(df, ["key"], ["val"])
    got = {r["key"]: (r["val"], r["id"]) for r in out.collect()}
    best = {}
    for r in df.collect():
        cand = (r["val"], r["id"])
        if r["key"] not in best or cand < best[r["key"]]:
            best[r["key"]] = cand
    assert got == best
    plan = plan_text(out)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_group_counts_hot_key_partial_aggregate(spark):
    df = _skewed(spark)
    out = A.entries_by(df, "key", "val", "n", "d", top=None)
    got = {r["key"]: (r["n"], r["d"]) for r in out.collect()}
    rows_ = df.select("key", "val").collect()
    n, d = Counter(r["key"] for r in rows_), defaultdict(set)
    for r in rows_:
        d[r["key"]].add(r["val"])
    assert got == {k: (n[k], len(d[k])) for k in n}
    assert "partial_count" in plan_text(out)


def test_oversample_hot_class_is_exact(spark):
    df = _skewed(spark).select("id", "label")
    out = M.oversample(df, "label", id_col="id", bucket_rows=200)
    sizes = Counter(r["label"] for r in out.select("label").collect())
    before = Counter(r["label"] for r in df.select("label").collect())
    assert sizes == {c: max(before.values()) for c in before}
    per_id = Counter(r["id"] for r in out.select("id").collect())
    assert set(per_id) == {r["id"] for r in df.select("id").collect()}     # nobody dropped


def test_pre_aggregate_join_equals_plain_join(spark):
    facts = _skewed(spark).select("key", "val")
    dims = spark.range(1001).select(F.col("id").alias("k"), (F.col("id") % 7).cast("string").alias("grp"))
    plain = A.entries_by(facts.join(dims, facts.key == dims.k), "grp", "key", "n", "d", top=None)
    pre = A.pre_aggregate(facts, ["key"])
    fast = A.entries_by(pre.join(dims, pre.key == dims.k), "grp", "key", "n", "d", top=None, weight_col="__rows")
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, fast.collect()))


def test_top_per_group_hot_group(spark):
    df = _skewed(spark).withColumnRenamed("key", "country").withColumnRenamed("val", "daily_rank") \
        .withColumn("track_name", F.col("id").cast("string")).withColumn("artist_name", F.lit("a"))
    out = A.top_per_group(df)
    hot = [r for r in out.collect() if r["country"] == 0]
    vals = sorted({r["daily_rank"] for r in df.filter("country = 0").collect()})[:5]
    assert sorted({r["daily_rank"] for r in hot}) == vals
    assert len(hot) == df.filter(F.col("country") == 0).filter(F.col("daily_rank").isin(vals)).count()
    # no exchange that carries whole rows is keyed by the group alone
    big = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        df.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        exchanges = [line for line in plan_text(A.top_per_group(df)).splitlines() if "hashpartitioning(" in line]
    finally:
        df.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", big)
    whole = [line for line in exchanges if "__key0" not in line]
    assert exchanges and whole and all("daily_rank" in line for line in whole)
