import math

import pytest
from pyspark.sql import functions as F

from tunelake import schemas as S
from tunelake.operators import analysis as A

from conftest import plan_text, rows


def test_artist_popularity_min_group_size(spark):
    data = [("four", f"t{i}", 10) for i in range(4)] + [("five", f"u{i}", i) for i in range(5)]
    df = spark.createDataFrame(data, "artist_name string, track_id string, popularity int")
    out = A.artist_popularity(df)
    assert rows(out) == [("five", 2.0, 5)]


def test_round_is_half_up(spark):
    df = spark.createDataFrame([("a", f"t{i}", v) for i, v in enumerate([1.0, 1.0, 1.0, 1.0, 1.025])],
                               "artist_name string, track_id string, popularity double")
    assert A.artist_popularity(df, digits=3).first()["avg_popularity"] == 1.005


def test_entries_by_top_with_tie_break(spark):
    data = [(c, f"t{i}") for c in ["b", "a", "c"] for i in range(3)] + [("d", "x")]
    df = spark.createDataFrame(data, "country string, track_name string")
    out = A.top_countries_by_entries(df, top=2)
    assert [tuple(r) for r in out.collect()] == [("a", 3, 3), ("b", 3, 3)]


def test_top_per_group_keeps_all_dates_and_nulls_first(spark):
    # S5/S6: no date key, so every row of the best ranks over all dates stays;
    # a NULL rank sorts first.
    data = [("ES", "s1", "a", 1, "d1"), ("ES", "s2", "a", 1, "d2"), ("ES", "s3", "a", 2, "d1"),
            ("ES", "s4", "a", None, "d1")] + [("ES", f"x{i}", "a", 10 + i, "d1") for i in range(5)]
    df = spark.createDataFrame(data, "country string, track_name string, artist_name string, "
                                     "daily_rank int, snapshot_date string")
    out = A.top_per_group(df)
    got = {r["track_name"]: r["rank_in_country"] for r in out.collect()}
    assert got == {"s4": 1, "s1": 2, "s2": 2, "s3": 3, "x0": 4, "x1": 5}
    assert "s4" not in {r["track_name"] for r in A.top_per_group(df, min_order_value=1).collect()}
    assert len(A.top_per_group(df, per_snapshot=True).collect()) == 6


def _pearson(xs, ys):
    mx, my = sum(xs) / len(xs), sum(ys) / len(ys)
    cov = sum((x - mx) * (y - my) for x, y in zip(xs, ys))
    return cov / math.sqrt(sum((x - mx) ** 2 for x in xs) * sum((y - my) ** 2 for y in ys))


def test_correlations_null_modes_and_constant(spark):
    # S3 and S4.
    data = [(1.0, 2.0, 5.0), (2.0, None, 5.0), (3.0, 6.0, 5.0), (4.0, 8.1, 5.0)]
    df = spark.createDataFrame(data, "popularity double, f double, const double")
    skip = dict((r[0], r[1]) for r in A.feature_correlations(df, features=["f", "const"]).collect())
    zero = dict((r[0], r[1]) for r in A.feature_correlations(df, features=["f", "const"], nulls="zero")
                .collect())
    assert skip["const"] is None and zero["const"] is None
    assert skip["f"] == pytest.approx(_pearson([1.0, 3.0, 4.0], [2.0, 6.0, 8.1]), abs=1e-12)
    assert zero["f"] == pytest.approx(_pearson([1.0, 2.0, 3.0, 4.0], [2.0, 0.0, 6.0, 8.1]), abs=1e-12)


def test_correlations_single_aggregate(spark):
    df = spark.createDataFrame([(1.0,) * 10], ", ".join(["popularity double"] + [f"{f} double" for f in
                                                                                  S.AUDIO_FEATURES]))
    plan = plan_text(A.feature_correlations(df))
    assert plan.count("HashAggregate") + plan.count("ObjectHashAggregate") <= 2
    assert "Exchange SinglePartition" in plan or "Exchange" in plan


def test_rank_by_abs(spark):
    df = spark.createDataFrame([("a", -0.9), ("b", 0.5), ("c", None), ("d", 0.9)],
                               "feature string, correlation_with_popularity double")
    assert [r["feature"] for r in A.rank_by_abs(df).collect()] == ["a", "d", "b", "c"]


def test_top_rows_by_tie_at_cutoff_is_deterministic(spark):
    data = [(f"t{i:02d}", "a", 0.5 if i >= 8 else 0.9, i) for i in range(12)]
    df = spark.createDataFrame(data, "track_name string, artist_name string, danceability double, "
                                     "popularity int")
    out = A.top_rows_by(df, "danceability")
    assert out.columns == ["track_name", "artist_name", "danceability", "popularity"]
    assert [r["track_name"] for r in out.collect()][-2:] == ["t08", "t09"]
    assert "TakeOrderedAndProject" in plan_text(out)


def test_count_and_mean_by_skips_null_group_and_missing_column(spark):
    df = spark.createDataFrame([(2000, 10), (2000, 20), (None, 5)], "release_year int, popularity int")
    assert rows(A.count_and_mean_by(df)) == [(2000, 2, 15.0)]
    assert A.count_and_mean_by(df.drop("release_year")) is None
    assert A.trends_over_time(df) is None


def test_lyrics_tracks_join_semantics(spark):
    # S11: NULL keys never match, case sensitive, many-to-many.
    lyr = spark.createDataFrame([("A", "x"), ("A", "x"), ("a", "x"), (None, "x")],
                                "artist_name string, track_name string")
    cols = ["artist_name", "track_name", "popularity", *S.AUDIO_FEATURES]
    tr = spark.createDataFrame([("A", "x", 1, *[0.1] * 9), ("A", "x", 2, *[0.2] * 9),
                                (None, "x", 3, *[0.3] * 9)],
                               ", ".join(f"{c} {'int' if c == 'popularity' else 'string' if c in cols[:2] else 'double'}"
                                         for c in cols))
    out = A.lyrics_tracks_join(lyr, tr)
    assert out.count() == 4
    assert {r["lyrics_artist"] for r in out.collect()} == {"A"}
    obs_df, obs = A.with_match_count(out)
    obs_df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 4


def test_feature_means(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, None)], "danceability double, duration_ms double")
    r = A.feature_means(df, ["danceability", "duration_ms"]).first()
    assert (r["avg_danceability"], r["avg_duration_ms"]) == (2.0, 2.0)


def test_zero_mode_equals_dataframe_stat_corr(spark):
    # AGG7 reproduces DataFrame.stat.corr, which reads a NULL as 0.0.
    data = [(1.0, 2.0), (2.0, None), (None, 6.0), (4.0, 8.1), (5.0, 1.0), (6.0, None)]
    df = spark.createDataFrame(data, "popularity double, f double")
    ours = A.feature_correlations(df, features=["f"], nulls="zero").first()[1]
    assert ours == pytest.approx(df.stat.corr("popularity", "f"), abs=1e-12)


def test_skip_mode_equals_corr_aggregate(spark):
    from pyspark.sql import functions as F
    data = [(1.0, 2.0), (2.0, None), (None, 6.0), (4.0, 8.1), (5.0, 1.0), (6.0, 3.5)]
    df = spark.createDataFrame(data, "popularity double, f double")
    ours = A.feature_correlations(df, features=["f"], nulls="skip").first()[1]
    assert ours == pytest.approx(df.agg(F.corr("f", "popularity")).first()[0], abs=1e-12)


def test_both_null_policies_from_one_scan(spark):
    data = [(1.0, 2.0), (2.0, None), (None, 6.0), (4.0, 8.1), (5.0, 1.0)]
    df = spark.createDataFrame(data, "popularity double, f double")
    zero, skip, row = A.feature_correlations_both(df, features=["f"])
    assert zero.first()[1] == A.feature_correlations(df, features=["f"], nulls="zero").first()[1]
    assert skip.first()[1] == A.feature_correlations(df, features=["f"], nulls="skip").first()[1]
    row.unpersist()


def test_entries_by_approx_distinct_small_groups_exact(spark):
    data = [(c, f"t{i % (3 + j)}") for j, c in enumerate("abc") for i in range(20)]
    df = spark.createDataFrame(data, "country string, track_name string")
    exact = sorted(map(tuple, A.entries_by(df, "country", "track_name", "n", "d", top=None).collect()))
    approx = sorted(map(tuple, A.entries_by(df, "country", "track_name", "n", "d", top=None,
                                            approx=True).collect()))
    assert exact == approx == [("a", 20, 3), ("b", 20, 4), ("c", 20, 5)]


def test_numbered_counts_from_one_in_order_with_hot_and_null_keys(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(5)).when(F.col("id") % 7 != 0, F.col("id") % 11).alias("k"), "id")
    got = A.numbered(df, F.desc_nulls_last("k"), F.asc("id")).collect()
    rows_ = [(r["k"], r["id"]) for r in df.collect()]
    want = sorted(rows_, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [(r["k"], r["id"]) for r in sorted(got, key=lambda r: r["position"])] == want
    assert sorted(r["position"] for r in got) == list(range(1, 3001))


def test_numbered_equal_rows_empty_tables_and_odd_names(spark):
    df = spark.createDataFrame([("x", 1)] * 5, "`a.b` string, v int")
    out = A.numbered(df, F.asc("v"))
    assert out.columns == ["a.b", "v", "position"]
    assert sorted(r["position"] for r in out.collect()) == [1, 2, 3, 4, 5]
    assert A.numbered(df.filter("v > 1"), F.asc("v")).count() == 0


def test_numbered_uses_no_window_over_the_rows(spark):
    plan = plan_text(A.numbered(spark.range(1000), F.asc("id")))
    assert plan.count("Window ") <= 1 and "SinglePartition" in plan  # only the counts per range
    assert "partial_count" in plan
