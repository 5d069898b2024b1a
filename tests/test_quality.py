import datetime as dt

from pyspark.sql import functions as F

from tunelake.operators import quality as Q

from conftest import plan_text, rows

D = dt.date(2024, 1, 5)
SCHEMA = ("spotify_id string, track_name string, artist_name string, daily_rank int, country string, "
          "snapshot_date date, popularity int, duration_ms bigint, danceability string, energy string, "
          "acousticness double, valence double, tempo double")


def _chart(spark, data):
    full = [r + (None,) * (13 - len(r)) for r in data]
    return spark.createDataFrame(full, SCHEMA)


def test_unique_chart_slot_keeps_first_title_deterministically(spark):
    df = _chart(spark, [("b", "Beta", "A", 1, "ES", D), ("a", "Alpha", "A", 1, "ES", D),
                        ("c", "Alpha", "Z", 1, "ES", D), ("d", "Gamma", "A", 2, "ES", D)])
    out = Q.unique_chart_slot(df)
    # rank 1 has two "Alpha" rows: the tie-break (remaining columns) picks spotify_id "a".
    assert rows(out, "spotify_id") == [("a",), ("d",)]
    assert rows(Q.unique_chart_slot(df.repartition(7)), "spotify_id") == [("a",), ("d",)]


def test_trust_charts_order_of_constraints_and_invariants(spark):
    df = _chart(spark, [("a", "T", "A", 1, "ES", D), ("b", "T", "A", 2, "ES", D),
                        ("c", "U", "A", 2, "ES", D), ("d", None, "A", 3, "ES", D),
                        ("e", "T", "A", 1, "FR", D)])
    out = Q.trust_charts(df)
    # WIN2 keeps a (rank1), b (rank2, T < U); WIN3 then drops b (same artist/title/date/country as a).
    assert rows(out, "spotify_id") == [("a",), ("e",)]
    for keys in (["snapshot_date", "country", "daily_rank"],
                 ["artist_name", "country", "track_name", "snapshot_date"]):
        assert Q.constraint_key_violations(out, keys).count() == 0
    assert rows(Q.trust_charts(df, colocate=True), "spotify_id") == [("a",), ("e",)]


def test_keep_first_plan_uses_partial_group_limit(spark):
    df = _chart(spark, [("a", "T", "A", 1, "ES", D)])
    assert "WindowGroupLimit" in plan_text(Q.unique_chart_slot(df))


def test_trust_tracks_min_duration_and_required(spark):
    schema = "track_id string, track_name string, artist_name string, explicit boolean, duration_ms bigint"
    df = spark.createDataFrame([("1", "a", "x", True, 29999), ("2", "b", "x", False, 30000),
                                ("3", "c", "x", True, None), ("4", None, "x", True, 40000),
                                ("5", "e", "x", None, 40000)], schema)
    out = Q.trust_tracks(df, columns=df.columns)
    assert rows(out, "track_id") == [("2",)]


def test_trust_lyrics_unique_id_first_by_artist(spark):
    schema = "song_id int, artist_name string, track_name string, song_lyrics string"
    df = spark.createDataFrame([(1, "B", "t", "l1"), (1, "A", "t", "l2"), (2, "C", "t", "l3"),
                                (3, "D", None, "l4")], schema)
    out = Q.trust_lyrics(df)
    assert rows(out, "song_id", "artist_name") == [(1, "A"), (2, "C")]


def test_violation_report_balances(spark):
    df = _chart(spark, [("a", "T", "A", 1, "ES", D), ("b", "T", "A", 2, "ES", D),
                        ("c", "U", "A", 2, "ES", D)])
    rep = Q.violation_report(df, [("slot", Q.unique_chart_slot), ("title", Q.unique_artist_title)])
    got = rows(rep, "step", "constraint_name", "rows_in", "rows_kept", "rows_removed")
    assert got == [(1, "slot", 3, 2, 1), (2, "title", 2, 1, 1)]


def test_observe_counts_in_the_write_pass(spark, tmp_dir):
    df = spark.range(10).withColumn("k", F.col("id") % 3)
    before, o1 = Q.observe_counts(df, "before")
    after, o2 = Q.observe_counts(before.filter("k = 0"), "after")
    after.write.parquet(f"{tmp_dir}/obs")
    assert Q.removed_rows(o1, o2) == 6


def test_colocated_trust_charts_uses_one_hash_exchange(spark):
    df = _chart(spark, [("a", "T", "A", 1, "ES", D)])
    plan = plan_text(Q.trust_charts(df, colocate=True))
    assert plan.count("Exchange hashpartitioning") == 1
    plan2 = plan_text(Q.trust_charts(df))
    assert plan2.count("Exchange hashpartitioning") == 2


def test_trusted_output_is_subset_of_input(spark):
    df = _chart(spark, [("a", "T", "A", 1, "ES", D), ("b", "T", "A", 1, "ES", D), ("c", "U", "B", 2, "ES", D)])
    out = Q.trust_charts(df)
    assert out.exceptAll(df.select(*out.columns)).count() == 0


def test_observed_chain_counts_each_step_in_one_write(spark, tmp_dir):
    df = _chart(spark, [("a", "T", "A", 1, "ES", D), ("b", "T", "A", 2, "ES", D),
                        ("c", "U", "A", 2, "ES", D), ("d", "V", "B", 3, "ES", D)])
    out, marks = Q.observed_chain(df, [("slot", Q.unique_chart_slot), ("title", Q.unique_artist_title)])
    out.write.parquet(f"{tmp_dir}/chain")
    got = [(name, b.get["rows"], a.get["rows"]) for name, b, a in marks]
    assert got == [("slot", 4, 3), ("title", 3, 2)]


def test_violation_report_equals_the_chain(spark):
    import random
    rng = random.Random(3)
    some = lambda *v: rng.choice([None, *v])
    data = [(f"s{k}", some("T", "U", "V"), some("A", "B"), some(1, 2, 3), some("ES", "FR"), some("2024-01-01", "2024-01-02"), k % 4)
            for k in range(300)] + [("hot", "T", "A", 1, "ES", "2024-01-01", 9)] * 150
    df = spark.createDataFrame(data, "spotify_id string, track_name string, artist_name string, daily_rank int, country string, "
                                     "snapshot_date string, popularity int")
    steps = [("named", Q.Where("track_name is not null")), ("slot", Q.unique_chart_slot), ("popular", Q.Where("popularity > 0")),
             ("title", Q.unique_artist_title), ("again", Q.Unique(("artist_name",), ("popularity",)))]
    want, current = [], df
    for k, (name, step) in enumerate(steps, start=1):
        after = step(current)
        n, m = current.count(), after.count()
        want.append((k, name, n, m, n - m))
        current = after
    report = Q.violation_report(df, steps)
    assert sorted(map(tuple, report.collect())) == want
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1 and "Window" not in plan
    assert sorted(map(tuple, Q.violation_report(df.limit(0), steps).collect())) == [(k, n, 0, 0, 0) for k, (n, _) in enumerate(steps, start=1)]


def test_violation_report_wants_declared_constraints(spark):
    import pytest
    with pytest.raises(TypeError):
        Q.violation_report(spark.range(3), [("x", lambda df: df)])
