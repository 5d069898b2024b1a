import datetime as dt

from pyspark.sql import functions as F

from tunelake.operators import exploit as X

from conftest import rows

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
VIS = "track_name string, artist_name string, daily_rank int, snapshot_date date, country string"


def test_explicit_prediction_suffix_and_key_normalisation(spark):
    lyrics = spark.createDataFrame([("Band Lyrics", "Song", "la la"), ("Lyrics Lyrics Y", "S2", "x"),
                                    ("band", "song", "lower")],
                                   "artist_name string, song_name string, song_lyrics string")
    tracks = spark.createDataFrame([("Band", "Song", True), ("Lyrics Y", "S2", False)],
                                   "artist_name string, track_name string, explicit boolean")
    got = rows(X.explicit_prediction(lyrics, tracks))
    assert got == [("la la", True), ("x", False)]
    strict = spark.createDataFrame([("band", "song", True)], "artist_name string, track_name string, explicit boolean")
    assert X.explicit_prediction(lyrics, strict).count() == 1   # only the lower-case lyric row
    assert X.explicit_prediction(lyrics, strict, normalise_keys=True).count() == 2


def _vis(spark, data):
    return spark.createDataFrame(data, VIS)


def test_chart_history_grid_first_appearance_and_fill(spark):
    data = [("Señor!", "A", 1, D1, "ES"), ("B", "X", 2, D1, "ES"), ("Señor!", "A", 2, D2, "ES"),
            ("C", "Y", 1, D2, "ES"), ("D", "Z", 1, D2, "ES"),       # duplicate (date, rank): C wins
            ("E", "W", 16, D1, "ES"), ("F", "V", 1, D3, "FR"),    # out of slots / other country
            ("G", "U", 0, D3, "ES")]                              # rank 0 is outside the grid
    hist = X.chart_history(_vis(spark, data), "ES", "2024-01-01", "2024-01-03")
    out = hist.collect()
    assert len(out) == 3 * 15                     # every date present x 15 positions
    by = {(r["snapshot_date"], r["position"]): r for r in out}
    s = by[(D1, 1)]
    assert (s["track_name"], s["song_id"], s["rank_value"], s["is_new"]) == ("Señor", "Señor - A", 15, True)
    assert by[(D2, 2)]["first_appearance"] == D1 and by[(D2, 2)]["is_new"] is False
    assert by[(D2, 1)]["track_name"] == "C"
    empty = by[(D1, 3)]
    assert (empty["song_id"], empty["rank_value"], empty["first_appearance"], empty["is_new"]) == ("", 0, None, False)
    news = {}
    for r in out:
        if r["is_new"]:
            news[r["song_id"]] = news.get(r["song_id"], 0) + 1
    assert all(v == 1 for v in news.values())
    assert [r["snapshot_date"] for r in out] == sorted(r["snapshot_date"] for r in out)


def test_chart_history_range_ends_inclusive(spark):
    data = [("a", "x", 1, D1, "ES"), ("b", "x", 1, D3, "ES")]
    hist = X.chart_history(_vis(spark, data), "ES", D1.isoformat(), D3.isoformat())
    assert {r["snapshot_date"] for r in hist.collect()} == {D1, D3}


def _brute_new(pairs):
    dates = sorted({d for d, _ in pairs})
    present = {}
    for d, s in pairs:
        present.setdefault(d, set()).add(s)
    out = []
    for i in range(1, len(dates)):
        for s in present[dates[i]] - present[dates[i - 1]]:
            out.append((dates[i], s, dates[i - 1]))
    return sorted(out, key=repr)


def test_new_entries_against_brute_force(spark):
    pairs = [(D1, "a"), (D1, "b"), (D2, "a"), (D2, "c"), (D3, "b"), (D3, "c"), (D3, "c")]
    df = spark.createDataFrame(pairs + [(D2, "")], "snapshot_date date, song_id string")
    assert rows(X.new_entries(df)) == _brute_new(pairs)


def test_many_to_many_match_is_dealt_to_all_tasks(spark):
    # one key holds every row; NULL labels and NULL keys; more copies than a run
    lyrics = spark.range(30).selectExpr("'A' AS artist_name", "'x' AS song_name", "string(id) AS song_lyrics").unionByName(
        spark.createDataFrame([(None, "x", "n"), ("B", "y", "b")], "artist_name string, song_name string, song_lyrics string")).coalesce(1)
    tracks = spark.range(9_100).selectExpr(
        "if(id < 9000, 'A', null) AS artist_name", "'x' AS track_name", "CASE WHEN id < 5000 THEN true WHEN id < 8990 THEN false END AS explicit").unionByName(
        spark.createDataFrame([("B", "y", None)], "artist_name string, track_name string, explicit boolean")).coalesce(1)
    out = X.explicit_prediction(lyrics, tracks)
    assert out.columns == ["song_lyrics", "explicit"] and out.dtypes[1][1] == "boolean"
    got = {(r[0], r[1]): r[2] for r in out.groupBy("song_lyrics", "explicit").count().collect()}
    assert got == {("b", None): 1} | {(str(i), e): n for i in range(30) for e, n in ((True, 5000), (False, 3990), (None, 10))}
    sizes = [r[0] for r in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(sizes) >= 4 and max(sizes) < out.count() / 2
