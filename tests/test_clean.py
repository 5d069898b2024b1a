import datetime as dt

from tunelake import schemas as S
from tunelake.operators import clean as C
from tunelake.sources import readers, sinks

from conftest import rows

TRACK_COLS = [s.source for s in S.TRACKS_SPEC]


def _tracks(spark, data):
    return spark.createDataFrame(data, S.raw_string_schema(S.TRACKS_SPEC))


def _track(track_id, name, artist="A", popularity="50", duration="200000", explicit="true", dance="0.5"):
    row = dict.fromkeys(TRACK_COLS, None)
    row.update(track_id=track_id, track_name=name, artists=artist, album_name="alb", popularity=popularity,
               duration_ms=duration, explicit=explicit, danceability=dance, energy="0.1", key="3",
               loudness="-5.0", mode="1", speechiness="0.1", acousticness="0.2", instrumentalness="0.0",
               liveness="0.1", valence="0.3", tempo="120.0")
    return tuple(row[c] for c in TRACK_COLS)


def test_format_tracks_casts_and_drops_null_keys(spark):
    raw = _tracks(spark, [_track("t1", "Song"), _track(None, "x"), _track("t3", None),
                          _track("t4", "Bad", popularity="x", duration="", dance="?"),
                          _track("t5", "Dec", popularity="3.7")])
    out = C.format_tracks(raw)
    assert [f.name for f in out.schema.fields] == [s.target for s in S.TRACKS_SPEC]
    assert dict(out.dtypes)["popularity"] == "int" and dict(out.dtypes)["duration_ms"] == "bigint"
    got = {r["track_id"]: r for r in out.collect()}
    assert set(got) == {"t1", "t4", "t5"}
    assert got["t4"]["popularity"] is None and got["t4"]["duration_ms"] is None
    assert got["t4"]["danceability"] is None
    assert got["t5"]["popularity"] == 3
    assert got["t1"]["explicit"] is True


def test_format_tracks_strict_names(spark):
    raw = _tracks(spark, [_track("t1", "  My SONG ", artist=" The BAND ")])
    out = C.format_tracks(raw, lower_names=True).first()
    assert (out["track_name"], out["artist_name"]) == ("my song", "the band")


def _chart(spark, rows_):
    return spark.createDataFrame(rows_, S.raw_string_schema(S.CHARTS_SPEC))


def _chart_row(sid, name, rank="1", country="ES", date="2024-01-05", popularity="80", release="2023-12-01"):
    vals = {c.source: None for c in S.CHARTS_SPEC}
    vals.update(spotify_id=sid, name=name, artists="A", daily_rank=rank, country=country,
                snapshot_date=date, popularity=popularity, duration_ms="1000", album_release_date=release,
                acousticness=None, tempo="120.0")
    return tuple(vals[c.source] for c in S.CHARTS_SPEC)


def test_format_charts_fill_dates_country(spark):
    raw = _chart(spark, [
        _chart_row("a", "s1", rank=None, country="  es ", date="2024-01-05"),
        _chart_row("b", "s2", rank="x", country="u  s", date="2024"),
        _chart_row("c", "s3", country=None, date="junk", popularity="3.7"),
        _chart_row("d", None),
    ])
    out = {r["spotify_id"]: r for r in C.format_charts(raw).collect()}
    assert set(out) == {"a", "b", "c"}  # null title dropped
    a, b, c = out["a"], out["b"], out["c"]
    assert a["daily_rank"] == 0 and b["daily_rank"] == 0  # S15: fill after cast
    assert a["acousticness"] == 0.0 and a["tempo"] == 120.0
    assert a["country"] == "ES" and b["country"] == "U S" and c["country"] is None
    assert a["snapshot_date"] == dt.date(2024, 1, 5)
    assert (a["snapshot_year"], a["snapshot_month"], a["snapshot_day"]) == (2024, 1, 5)
    assert b["snapshot_date"] is None and b["snapshot_year"] is None
    assert c["popularity"] == 3
    assert a["album_release_date"] == dt.date(2023, 12, 1)


def test_format_charts_strict_variant_keeps_nulls(spark):
    raw = _chart(spark, [_chart_row("a", "s1", rank=None, country=" es ")])
    r = C.format_charts(raw, fill=None, country_col=None).first()
    assert r["daily_rank"] is None and r["country"] == " es "


def test_lyrics_csv_multiline_quotes_roundtrip(spark, tmp_dir):
    # SRC2: quoted multi-line text with "" escapes, read with the text reader.
    path = f"{tmp_dir}/lyrics.csv"
    with open(path, "w", encoding="utf-8") as fh:
        fh.write('Unnamed: 0,artist,song_name,lyrics\n')
        fh.write('1, Some Artist Lyrics ,  Song ,"line one\nline ""two""\n  indented"\n')
        fh.write('x,B,T,"short"\n')
        fh.write('3,C,,"no title"\n')
    raw = readers.read_text_csv(spark, path, schema=S.raw_string_schema(S.LYRICS_TEXT_SPEC))
    out = C.format_lyrics(raw)
    got = rows(out)
    assert got == [(1, "Some Artist Lyrics", "Song", 'line one\nline "two"\n  indented')]


def test_csv_sink_keeps_text_exact(spark, tmp_dir):
    df = spark.createDataFrame([(1, '  lead and trail  '), (2, 'q "x",\r\ny'), (3, None)], "id int, t string")
    sinks.write_csv(df, f"{tmp_dir}/out")
    back = readers.read_text_csv(spark, f"{tmp_dir}/out", schema=df.schema)
    assert rows(back) == rows(df)


def test_format_tracks_optional_accent_folding(spark):
    raw = _tracks(spark, [_track("t1", " Canción ", artist="Beyoncé")])
    plain = C.format_tracks(raw, lower_names=True).first()
    folded = C.format_tracks(raw, lower_names=True, fold_names=True).first()
    assert (plain["track_name"], plain["artist_name"]) == ("canción", "beyoncé")
    assert (folded["track_name"], folded["artist_name"]) == ("cancion", "beyonce")
