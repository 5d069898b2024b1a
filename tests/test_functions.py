import datetime as dt

from pyspark.sql import functions as F

from tunelake.functions import (fold_accents, hash_order_key, lenient_cast, normalise_country, parse_date,
                                remove_literal, song_key, stable_bucket, strip_special)


def test_lenient_int_keeps_non_ansi_truncation(spark):
    # S1: bad text -> NULL, decimal text -> integral part, plain ints pass.
    df = spark.createDataFrame([("5",), (" 7 ",), ("3.7",), ("-2.",), ("x",), ("",), (None,), ("1e3",)],
                               "s string")
    got = [r[0] for r in df.select(lenient_cast("s", "int")).collect()]
    assert got == [5, 7, 3, -2, None, None, None, None]


def test_lenient_double_and_bool(spark):
    df = spark.createDataFrame([("1.5", "true"), ("bad", "maybe"), (None, None)], "d string, b string")
    got = df.select(lenient_cast("d", "double"), lenient_cast("b", "boolean")).collect()
    assert [tuple(r) for r in got] == [(1.5, True), (None, None), (None, None)]


def test_parse_date_partial_and_junk_are_null(spark):
    # S2
    df = spark.createDataFrame([("2024-01-05",), ("2024",), ("2024-1-5",), ("junk",), (None,)], "s string")
    got = [r[0] for r in df.select(parse_date("s")).collect()]
    assert got == [dt.date(2024, 1, 5), None, None, None, None]


def test_strip_special_is_unicode_aware(spark):
    # S9: letters of any script, digits (incl. superscripts), _ - ( ) and
    # whitespace survive; punctuation and symbols go; NULL -> ''.
    df = spark.createDataFrame([("Señor! ñandú—日本 (x)-_ 1²",), (None,), ("a b—c",)], "s string")
    got = [r[0] for r in df.select(strip_special("s")).collect()]
    assert got == ["Señor ñandú日本 (x)-_ 1²", "", "a bc"]


def test_country_normalisation_and_trim_spaces_only(spark):
    # FN1/FN3/FN4 and S10 (trim removes spaces, not tabs).
    df = spark.createDataFrame([("  es ",), ("u  s",), ("\tfr\t",), (None,)], "c string")
    got = [r[0] for r in df.select(normalise_country("c")).collect()]
    assert got == ["ES", "U S", "FR", None]
    assert df.select(F.trim(F.lit("\ta\t"))).first()[0] == "\ta\t"


def test_remove_literal_is_unanchored(spark):
    # S14: every occurrence goes, the text is literal (not a regex).
    df = spark.createDataFrame([("X Lyrics",), ("Lyrics Lyrics Y",), ("A.B Lyrics.",)], "a string")
    got = [r[0] for r in df.select(remove_literal("a", " Lyrics")).collect()]
    assert got == ["X", "Lyrics Y", "A.B."]


def test_fold_accents(spark):
    df = spark.createDataFrame([("Señor ñandú é",), ("plain",), (None,)], "s string")
    got = [r[0] for r in df.select(fold_accents("s")).collect()]
    assert got == ["Senor nandu e", "plain", None]


def test_song_key(spark):
    df = spark.createDataFrame([("t", "a")], "t string, a string")
    assert df.select(song_key("t", "a")).first()[0] == "t - a"


def test_stable_bucket_matches_reference_arithmetic(spark):
    import hashlib
    df = spark.range(200).select(F.col("id"), stable_bucket("id", 42, 100).alias("b"),
                                 hash_order_key("id", 42).alias("k"))
    for r in df.collect():
        h = hashlib.md5(f"42:{r['id']}".encode()).hexdigest()
        assert r["k"] == h
        assert r["b"] == int(h[:8], 16) % 100
