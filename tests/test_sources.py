import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tunelake.operators.copies import unfold
from tunelake.sources import manifest, readers, sinks
from tunelake.streaming.refresh import bootstrap_if_missing


def test_dispatch_routes_and_skips():
    paths = ["/l/top-spotify-songs-by-country.csv", "/l/spotify-tracks-dataset.csv",
             "/l/songs-lyrics.csv", "/l/songs_details.csv", "/l/unknown.csv",
             "/l/top-spotify-songs-by-country-2.csv"]
    routed = manifest.dispatch(paths)
    assert routed["top-spotify-songs-by-country"] == [paths[0], paths[5]]
    assert routed["spotify-tracks-dataset"] == [paths[1]]
    assert routed["songs-lyrics"] == [paths[2]]
    assert sum(len(v) for v in routed.values()) == 4


def test_refresh_manifest_filter():
    assert [s.name for s in manifest.datasets_to_refresh(update=True)] == ["top-spotify-songs-by-country"]
    assert len(manifest.datasets_to_refresh(update=False)) == 3


def test_zone_layout_single_level():
    z = manifest.ZoneLayout("/data")
    assert z.analytics("top_artists") == "/data/analytics/top_artists"


def test_read_with_fallback_and_renames(spark, tmp_dir):
    landing = f"{tmp_dir}/landing/songs-lyrics"
    spark.createDataFrame([("a", "l")], "artist string, lyrics string").write.parquet(landing)
    df, used = readers.read_with_fallback(spark, [f"{tmp_dir}/trusted/songs-lyrics", landing],
                                          [None, {"artist": "artist_name", "lyrics": "song_lyrics"}])
    assert used == landing and df.columns == ["artist_name", "song_lyrics"]
    with pytest.raises(FileNotFoundError):
        readers.read_with_fallback(spark, [f"{tmp_dir}/nope"])


def test_write_if_rows_and_parquet_partitioned(spark, tmp_dir):
    empty = spark.createDataFrame([], "a int")
    assert sinks.write_if_rows(empty, f"{tmp_dir}/e") == 0 and not os.path.exists(f"{tmp_dir}/e")
    assert sinks.write_if_rows(empty, None) == 0
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a int, p string")
    assert sinks.write_if_rows(df, f"{tmp_dir}/w", fmt="parquet") == 2
    sinks.write_parquet(df, f"{tmp_dir}/part", partition_by=["p"])
    assert {"p=x", "p=y"} <= set(os.listdir(f"{tmp_dir}/part"))


def test_bootstrap(spark, tmp_dir):
    src = f"{tmp_dir}/in.csv"
    with open(src, "w") as fh:
        fh.write("a,b\n1,x\n")
    calls = []
    dst = f"{tmp_dir}/out"
    assert bootstrap_if_missing(spark, dst, lambda: calls.append(
        sinks.write_parquet(readers.read_csv_by_name(spark, [src], [["b"]]), dst)))
    assert not bootstrap_if_missing(spark, dst, lambda: calls.append(1))
    assert calls == [dst]
    assert spark.read.parquet(dst).count() == 1


def test_partitioned_overwrite_static_vs_dynamic(spark, tmp_dir):
    first = spark.createDataFrame([(1, "d1"), (2, "d2")], "a int, p string")
    second = spark.createDataFrame([(3, "d2")], "a int, p string")
    sinks.write_parquet(first, f"{tmp_dir}/s", partition_by=["p"])
    sinks.write_parquet(second, f"{tmp_dir}/s", partition_by=["p"])                 # full rebuild
    assert sorted(r["a"] for r in spark.read.parquet(f"{tmp_dir}/s").collect()) == [3]
    sinks.write_parquet(first, f"{tmp_dir}/d", partition_by=["p"])
    sinks.write_parquet(second, f"{tmp_dir}/d", partition_by=["p"], replace_partitions="dynamic")
    assert sorted(r["a"] for r in spark.read.parquet(f"{tmp_dir}/d").collect()) == [1, 3]


def test_preview_text_cuts_as_the_console_does(spark):
    df = spark.createDataFrame([("x" * 21, None), ("y" * 20, 3)], "`a.b` string, n int")
    assert [tuple(r) for r in sinks.preview_text(df.orderBy(F.asc_nulls_first("n"))).collect()] == [("x" * 17 + "...", "NULL"), ("y" * 20, "3")]
    assert sinks.preview_text(df.orderBy(F.desc("n")), 1, truncate=2).first()[0] == "yy"
    assert [tuple(r) for r in sinks.schema_table(df).orderBy("place").collect()] == [(1, "a.b", "string"), (2, "n", "int")]


ODD_FIELDS = [('say "hi"', " lead, and trail ", 1, 0.1), ("", None, None, None), ("back\\slash", "tab\tü\u2028\u0085", -5, float("nan")),
              ("#c", "'", 7, 1e300), (None, "", 0, -0.0), (" ", '"', 2**31 - 1, 1e-5), (None, None, None, None)]


def _csv_files(path):
    return [f for f in os.listdir(path) if not f.startswith(("_", "."))]


@pytest.mark.parametrize("more, by_lines", [([], True), ([("two\nlines", "cr\r", 1, 1.0)], False), ([("\0", "x", 1, 1.0)], False)])
@pytest.mark.parametrize("compression", ["none", "lz4"])
def test_folded_rows_are_written_as_the_plain_ones(spark, tmp_dir, more, by_lines, compression):
    fields = [*ODD_FIELDS, *more]
    folded = spark.createDataFrame([(*f, n) for f, n in zip(fields, [1, 2, 5000, 3, 20000, 4097, 4, 3])], "a string, `b.c` string, n int, d double, __copies bigint")
    plain = sinks.write_csv(unfold(folded), f"{tmp_dir}/plain")
    rows = sinks.write_if_rows(folded, f"{tmp_dir}/folded", copies="__copies", compression=compression)
    assert rows == sum(r["__copies"] for r in folded.collect())
    names = _csv_files(f"{tmp_dir}/folded")
    end = ".csv" + {"none": "", "lz4": ".lz4"}[compression]
    assert names and all(n.endswith(".lines" + end if by_lines else end) and (".lines" in n) == by_lines for n in names)
    assert readers.by_lines(spark, f"{tmp_dir}/folded") == by_lines and not readers.by_lines(spark, plain)
    schema = folded.drop("__copies").schema

    def counted(path, **how):
        back = readers.read_text_csv(spark, path, **how)
        assert back.columns == ["a", "b.c", "n", "d"]
        return Counter(repr(tuple(r)) for r in back.groupBy(*[f"`{c}`" for c in back.columns]).count().collect())

    assert counted(f"{tmp_dir}/folded", schema=schema) == counted(plain, schema=schema)
    assert counted(f"{tmp_dir}/folded") == counted(plain)
    assert readers.read_text_csv(spark, f"{tmp_dir}/folded").count() == readers.read_text_csv(spark, plain).count()
    if compression == "none":  # byte for byte, with a header in every file that has rows
        def lines(path):
            texts = [open(f"{path}/{f}", newline="", encoding="utf-8").read() for f in _csv_files(path)]
            assert all(t.startswith("a,b.c,n,d\n") and t.endswith("\n") for t in texts if t)
            return Counter(line for t in texts for line in t.split("\n")[1:-1])
        assert lines(f"{tmp_dir}/folded") == lines(plain)


def test_one_row_with_millions_of_copies_is_dealt_and_written_in_blocks(spark, tmp_dir):
    folded = spark.createDataFrame([("x", 1, 20_000_000), ("y", 2, 1)], "a string, b int, __copies bigint")
    assert sinks.write_if_rows(folded, f"{tmp_dir}/t", copies="__copies", compression="lz4") == 20_000_001
    sizes = [os.path.getsize(f"{tmp_dir}/t/{f}") for f in _csv_files(f"{tmp_dir}/t")]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes) and sum(sizes) < 1_000_000
    back = readers.read_text_csv(spark, f"{tmp_dir}/t").groupBy("a").count().collect()
    assert {tuple(r) for r in back} == {("x", 20_000_000), ("y", 1)}


def test_folded_table_without_rows_or_with_fewer_rows_than_tasks(spark, tmp_dir):
    none = spark.createDataFrame([], "a string, b int, __copies bigint")
    assert sinks.write_if_rows(none, f"{tmp_dir}/e", copies="__copies") == 0 and not os.path.exists(f"{tmp_dir}/e")
    for i in range(6):  # whichever tasks get the row
        one = spark.createDataFrame([(str(i), None, 1)], "a string, b int, __copies bigint")
        assert sinks.write_if_rows(one, f"{tmp_dir}/o", copies="__copies", compression="lz4") == 1
        assert [r["a"] for r in readers.read_text_csv(spark, f"{tmp_dir}/o").collect()] == [str(i)]
    sinks.write_csv(one.select("a", "b"), f"{tmp_dir}/o", mode="append")  # a file that says nothing about its rows
    assert not readers.by_lines(spark, f"{tmp_dir}/o") and readers.read_text_csv(spark, f"{tmp_dir}/o").count() == 2
