import datetime as dt

from tunelake.session import shared_dir
from tunelake.streaming import refresh

from conftest import plan_text, rows

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
SCHEMA = "spotify_id string, track_name string, artist_name string, daily_rank int, country string, snapshot_date date"


def test_refresh_equals_batch_and_replay_is_idempotent(spark):
    data = [("a", "T", "A", 1, "ES", D1), ("b", "U", "A", 1, "ES", D1), ("c", "T", "A", 2, "ES", D1),
            ("d", "V", "B", 1, "ES", D2), ("e", "V", "B", 2, "ES", D2), ("f", "W", "C", 1, "FR", D2),
            ("g", "X", "C", 1, "FR", None), ("h", "Y", "C", 1, "FR", None)]
    df = spark.createDataFrame(data, SCHEMA)
    got = refresh.replay_refresh(spark, df, deliveries=3)
    assert rows(got) == rows(refresh.trusted_rebuild(df))

    root = shared_dir(spark, "refresh-test")
    landing, bronze, silver, ckpt = (f"{root}/{p}" for p in ("landing", "bronze", "silver", "ckpt"))
    df.filter("spotify_id < 'c'").write.mode("append").parquet(landing)
    refresh.refresh_charts(spark, landing, bronze, silver, ckpt, df.schema)
    first = rows(refresh.read_silver(spark, silver, df.schema))
    refresh.refresh_charts(spark, landing, bronze, silver, ckpt, df.schema)   # nothing new
    assert rows(refresh.read_silver(spark, silver, df.schema)) == first
    df.filter("spotify_id >= 'c'").write.mode("append").parquet(landing)      # late rows for D1 too
    refresh.refresh_charts(spark, landing, bronze, silver, ckpt, df.schema)
    assert rows(refresh.read_silver(spark, silver, df.schema)) == rows(refresh.trusted_rebuild(df))


def test_dates_and_entries_go_to_the_rows_whatever_their_estimated_size(spark, tmp_dir):
    entry = spark.createDataFrame([("/f", 1, 1, "x", "r1"), ("/g", 1, 1, "x", "r1")], refresh.ENTRY)
    later = spark.createDataFrame([("/g", 1, 2, "y", "r2")], refresh.ENTRY)
    table = spark.createDataFrame(
        [("/f", "r1", "a", D1), ("/g", "r1", "b", D2), ("/g", "r1", "c", None), ("/g", "r2", "d", D1)],
        "__file string, __run string, title string, snapshot_date date")
    book, out, plans = f"{tmp_dir}/book", f"{tmp_dir}/out", []

    def rebuild(df):
        plans.append(plan_text(df))
        return df

    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if every scan were large
    try:
        touched = []
        for entries in (entry, later):
            entries.coalesce(1).write.mode("append").json(book)
            touched.append(refresh.refresh_versions(
                spark, book, lambda e: table.join(e, [table["__file"] == e["file"], table["__run"] == e["run"]]).select(table["*"]),
                f"{tmp_dir}/state", {out: rebuild}))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert touched == [3, 3] and len(plans) == 2
    assert not any("SortMergeJoin" in p for p in plans) and all("Exchange hashpartitioning" not in p.split("BroadcastHashJoin")[0] for p in plans)
    assert rows(spark.read.parquet(out), "title", "snapshot_date") == [("a", D1), ("d", D1)]
