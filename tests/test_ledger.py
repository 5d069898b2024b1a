"""Landing ledger, raw chart refresh, first run, commit marks, safe publishing."""

import os
import shutil
import time

import pytest

from tunelake import schemas as S
from tunelake.plans import zones
from tunelake.sources import ledger, manifest, readers, sinks

from conftest import rows
from test_zones import _write_csv

CHARTS = zones.CHARTS
HEADER = [c.source for c in S.CHARTS_SPEC]


def chart(spotify_id, title, rank, date, country="es"):
    return [spotify_id, title, "Band", str(rank), "", "", country, date, "50", "False", "200000", "alb", "2023-05-01", "0.5", "0.5", "1",
            "-5", "1", "0.1", "0.1", "0.0", "0.1", "0.5", "120.0", "4.0"]


def deliver(root, name, charts, header=HEADER, age=0):
    os.makedirs(f"{root}/landing", exist_ok=True)
    path = f"{root}/landing/{CHARTS}{name}.csv"
    _write_csv(path, header, charts)
    if age:
        os.utime(path, (time.time() - age,) * 2)
    return path


def day(n, ranks=3):
    return [chart(f"d{n}r{r}", f"Song {n} {r}", r, f"2024-01-{n:02d}") for r in range(1, ranks + 1)]


def titles(spark, path):
    return sorted(r[0] for r in spark.read.parquet(path).select("track_name").collect())


def test_earlier_days_stay(spark, tmp_dir):
    """A copy whose CSV has gone, a newer CSV and one with an older stamp: all rows count."""
    layout = manifest.ZoneLayout(tmp_dir)
    first = deliver(tmp_dir, "-1", day(1))
    zones.landing_to_parquet(spark, layout)
    os.remove(first)
    deliver(tmp_dir, "-2", day(2))
    deliver(tmp_dir, "-0", day(3), age=10**6)
    zones.format_zone(spark, layout, update=True)
    assert titles(spark, layout.formatted(CHARTS)) == sorted(r[1] for n in (1, 2, 3) for r in day(n))
    zones.landing_to_parquet(spark, layout)
    zones.format_zone(spark, layout, update=True)
    assert titles(spark, layout.formatted(CHARTS)) == sorted(r[1] for n in (1, 2, 3) for r in day(n))


def test_files_delivered_again(spark, tmp_dir):
    layout = manifest.ZoneLayout(tmp_dir)
    path = deliver(tmp_dir, "", day(1))
    assert zones.landing_to_parquet(spark, layout).counts[CHARTS] == {"files": 1}
    os.utime(path, (time.time() + 7,) * 2)                       # touched: nothing new
    assert not zones.landing_to_parquet(spark, layout).written
    deliver(tmp_dir, "", day(1, ranks=2))                         # shorter now
    zones.format_zone(spark, layout, update=True)                 # not yet converted: the CSV counts, not its old rows
    assert len(titles(spark, layout.formatted(CHARTS))) == 2
    zones.landing_to_parquet(spark, layout)
    zones.format_zone(spark, layout, update=True)
    assert len(titles(spark, layout.formatted(CHARTS))) == 2
    assert ledger.entries(spark, layout.ledger(CHARTS)).count() == 2


def test_rows_of_a_lost_run_never_count(spark, tmp_dir, monkeypatch):
    layout = manifest.ZoneLayout(tmp_dir)
    deliver(tmp_dir, "", day(1))

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(ledger, "record", lost)
        with pytest.raises(RuntimeError):
            zones.landing_to_parquet(spark, layout)
    zones.landing_to_parquet(spark, layout)
    assert spark.read.parquet(layout.copy(CHARTS)).count() == 6   # both runs' rows are there
    zones.format_zone(spark, layout, update=True)
    assert len(titles(spark, layout.formatted(CHARTS))) == 3


def test_copy_made_elsewhere(spark, tmp_dir):
    layout = manifest.ZoneLayout(tmp_dir)
    path = deliver(tmp_dir, "", day(1))
    raw = readers.read_csv(spark, path)
    raw.write.parquet(layout.copy(CHARTS))
    os.remove(path)
    deliver(tmp_dir, "-2", day(2))
    want = sorted(r[1] for n in (1, 2) for r in day(n))
    zones.format_zone(spark, layout, update=True)
    assert titles(spark, layout.formatted(CHARTS)) == want
    zones.landing_to_parquet(spark, layout)
    zones.format_zone(spark, layout, update=True)
    assert titles(spark, layout.formatted(CHARTS)) == want


def test_names_with_odd_characters(spark, tmp_dir):
    layout = manifest.ZoneLayout(tmp_dir)
    for name in (" a b", "+x%20y", "é"):
        deliver(tmp_dir, name, day(1))
    assert zones.landing_to_parquet(spark, layout).counts[CHARTS] == {"files": 3}
    assert not zones.landing_to_parquet(spark, layout).written
    zones.format_zone(spark, layout, update=True)
    assert len(titles(spark, layout.formatted(CHARTS))) == 9


def test_many_small_files_take_few_jobs(spark, tmp_dir):
    sc = spark.sparkContext
    jobs = {}
    for n in (50, 300):  # from 33 on Spark lists paths by a job
        root = f"{tmp_dir}/{n}"
        for k in range(n):
            deliver(root, f"-{k}", [chart(f"x{k}", f"T{k}", 1, "2024-01-01")], header=HEADER)
        deliver(root, "-last", [["e", *chart("y", "Last", 1, "2024-01-02")[::-1]]], header=["extra", *HEADER[::-1]])
        files = readers.list_files(spark, f"{root}/landing")
        before = sc.statusTracker().getJobIdsForGroup(None)
        df = readers.read_csv_by_name(spark, files, manifest.landing_forms("charts"))
        jobs[n] = len(set(sc.statusTracker().getJobIdsForGroup(None)) - set(before))
        assert df.count() == n + 1 and df.filter("name = 'Last'").first()["spotify_id"] == "y"
    assert jobs[300] == jobs[50] < 10


def full_run(spark, tmp_dir, name):
    """The zones as a run over all files makes them."""
    other = f"{tmp_dir}/{name}"
    shutil.copytree(f"{tmp_dir}/landing", f"{other}/landing", ignore=lambda d, names: [n for n in names if not n.endswith(".csv")])
    layout = manifest.ZoneLayout(other)
    zones.format_zone(spark, layout)
    zones.trusted_zone(spark, layout)
    return layout


def test_raw_refresh_equals_a_full_run(spark, tmp_dir):
    layout = manifest.ZoneLayout(tmp_dir)
    deliver(tmp_dir, "-1", day(1) + [chart("dup", "Song 1 1", 1, "2024-01-01"), chart("n", "No date", 4, "")])
    deliver(tmp_dir, "-2", day(2) + day(7))
    assert zones.refresh_charts_zone(spark, layout).counts["dates_rebuilt"]["rows_out"] == 4
    steps = [
        lambda: deliver(tmp_dir, "-3", [["e", *r[::-1]] for r in day(3) + day(1, 5)[3:]], header=["extra", *HEADER[::-1]]),
        lambda: deliver(tmp_dir, "-2", day(2, 1) + day(4)),      # again, without day 7
        lambda: os.utime(f"{tmp_dir}/landing/{CHARTS}-1.csv", (time.time() + 9,) * 2),
    ]
    for k, step in enumerate(steps):
        step()
        report = zones.refresh_charts_zone(spark, layout)
        want = full_run(spark, tmp_dir, f"full{k}")
        for mine, theirs in ((layout.formatted, want.formatted), (layout.trusted, want.trusted)):
            a, b = spark.read.parquet(mine(CHARTS)), spark.read.parquet(theirs(CHARTS))
            assert a.columns == b.columns and rows(a) == rows(b)
        assert report.counts["dates_rebuilt"]["rows_out"] == [2, 3, 0][k]
    assert not os.path.exists(f"{layout.formatted(CHARTS)}/snapshot_date=2024-01-07")


def test_lost_refresh_is_made_up_for(spark, tmp_dir, monkeypatch):
    from tunelake.streaming import refresh
    layout = manifest.ZoneLayout(tmp_dir)
    deliver(tmp_dir, "-1", day(1))
    zones.refresh_charts_zone(spark, layout)
    deliver(tmp_dir, "-2", day(2))

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(refresh, "replace_folders", lost)
        with pytest.raises(RuntimeError):
            zones.refresh_charts_zone(spark, layout)
    zones.refresh_charts_zone(spark, layout)
    assert len(titles(spark, layout.trusted(CHARTS))) == 6


def test_update_run_begins_with_a_first_run(spark, tmp_dir):
    from test_zones import _landing
    _landing(tmp_dir)
    layout = manifest.ZoneLayout(tmp_dir)
    assert set(zones.run_all(spark, layout, update=True)) == {"formatted", "trusted", "analytics", "exploitation"}
    before = spark.read.parquet(layout.trusted(CHARTS)).count()
    deliver(tmp_dir, "-2", day(9))
    reports = zones.run_all(spark, layout, update=True)
    assert set(reports) == {"refreshed", "analytics", "exploitation"}
    assert spark.read.parquet(layout.trusted(CHARTS)).count() == before + 3
    os.remove(f"{tmp_dir}/trusted/_SUCCESS")                      # as if the first run had been lost there
    assert set(zones.bootstrap(spark, layout)) == {"trusted"}
    os.remove(f"{tmp_dir}/formatted/_SUCCESS")
    assert set(zones.bootstrap(spark, layout)) == {"formatted", "trusted"}
    assert not zones.bootstrap(spark, layout)


def test_fallback_passes_over_half_written_zones(spark, tmp_dir, caplog):
    layout = manifest.ZoneLayout(tmp_dir)
    for k, path in enumerate([layout.trusted(CHARTS), layout.formatted(CHARTS), layout.copy(CHARTS)]):
        spark.range(k + 1).write.parquet(path)
    paths, own = [layout.trusted(CHARTS), layout.formatted(CHARTS), layout.copy(CHARTS)], [True, True, False]
    assert readers.read_with_fallback(spark, paths, own=own)[0].count() == 1
    os.remove(f"{paths[0]}/_SUCCESS")
    assert readers.read_with_fallback(spark, paths, own=own)[0].count() == 2
    assert "not committed" in caplog.text
    os.makedirs(f"{paths[1]}/_temporary/0")
    os.remove(f"{paths[1]}/_SUCCESS")
    assert not readers.committed(spark, paths[1])
    assert readers.read_with_fallback(spark, paths, own=own)[0].count() == 3
    with pytest.raises(FileNotFoundError):
        readers.read_with_fallback(spark, paths[:2], own=own[:2])


@pytest.mark.parametrize("write, read", [(sinks.write_parquet, "parquet"), (sinks.write_csv, "csv")])
def test_lost_write_leaves_the_old_table(spark, tmp_dir, write, read):
    path = f"{tmp_dir}/t"
    write(spark.range(3).selectExpr("cast(id as string) s"), path)
    bad = spark.range(5).selectExpr("cast(raise_error('lost') as string) s")
    with pytest.raises(Exception, match="lost"):
        write(bad, path)
    load = lambda: spark.read.option("header", "true").format(read).load(path).count()
    assert load() == 3
    write(spark.range(4).selectExpr("cast(id as string) s"), path)
    assert load() == 4 and os.listdir(tmp_dir) == ["t"]           # what the lost write left has gone too
    os.rename(path, f"{tmp_dir}/.t.old-x")                        # lost between the two renames
    sinks.settle(spark, path)
    assert load() == 4


def test_table_read_while_it_is_replaced(spark, tmp_dir):
    path = sinks.write_parquet(spark.range(3), f"{tmp_dir}/t")
    sinks.write_parquet(spark.read.parquet(path).selectExpr("id + 1 as id"), path)
    assert sorted(r[0] for r in spark.read.parquet(path).collect()) == [1, 2, 3]
