"""Role adapters must be pure projections: the catalogue runs on whole
tables, so an adapter may reshape columns but never drop or add rows."""

import pytest

from tunelake.plans import roles as R

from conftest import SF0001

ADAPTERS = [
    ("events", R.charts_from_events),
    ("part", R.raw_tracks_from_part),
    ("orders", R.raw_charts_from_orders),
    ("documents", R.raw_lyrics_from_documents),
]


@pytest.mark.parametrize("table,adapter", ADAPTERS)
def test_adapter_keeps_every_row(spark, table, adapter):
    src = R.table(spark, SF0001, table)
    out = adapter(src)
    assert out.count() == src.count()
    assert "Filter" not in out._jdf.queryExecution().optimizedPlan().toString()
