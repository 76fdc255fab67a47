"""Second sort orders: the same answers from fewer rows read."""

import datetime as dt
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from tidebook.fixtures import frame
from tidebook.plans import reader
from tidebook.plans.layouts import LAYOUTS, Layouts

UTC = dt.timezone.utc
DAYS = dt.datetime(1995, 3, 1, tzinfo=UTC), dt.datetime(1995, 3, 8, tzinfo=UTC)


@pytest.fixture(scope="module")
def live(spark):
    return frame(spark, "/root/testdata/sf0.01", "v_live").cache()


@pytest.fixture(scope="module")
def layouts(spark, live, tmp_path_factory):
    made = Layouts(spark, f"file://{tmp_path_factory.mktemp('layouts')}/orders", row_group=64 << 10)
    made.publish(live, files=4)
    return made


def scanned(df):
    """Rows that the scan of an executed plan gave, as Spark's metrics tell."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan
    leaves = plan.collectLeaves()
    total = 0
    for k in range(leaves.size()):
        leaf = leaves.apply(k)
        while not leaf.nodeName().startswith("Scan") and leaf.nodeName().endswith("QueryStage"):
            leaf = leaf.plan().collectLeaves().apply(0)
        total += leaf.metrics().apply("numOutputRows").value()
    return total


def test_readers_give_the_same_from_few_rows(spark, live, layouts):
    n, same = live.count(), lambda a, b: a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    hub, since = live.first()["location_id"], DAYS
    some = [r["order_id"] for r in live.limit(2).collect()]
    cases = [
        (layouts.hub_sells(hub), reader.hub_sells(live, hub)),
        (layouts.recent_orders(*since), reader.recent_orders(live, *since)),
        (layouts.read("by_type").filter("type_id = 7").select(live.columns), live.filter("type_id = 7")),
        (layouts.orders(some[:1]), live.filter(live["order_id"] == some[0])),
    ]
    for fast, plain in cases:
        assert scanned(fast) < 0.2 * n and same(fast, plain)
    assert same(layouts.best_prices(), reader.best_prices(live)) and same(layouts.best_prices([7, 9]), reader.best_prices(live.filter("type_id in (7, 9)")))


def test_copies_change_together_and_old_ones_go(spark, live, tmp_path, monkeypatch):
    table = Layouts(spark, f"file://{tmp_path}/orders")
    assert table.read("by_type").count() == 0 and table.vacuum() == 0
    table.publish(live.filter("region_id = 1"), files=2)
    n = table.read("by_order").count()
    with monkeypatch.context() as m:
        m.setattr(table, "_children", lambda path: (_ for _ in ()).throw(OSError("dead")))
        with pytest.raises(OSError, match="dead"):
            table.publish(live.filter("region_id = 2"), files=2)
    assert {table.read(name).count() for name in LAYOUTS} == {n}
    table.publish(live.filter("region_id < 3"), files=2)
    assert {table.read(name).count() for name in LAYOUTS} == {live.filter("region_id < 3").count()}
    assert table.vacuum() == 2 and table.read("by_location").count() > n


def test_bloom_filters_are_as_large_as_their_row_groups_need(layouts):
    size = {name: sum(f.stat().st_size for f in Path(layouts.root.removeprefix("file://")).glob(f"data/*/{name}/*.parquet")) for name in LAYOUTS}
    assert size["by_order"] < 2 * size["by_issue"]
    files = sorted(Path(layouts.root.removeprefix("file://")).glob("data/*/by_order/*.parquet"))
    assert sum(pq.read_metadata(f).num_row_groups for f in files) > 8
    # Between the last row group and the footer lie the filters (and indexes of pages): at least a byte an order.
    for f in files:
        meta = pq.read_metadata(f)
        group = meta.row_group(meta.num_row_groups - 1)
        last = max(group.column(k).data_page_offset + group.column(k).total_compressed_size for k in range(group.num_columns))
        assert f.stat().st_size - meta.serialized_size - last > meta.num_rows
