"""The history table: exactly once, year by year, with its books."""

import datetime as dt
import decimal
import glob
import os

import pytest
from pyspark.sql import functions as F

from tidebook.operators import history
from tidebook.plans.history_table import HistoryTable
from tidebook.schemas import HISTORY
from tidebook.streaming import ingest

UTC = dt.timezone.utc
NOON = dt.datetime(2024, 3, 2, 12, tzinfo=UTC)


def row(type_id, date, volume, at, region=1):
    p = decimal.Decimal("2.50")
    return (region, type_id, date, p, p, p, 1, volume, at)


def day(n, year=2024):
    return dt.date(year, 3, n)


def hours(n):
    return NOON + dt.timedelta(hours=n)


WAVES = [
    [row(1, day(1), 10, hours(0)), row(2, day(1), 20, hours(0)), row(3, day(2), 30, hours(1)), row(9, day(1), 90, hours(0), region=7)],
    [row(1, day(1), 11, hours(2)), row(1, day(1), 12, hours(3)), row(4, day(2, 2023), 40, hours(2)), row(5, day(2, 1999), 50, hours(2)), row(6, None, 60, hours(2))],
    [row(1, day(1), 99, hours(1)), row(2, day(1), 21, hours(3))],  # the first is older than its day's mark
]


def frame(spark, rows):
    return spark.createDataFrame(rows, HISTORY)


def tracked(spark):
    return spark.createDataFrame([(1,)], "region_id long")


def books(table):
    return {str(r["day"]): (r["totals_count"], r["rows_upserted"], r["watermark"].replace(tzinfo=UTC)) for r in table.days().collect()}


def volumes(table):
    return sorted((r["type_id"], r["year"], r["volume"]) for r in table.read().collect())


WANT = [(1, 2024, 12), (2, 2024, 21), (3, 2024, 30), (4, 2023, 40)]
WANT_BOOKS = {"2024-03-01": (7, 4, hours(3)), "2024-03-02": (1, 1, hours(1)), "2023-03-02": (1, 1, hours(2))}


@pytest.fixture
def table(spark, tmp_path):
    made = HistoryTable(spark, f"file://{tmp_path}/history", 2003, 2050)
    made.path = str(tmp_path / "history")
    return made


def files(table, year):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{table.path}/data/*/year={year}/*.parquet")}


def test_imports_keep_rows_books_and_rejects(spark, table):
    for k, wave in enumerate(WAVES):
        assert table.import_rows(frame(spark, wave), tracked(spark), "s", k)
    assert volumes(table) == WANT and books(table) == WANT_BOOKS
    assert sorted(r["type_id"] for r in table.rejected().collect()) == [5, 6]
    assert {r["year"]: r["n_rows"] for r in table.years().collect()} == {2023: 1, 2024: 3}


def test_untouched_years_keep_their_files_and_old_ones_go(spark, table):
    table.import_rows(frame(spark, [*WAVES[0], row(4, day(2, 2023), 40, hours(0))]), tracked(spark))
    before = files(table, 2023)
    table.import_rows(frame(spark, [row(1, day(5), 7, hours(9))]), tracked(spark))
    assert before and files(table, 2023) == before
    assert table.vacuum() == 1 and files(table, 2023) == before
    assert table.retain(2024) == [2023] and not files(table, 2023) and {v[1] for v in volumes(table)} == {2024}
    assert all(str(r["day"]) >= "2024" for r in table.days().collect())


def test_a_batch_seen_before_is_skipped(spark, table):
    for k in (0, 0, 1, 1, 0, 2, 2):
        table.import_rows(frame(spark, WAVES[k]), tracked(spark), "s", k)
    assert volumes(table) == WANT and books(table) == WANT_BOOKS


def test_a_stream_that_dies_between_its_writes_replays_to_the_same(spark, table, tmp_path, monkeypatch):
    path, state = f"file://{tmp_path}/landed", f"file://{tmp_path}/state"

    def run():
        ingest.ingest_history(ingest.file_stream(spark, path, HISTORY), tracked(spark), table, state).awaitTermination()

    for k, wave in enumerate(WAVES):
        frame(spark, wave).coalesce(1).write.mode("append").parquet(path)
        with monkeypatch.context() as m:  # all rows are written, and the process dies before the pointer
            m.setattr(table, "_swap", lambda *_: (_ for _ in ()).throw(OSError("dead")))
            with pytest.raises(Exception, match="dead"):
                run()
        assert len(books(table)) == (0, 2, 3)[k]
        swap = table._swap
        with monkeypatch.context() as m:  # the pointer is there, and the process dies before the stream has noted its batch
            m.setattr(table, "_swap", lambda *a: (swap(*a), (_ for _ in ()).throw(OSError("late")))[0])  # noqa: B023
            with pytest.raises(Exception, match="late"):
                run()
        run()
    assert volumes(table) == WANT and books(table) == WANT_BOOKS
    batch = HistoryTable(spark, f"file://{tmp_path}/other", 2003, 2050)
    for wave in WAVES:
        batch.import_rows(frame(spark, wave), tracked(spark))
    assert books(batch) == books(table) and volumes(batch) == volumes(table)


def test_days_that_are_not_due_are_left_alone(spark, table):
    first = [row(1, day(1), 1, hours(0)), row(1, day(20), 1, hours(0)), row(1, day(2, 2021), 1, hours(0))]
    table.import_rows(frame(spark, first), tracked(spark), today=day(22))
    assert sorted(books(table)) == ["2024-03-01", "2024-03-20"]  # 2021 lies beyond the backfill
    again = [row(1, day(1), 2, hours(5)), row(1, day(20), 2, hours(5)), row(1, day(3), 2, hours(5))]
    table.import_rows(frame(spark, again), tracked(spark), today=day(22))
    assert sorted((r["date"].day, r["volume"]) for r in table.read().collect()) == [(1, 1), (3, 2), (20, 2)]


def test_empty_and_null_rows(spark, table):
    assert table.read().count() == 0 and table.retain(2000) == [] and table.vacuum() == 0
    table.import_rows(frame(spark, []), None)
    assert table.read().count() == 0 and books(table) == {}
    table.import_rows(frame(spark, [row(1, day(1), 5, None)]), None)
    assert [r["watermark"] for r in table.days().collect()] == [None] and table.read().count() == 1
    assert history.coverage(table.read()).first()["n_rows"] == 1 and table.read().filter(F.col("year") == 2024).count() == 1
