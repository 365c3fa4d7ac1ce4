"""The monitor over files that arrive in several steps, late rows and a restart."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from ledgerpulse.streaming import baseline, ledger, monitor

DAY = datetime(2024, 1, 1)
SCHEMA = "ts timestamp_ntz, confidence decimal(5,4), correct int"


def put(spark, folder, name, rows):
    from decimal import Decimal

    data = [(DAY + timedelta(hours=h), Decimal("0.5000"), c) for h, c in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").json(f"{folder}")


def run(spark, folder, base):
    rows = monitor.read_documents(spark, str(folder), spark.createDataFrame([], SCHEMA).schema, max_files=1)
    query = monitor.start_monitor(
        monitor.window_stats(rows, "ts"), f"{base}/stats", f"{base}/checkpoint", availableNow=True
    )
    query.awaitTermination()


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path / "in"


def test_windows_close_once_and_late_rows_are_dropped(spark, tmp_path, folder):
    good, bad = [(h, 1) for h in range(0, 24)], [(h, int(h % 2)) for h in range(48, 72)]
    put(spark, folder, "a", good)
    run(spark, folder, tmp_path)
    put(spark, folder, "b", [(h, 1) for h in range(24, 48)])
    run(spark, folder, tmp_path)
    put(spark, folder, "c", [(1, 0), *bad])  # the first row is two days late
    run(spark, folder, tmp_path)
    put(spark, folder, "d", [(80, 1)])
    run(spark, folder, tmp_path)
    rows = monitor.judged(spark, f"{tmp_path}/stats").collect()
    assert [r["window_start"] for r in rows] == [DAY, DAY + timedelta(days=1), DAY + timedelta(days=2)]
    assert [(r["n"], r["accuracy_pct"], r["drift_alert"]) for r in rows] == [
        (24, 100.0, None), (24, 100.0, False), (24, 50.0, True)
    ]
    alerts = spark.read.parquet(f"{tmp_path}/stats_alerts").filter("drift_alert").collect()
    assert [r["window_start"] for r in alerts] == [DAY + timedelta(days=2)]


def test_restart_without_news_changes_nothing(spark, tmp_path, folder):
    put(spark, folder, "a", [(0, 1), (30, 1)])
    run(spark, folder, tmp_path)
    before = monitor.judged(spark, f"{tmp_path}/stats").collect()
    run(spark, folder, tmp_path)
    assert monitor.judged(spark, f"{tmp_path}/stats").collect() == before and len(before) == 1


def test_open_windows_are_judged_with_the_closed(spark, tmp_path, folder):
    schema = spark.createDataFrame([], SCHEMA).schema
    batch = lambda: spark.read.schema(schema).json(str(folder))
    table = f"{tmp_path}/stats"
    put(spark, folder, "a", [(0, 1), (1, 1)])
    run(spark, folder, tmp_path)
    none_closed = monitor.judged(spark, table, still_open=monitor.open_windows(batch(), table, "ts")).collect()
    assert [(r["window_start"], r["n"], r["closed"]) for r in none_closed] == [(DAY, 2, False)]
    put(spark, folder, "b", [(26, 0), (27, 1)])
    run(spark, folder, tmp_path)
    rows = monitor.judged(spark, table, still_open=monitor.open_windows(batch(), table, "ts")).collect()
    assert [(r["n"], r["accuracy_pct"], r["drift_alert"], r["closed"]) for r in rows] == [
        (2, 100.0, None, True), (2, 50.0, True, False)
    ]


def _stats(spark, folder):
    schema = spark.createDataFrame([], SCHEMA).schema
    return monitor.window_stats(monitor.read_documents(spark, str(folder), schema, max_files=1), "ts")


def test_baseline_state_survives_a_restart(spark, tmp_path, folder):
    hours = {"a": range(0, 30), "b": range(30, 60), "c": range(60, 90)}
    for name, own in hours.items():
        put(spark, folder, name, [(h, int(h % 4 > 0 or h < 48)) for h in own])
        baseline.start(_stats(spark, folder), f"{tmp_path}/sums", f"{tmp_path}/point", availableNow=True).awaitTermination()
    sums = baseline.read_sums(spark, f"{tmp_path}/sums")
    rows = baseline.judged(sums).orderBy("window_start").collect()
    assert [(r["accuracy_pct"], r["running_baseline"], r["drift_alert"]) for r in rows] == [
        (100.0, None, None), (100.0, 100.0, False), (75.0, 100.0, True)
    ]
    schema = spark.createDataFrame([], SCHEMA).schema
    still = monitor.open_windows(spark.read.schema(schema).json(str(folder)), f"{tmp_path}/sums", "ts")
    whole = baseline.with_open(sums, still).orderBy("window_start").collect()
    assert [(r["earlier_tenths"], r["earlier_windows"], r["closed"]) for r in whole] == [
        (0, 0, True), (1000, 1, True), (2000, 2, True), (2750, 3, False)
    ]


def test_late_rows_have_a_table_and_the_state_stays_small(spark, tmp_path, folder):
    book = ledger.Ledger(f"{tmp_path}/book", "ts")
    schema = spark.createDataFrame([], SCHEMA).schema
    loads = [[(h, 1) for h in range(24 * d, 24 * d + 24)] + ([(1, 0), (25, 0)] if d == 4 else []) for d in range(6)]
    for i, load in enumerate(loads):
        put(spark, folder, f"f{i}", load)
        book.start(monitor.read_documents(spark, str(folder), schema), f"{tmp_path}/point", availableNow=True).awaitTermination()
    rows = book.windows(spark).orderBy("window_start").collect()
    assert [(r["n"], r["accuracy_pct"], r["closed"]) for r in rows] == [(24, 100.0, True)] * 5 + [(24, 100.0, False)]
    late = book.late(spark).collect()
    assert sorted((r["ts"], r["correct"]) for r in late) == [(DAY + timedelta(hours=1), 0), (DAY + timedelta(hours=25), 0)]
    assert len(book._states()) <= 2 and len(book.state()[1]) == 1
    # A micro-batch that runs again starts from its predecessor's state and leaves the same.
    last = max(book._states())
    before = book.state()
    book.merge(spark.createDataFrame([(DAY + timedelta(hours=h), None, c) for h, c in loads[-1]], SCHEMA), last)
    assert book.state()[1][0][:3] == before[1][0][:3] and book.late(spark).count() == 2


def test_ledger_without_rows(spark, tmp_path):
    book = ledger.Ledger(f"{tmp_path}/book", "ts")
    book.merge(spark.createDataFrame([], SCHEMA), 0)
    assert book.state() == (None, [])
