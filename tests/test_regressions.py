"""Faults found by review: each was reproduced once and stays mended."""

import datetime as dt
import os
import random

import pytest
from test_grid import cells, sheet
from test_pipeline import T0, _sheet, make_folder
from test_silver import parse
from xlsx_writer import write_workbook

from meterlake.operators import grid as GR
from meterlake.plans import drilldown as D
from meterlake.plans import pipeline as P
from meterlake.plans import queries as Q
from meterlake.sources import lake, workbook
from meterlake.streaming import incremental
from meterlake.streaming.incremental import ingest_available


def test_unreadable_workbook_fails_and_is_logged(spark):
    d = make_folder({"Export_H1_a.xlsx": [("A", _sheet("A", T0, 3))]})
    open(os.path.join(d, "Export_H2_b.xlsx"), "wb").write(b"not a zip")
    root = lake.scratch_root(spark)
    with pytest.raises(Exception, match="Export_H2_b.xlsx"):
        P.run_folder(spark, d, root)
    log = lake.read_run_log(spark, root).first()
    assert (log.status, log.failed_task) == ("failed", "ingest") and "Export_H2_b.xlsx" in log.error


@pytest.mark.parametrize("run", [P.run_folder, ingest_available])
@pytest.mark.parametrize("name", ["_Export_H2.xlsx", ".Export_H2.XLSX"])
def test_workbook_that_spark_does_not_list_fails_and_is_logged(spark, run, name):
    d = make_folder({"Export_H1_a.xlsx": [("A", _sheet("A", T0, 3))], name: [("B", _sheet("B", T0, 2))]})
    root = lake.scratch_root(spark)
    with pytest.raises(ValueError, match="Export_H2"):
        run(spark, d, root)
    log = lake.read_run_log(spark, root).first()
    assert log.status == "failed" and name in log.error


def test_archive_keeps_every_file(spark):
    root = lake.scratch_root(spark)
    for name in ("Export_H1_jan.xlsx", "Export_H1_feb.xlsx"):
        P.run_folder(spark, make_folder({name: [("A", _sheet("A", T0, 2))]}), root)
    kept = workbook.read_archive(spark, root)
    assert {r.src_file for r in kept.select("src_file").collect()} == {"Export_H1_jan.xlsx", "Export_H1_feb.xlsx"}


def test_hall_without_rows_loses_its_old_ones(spark):
    root = lake.scratch_root(spark)
    P.run_folder(spark, make_folder({"Export_H1.xlsx": [("A", _sheet("A", T0, 3))],
                                     "Export_H2.xlsx": [("B", _sheet("B", T0, 2))]}), root)
    bad = _sheet("A", T0, 3)
    for (row, col) in list(bad):
        if row > 4 and col == 0:
            bad[(row, col)] = "Summe"
    P.run_folder(spark, make_folder({"Export_H1.xlsx": [("A", bad)]}), root)
    assert {r.hall_id for r in lake.read_gold(spark, root).fact.collect()} == {"H2"}


@pytest.mark.parametrize("batch", [1, 1000])
def test_incremental_winner_does_not_depend_on_batches(spark, batch):
    d = make_folder({})
    # written in the order that makes the greatest name the oldest file
    for name, n in (("Export_H1_b.xlsx", 4), ("Export_H1_a.xlsx", 2)):
        write_workbook(os.path.join(d, name), [("A", _sheet("A", T0, n))])
        os.utime(os.path.join(d, name), (1e9 + n, 1e9 - n * 1000))
    root = lake.scratch_root(spark)
    ingest_available(spark, d, root, max_files_per_batch=batch)
    assert {r.src_file for r in lake.read_bronze(spark, root).collect()} == {"Export_H1_b.xlsx"}


def test_failed_clean_is_redone_by_the_next_call(spark, monkeypatch):
    d = make_folder({"Export_007_a.xlsx": [("A", _sheet("A", T0, 3))]})
    root = lake.scratch_root(spark)

    def fail(*a, **k):
        raise RuntimeError("x" * 5000)

    with monkeypatch.context() as m:
        m.setattr(incremental.pipeline, "clean", fail)
        with pytest.raises(RuntimeError):
            ingest_available(spark, d, root)
    log = lake.read_run_log(spark, root).first()
    assert (log.status, log.failed_task) == ("failed", "clean") and "x" * 5000 in log.error
    ingest_available(spark, d, root)
    assert lake.read_gold(spark, root).fact.count() == 3
    assert ingest_available(spark, d, root)["batches"] == 0
    assert {r.status for r in lake.read_run_log(spark, root).collect()} == {"failed", "success", "skipped"}


def test_repeated_headers_never_clash(spark):
    g = {(4, 0): "Zeitbereich", (4, 1): "Wert", (4, 2): "Wert", (4, 3): "Wert_2", (4, 4): "Wert",
         (5, 0): "10.07.2025 00:00", (5, 1): "1", (5, 2): "2", (5, 3): "3", (5, 4): "4"}
    g = {k: (v, "s") for k, v in g.items()}
    rows = GR.bronze_from(c := cells(spark, sheet("Export_H1.xlsx", 0, "A", g)), GR.column_profile(c)).collect()
    assert sorted(rows[0].cells.values()) == ["1", "10.07.2025 00:00", "2", "3", "4"]


def test_kpi_totals_are_rounded_once(spark):
    row = [("H", dt.date(2025, 7, 10), 0.446, "m", "M", 0.446, dt.datetime(2025, 7, 10), dt.datetime(2025, 7, 10, 0, 15), 0.446)]
    drill = spark.createDataFrame(row, "hall_id string, top_day date, top_day_total double, top_meter_id string, "
                                  "top_meter_name string, top_meter_total double, peak_start timestamp_ntz, "
                                  "peak_end timestamp_ntz, peak_value double")
    assert D.kpi_strings(drill).first().peak_day_sub == "0.4 kW total"


def test_more_date_layouts(spark):
    got = parse(spark, ["10.07.25 00:15", "2025-07-10T00:15:00Z", "2025-07-10T00:15:00+02:00", "2025/07/10 00:15",
                        "2025-07-10 00:15:00.250", "10-07-2025", "01.02.99"])
    assert got == [dt.datetime(2025, 7, 10, 0, 15), dt.datetime(2025, 7, 10, 0, 15), dt.datetime(2025, 7, 9, 22, 15),
                   dt.datetime(2025, 7, 10, 0, 15), dt.datetime(2025, 7, 10, 0, 15, 0, 250_000), dt.datetime(2025, 7, 10),
                   dt.datetime(1999, 2, 1)]


def test_peak_interval_with_repeated_times(spark):
    r = random.Random(1)
    rows = [("H", "m", dt.datetime(2025, 7, 10) + dt.timedelta(minutes=r.choice([0, 15, 30, 45, 75])), float(r.randrange(9)))
            for _ in range(3000)] + [("H", "n", dt.datetime(2025, 7, 10), 1.0)]
    s = spark.createDataFrame(rows, "hall_id string, meter_id string, timestamp timestamp_ntz, consumption double")
    s = s.withColumn("day", Q.reading_day())
    got = {x.meter_id: x for x in Q.peak_interval(s).collect()}
    assert got["m"].step_seconds == 0 and got["n"].step_seconds == 900
    first = min(t for _, m, t, v in rows if m == "m" and v == 8.0)
    assert (got["m"].peak_start, got["m"].peak_value) == (first, 8.0)
    plan = Q.peak_interval(s)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and plan.index("Window") < plan.rindex("HashAggregate")
