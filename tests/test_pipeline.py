"""Generated workbooks -> lake -> gold, reruns, incremental ingestion."""

import datetime as dt
import os
import tempfile

from xlsx_writer import Error, Inline, write_workbook

from meterlake.plans import drilldown as D
from meterlake.plans import pipeline as P
from meterlake.sources import lake, workbook
from meterlake.streaming.incremental import ingest_available


def _sheet(name, start, n, step_min=15, desc="Lade", label="Wirkleistung [15 m]"):
    g = {(1, 0): "Export", (2, 0): 570, (2, 1): name, (2, 2): Inline(desc),
         (3, 1): label, (4, 0): "Zeitbereich", (4, 1): "Wert"}
    for i in range(n):
        t = start + dt.timedelta(minutes=step_min * i)
        r = 5 + i + (1 if i >= 2 else 0)          # a blank row after two readings
        g[(r, 0)] = t if i % 2 else t.strftime("%d.%m.%Y %H:%M")
        g[(r, 1)] = Error("#N/A") if i == 3 else float(i + 1)
    return g


def make_folder(files):
    d = tempfile.mkdtemp(prefix="ml-xlsx-")
    for name, sheets in files.items():
        write_workbook(os.path.join(d, name), sheets)
    return d


T0 = dt.datetime(2025, 7, 10, 0, 0)


def test_workbook_reader_kinds(spark):
    d = make_folder({"Export_H07_a.xlsx": [("Z 1 (m)", _sheet("Z 1", T0, 4))]})
    c = workbook.cells_of(workbook.list_workbooks(spark, d)).collect()
    kinds = {(r.row_no, r.col_no): (r.value, r.kind) for r in c}
    assert kinds[(2, 0)] == ("570", "n")
    assert kinds[(2, 2)] == ("Lade", "s")
    assert kinds[(6, 0)] == ("2025-07-10 00:15:00", "d")        # date-styled number
    assert kinds[(5, 0)] == ("10.07.2025 00:00", "s")
    assert kinds[(9, 1)] == ("#N/A", "e")
    assert (7, 0) not in kinds                                   # blank row


def test_folder_to_gold_and_rerun(spark):
    files = {
        "Export_H07_a.xlsx": [("Z 1 (m)", _sheet("Z 1", T0, 6)), ("Leer", {(2, 1): "x"}),
                              ("Z 2 (m)", _sheet("Z 2", T0, 4, step_min=30))],
        "Export_H07_b.XLSX": [("Z 1 (m)", _sheet("Z 1 neu", T0, 3))],   # replaces a's Z 1
        "NVP.xlsx": [("Z 9", _sheet("Z 9", T0, 2))],
        "notes.txt": [],
    }
    d = tempfile.mkdtemp(prefix="ml-xlsx-")
    for name, sheets in files.items():
        if name.endswith(".txt"):
            open(os.path.join(d, name), "w").write("x")
        else:
            write_workbook(os.path.join(d, name), sheets)
    root = lake.scratch_root(spark)
    m = P.run_folder(spark, d, root)
    assert m["status"] == "success"
    assert m["files_rows"] == 3
    # b's Z 1 (3 readings) + a's Z 2 (4) + NVP (2); blank rows and Leer skipped
    assert m["bronze_rows"] == 9
    g = lake.read_gold(spark, root)
    meters = {r.meter_id: r.meter_name for r in g.dim_meter.collect()}
    assert meters == {"h07_z_1_m": "Z 1 neu", "h07_z_2_m": "Z 2", "nvp_z_9": "Z 9"}
    assert g.fact.count() == 9
    assert {r.hall_id for r in D.peak_drilldown(g).collect()} == {"H07", "NVP"}
    # rerun: same result (idempotent), run log has two rows
    P.run_folder(spark, d, root)
    assert lake.read_gold(spark, root).fact.count() == 9
    assert lake.read_run_log(spark, root).count() == 2


def test_stale_partition_kept(spark):
    root = lake.scratch_root(spark)
    d1 = make_folder({"Export_H1.xlsx": [("A", _sheet("A", T0, 2))]})
    d2 = make_folder({"Export_H2.xlsx": [("B", _sheet("B", T0, 3))]})
    P.run_folder(spark, d1, root)
    P.run_folder(spark, d2, root)
    g = lake.read_gold(spark, root)
    assert {r.hall_id for r in g.dim_hall.collect()} == {"H1", "H2"}


def test_empty_folder_is_skipped(spark):
    root = lake.scratch_root(spark)
    d = tempfile.mkdtemp(prefix="ml-xlsx-")
    assert P.run_folder(spark, d, root)["status"] == "skipped"


def test_available_now_only_new_files(spark):
    src = tempfile.mkdtemp(prefix="ml-in-")
    root = lake.scratch_root(spark)
    write_workbook(os.path.join(src, "Export_H1.xlsx"), [("A", _sheet("A", T0, 2))])
    m1 = ingest_available(spark, src, root)
    assert m1["files_rows"] == 1 and m1["bronze_rows"] == 2
    m2 = ingest_available(spark, src, root)
    assert m2["batches"] == 0
    write_workbook(os.path.join(src, "Export_H2.xlsx"), [("B", _sheet("B", T0, 3))])
    m3 = ingest_available(spark, src, root)
    assert m3["files_rows"] == 1 and m3["bronze_rows"] == 3
    # same gold as one batch run over both files
    batch_root = lake.scratch_root(spark)
    P.run_folder(spark, src, batch_root)
    a = sorted(lake.read_gold(spark, root).fact.collect())
    b = sorted(lake.read_gold(spark, batch_root).fact.collect())
    assert a == b and len(a) == 5


def test_foreign_hall_folders(spark):
    import pyarrow as pa
    import pyarrow.parquet as pq
    base = tempfile.mkdtemp(prefix="ml-silver-")
    for hall, n in (("H07", 2), ("007", 3)):
        os.makedirs(os.path.join(base, "silver", hall))
        t = pa.table({"hall_id": ["wrong"] * n, "meter_id": ["m"] * n,
                      "timestamp": [T0 + dt.timedelta(minutes=15 * i) for i in range(n)],
                      "value": [1.0] * n, "extra": ["x"] * n})
        pq.write_table(t, os.path.join(base, "silver", hall, "data.parquet"))
    df = lake.read_hall_folders(spark, os.path.join(base, "silver"))
    got = sorted((r.hall_id, r.meter_name) for r in df.collect())
    assert got == [("007", None)] * 3 + [("H07", None)] * 2   # hall from folder, kept as text


def test_rich_text_and_phonetic_runs():
    import io
    import zipfile
    from meterlake.sources.workbook import workbook_cells
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    parts = {
        "xl/workbook.xml": f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/'
                           'officeDocument/2006/relationships"><sheets>'
                           '<sheet name="S" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels":
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="rId1" Type="x" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/sharedStrings.xml": f'<sst {ns}><si><r><t>Wirk</t></r><r><t>leistung</t></r>'
                                '<rPh><t>ignored</t></rPh></si></sst>',
        "xl/worksheets/sheet1.xml": f'<worksheet {ns}><sheetData><row r="3">'
                                    '<c r="B3" t="s"><v>0</v></c><c r="C3" t="b"><v>1</v></c>'
                                    '<c r="D3"><f>1+1</f><v>2</v></c>'
                                    '</row></sheetData></worksheet>',
    }
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for k, v in parts.items():
            z.writestr(k, v)
    got = list(workbook_cells("w.xlsx", buf.getvalue()))
    assert got == [("w.xlsx", 0, "S", 3, 1, "Wirkleistung", "s"),
                   ("w.xlsx", 0, "S", 3, 2, "TRUE", "b"),
                   ("w.xlsx", 0, "S", 3, 3, "2", "n")]          # cached formula value


def test_failed_run_is_logged(spark):
    import pytest
    from pyspark.sql import functions as F
    from meterlake.schema import CELLS
    root = lake.scratch_root(spark)
    bad = (spark.createDataFrame([("f.xlsx", 0, "S", 5, 0, "x", "s")], CELLS)
           .withColumn("value", F.raise_error(F.lit("broken workbook"))))
    with pytest.raises(Exception):
        P.run(spark, bad, root)
    log = lake.read_run_log(spark, root).collect()
    assert [(r.status, r.failed_task) for r in log] == [("failed", "ingest")]
    assert "broken workbook" in log[0].error


def test_hall_filter_prunes_gold_partitions(spark):
    from meterlake.plans import queries as Q
    from meterlake.plans import sql as QS
    root = lake.scratch_root(spark)
    d = make_folder({"Export_H1.xlsx": [("A", _sheet("A", T0, 4))],
                     "Export_H2.xlsx": [("B", _sheet("B", T0, 3))]})
    P.run_folder(spark, d, root)
    gold = lake.read_gold(spark, root)
    for df in (Q.daily_totals(gold, "H2"), D.peak_drilldown(gold, "H2"),
               QS.run(spark, gold, "daily_totals", hall="H2")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(hall_id" in plan and "= H2)" in plan
    assert {r.hall_id for r in Q.daily_totals(gold, "H2").collect()} == {"H2"}


def test_gold_from_single_files(spark):
    import pyarrow as pa
    import pyarrow.parquet as pq
    base = tempfile.mkdtemp(prefix="ml-gold-")
    pq.write_table(pa.table({"hall_id": ["H2", "H1"], "meter_id": ["b", "a"],
                             "timestamp": [T0, T0], "value": [1.0, 2.0]}),
                   os.path.join(base, "fact.parquet"))
    pq.write_table(pa.table({"hall_id": ["H2", "H1"], "hall_label": ["Hall H2", "Hall H1"]}),
                   os.path.join(base, "dim_hall.parquet"))
    pq.write_table(pa.table({"hall_id": ["H2", "H1"], "meter_id": ["b", "a"],
                             "meter_name": ["B", "A"]}),                   # no meter_desc
                   os.path.join(base, "dim_meter.parquet"))
    g = lake.read_gold_files(spark, *(os.path.join(base, f"{t}.parquet")
                                      for t in ("fact", "dim_hall", "dim_meter")))
    assert [r.hall_id for r in g.dim_hall.collect()] == ["H1", "H2"]
    assert [(r.meter_id, r.meter_desc) for r in g.dim_meter.collect()] == [("a", None), ("b", None)]
    assert {r.hall_id for r in D.peak_drilldown(g).collect()} == {"H1", "H2"}
