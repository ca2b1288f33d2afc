"""Grid -> bronze operators on literal cell tables."""

from pyspark.sql import functions as F

from meterlake.operators import grid as G
from meterlake.schema import CELLS


def cells(spark, rows):
    return spark.createDataFrame(rows, CELLS)


def sheet(src, idx, name, grid):
    return [(src, idx, name, r, c, v, k) for (r, c), (v, k) in grid.items()]


BASE = {
    (1, 0): ("Export", "s"),
    (2, 0): ("570", "n"), (2, 1): ("Z 1", "s"), (2, 2): ("  ", "s"), (2, 3): ("Lade", "s"),
    (3, 1): ("Leistung", "s"), (3, 2): ("Wirk [30 m]", "s"), (3, 3): ("x [5m]", "s"),
    (4, 0): ("Zeitbereich", "s"), (4, 1): (" Wert ", "s"),
    (5, 0): ("01.02.2025 00:15", "s"), (5, 1): ("1.5", "n"),
    (7, 0): ("01.02.2025 00:30", "s"), (7, 1): ("#N/A", "s"),
    (8, 0): ("01.02.2025 00:45", "s"), (8, 1): ("x", "s"), (8, 2): ("7", "n"),
}


def test_sheet_meta_name_desc_interval(spark):
    m = G.sheet_meta(cells(spark, sheet("f.xlsx", 0, "S", BASE))).collect()[0]
    # numbers and blank text in row 2 are skipped
    assert (m.meter_name, m.meter_desc) == ("Z 1", "Lade")
    # first row-3 text with [n m] wins over later ones
    assert (m.interval_label, m.interval_minutes) == ("Wirk [30 m]", 30)
    assert m.header_patch is False


def test_interval_default_and_last_label(spark):
    g = {(2, 1): ("A", "s"), (3, 0): ("kW", "s"), (3, 4): ("Leistung", "s")}
    m = G.sheet_meta(cells(spark, sheet("f.xlsx", 0, "S", g))).collect()[0]
    assert (m.interval_label, m.interval_minutes) == ("Leistung", 15)
    assert m.meter_desc is None


def test_header_patch_and_fallback_names(spark):
    g = {(3, 0): (" ZEITBEREICH ", "s"), (4, 1): ("Wert", "s"), (4, 2): ("Wert", "s"),
         (5, 0): ("01.01.2025 00:00", "s"), (5, 1): ("1", "n"), (5, 2): ("2", "n"),
         (5, 3): ("3", "n")}
    info = G.column_info(cells(spark, sheet("f.xlsx", 0, "S", g)))
    names = {r.col_no: r.name for r in info.collect()}
    # A4 patched, repeated name disambiguated, header-less data column named
    assert names == {0: "Zeitbereich", 1: "Wert", 2: "Wert_2", 3: "col_3"}


def test_numeric_rule_truncates(spark):
    # 1 numeric of 2 present passes: int(0.8 * 2) = 1
    g = {(4, 1): ("Wert", "s"), (5, 1): ("1", "n"), (6, 1): ("a", "s")}
    st = G.column_stats(cells(spark, sheet("f.xlsx", 0, "S", g))).collect()[0]
    assert (st.n_present, st.n_numeric, st.numeric) == (2, 1, True)
    # 3 of 5 fails: needs int(0.8 * 5) = 4
    g = {(5 + i, 1): (v, "s") for i, v in enumerate(["1", "2", "3", "a", "b"])}
    st = G.column_stats(cells(spark, sheet("f.xlsx", 0, "S", g))).collect()[0]
    assert (st.n_present, st.n_numeric, st.numeric) == (5, 3, False)


def test_missing_tokens_and_number_text(spark):
    toks = ["#N/A", "#N/A.NA", "N/A", "NA", "NaN", "None", "", "n/a", "1d", "2f", "1e3", " 4 "]
    g = {(5 + i, 1): (v, "s") for i, v in enumerate(toks)}
    g[(4, 1)] = ("Wert", "s")
    g.update({(5 + i, 0): ("01.01.2025 00:00", "s") for i in range(len(toks))})
    c = cells(spark, sheet("f.xlsx", 0, "S", g))
    st = G.column_stats(c).where("col_no = 1").collect()[0]
    # 7 tokens are missing; of the 5 left only 1e3 and ' 4 ' are numbers
    assert (st.n_present, st.n_numeric) == (5, 2)


def test_roles_and_records(spark):
    c = cells(spark, sheet("f.xlsx", 0, "S", BASE))
    b = G.cells_to_bronze(c).orderBy("row_no").collect()
    assert [r.row_no for r in b] == [5, 7, 8]        # blank row 6 skipped, later rows kept
    assert b[0].timestamp_raw == "01.02.2025 00:15"
    # value column: 1.5 and x present -> 1 of 2 numeric -> numeric; x -> NULL
    assert [r.value for r in b] == [1.5, None, None]
    assert b[2].cells["col_2"] == "7"
    assert (b[0].hall_id, b[0].meter_id, b[0].meter_name) == ("f", "f_s", "Z 1")


def test_time_column_hint(spark):
    g = {(4, 0): ("Nr", "s"), (4, 1): ("Datum/Zeit", "s"), (4, 2): ("Wert", "s"),
         (5, 0): ("1", "n"), (5, 1): ("01.01.2025 00:00", "s"), (5, 2): ("3", "n")}
    st = G.sheet_table(G.column_profile(cells(spark, sheet("f.xlsx", 0, "S", g))))
    r = G.sheet_roles(st).collect()[0]
    assert (r.time_col, r.time_name, r.value_col) == (1, "Datum/Zeit", 2)


def test_ids(spark):
    df = spark.createDataFrame(
        [("Export_H07_x.xlsx", 0, "Z 100 (m)"), ("NVP-Halle.XLSX", 0, "__a b__"),
         ("werk.xlsx", 1, "Ä")], "src_file string, sheet_idx int, sheet_name string")
    got = {r.src_file: r for r in G.sheet_ids(df).collect()}
    assert got["Export_H07_x.xlsx"].hall_id == "H07"
    assert got["Export_H07_x.xlsx"].sheet_key == "Z_100_m"
    assert got["Export_H07_x.xlsx"].meter_id == "h07_z_100_m"
    assert got["NVP-Halle.XLSX"].hall_id == "NVP"
    assert got["NVP-Halle.XLSX"].sheet_key == "a_b"
    assert got["werk.xlsx"].hall_id == "werk"
    assert got["werk.xlsx"].hall_label == "Hall werk"
    assert got["werk.xlsx"].sheet_key == ""


def test_last_writer_skips_empty_and_takes_greatest(spark):
    data = {(4, 0): ("Zeitbereich", "s"), (4, 1): ("Wert", "s"),
            (5, 0): ("01.01.2025 00:00", "s"), (5, 1): ("1", "n")}
    empty = {(2, 1): ("Z", "s"), (4, 0): ("Zeitbereich", "s")}
    rows = (sheet("H1_a.xlsx", 0, "M 1", data) + sheet("H1_b.xlsx", 0, "M 1", data)
            + sheet("H1_c.xlsx", 0, "M 1", empty))
    b = G.cells_to_bronze(cells(spark, rows)).collect()
    assert {r.src_file for r in b} == {"H1_b.xlsx"}


def test_decimal_comma_option(spark):
    g = {(4, 0): ("Zeitbereich", "s"), (4, 1): ("Wert", "s")}
    for i, v in enumerate(["1,5", "2,25", "3", "1.234,5"]):
        g[(5 + i, 0)] = ("01.01.2025 00:00", "s")
        g[(5 + i, 1)] = (v, "s")
    c = cells(spark, sheet("f.xlsx", 0, "S", g))
    # default: a comma is not a decimal point -> 1 of 4 numeric -> column is text
    assert [r.value for r in G.cells_to_bronze(c).orderBy("row_no").collect()] == [None] * 4
    got = [r.value for r in G.cells_to_bronze(c, decimal_comma=True).orderBy("row_no").collect()]
    assert got == [1.5, 2.25, 3.0, None]          # thousands separators never accepted


def test_sheet_key_case_kept_meter_id_shared(spark):
    data = {(4, 0): ("Zeitbereich", "s"), (4, 1): ("Wert", "s"),
            (5, 0): ("01.01.2025 00:00", "s"), (5, 1): ("1", "n")}
    rows = sheet("H1_x.xlsx", 0, "A", data) + sheet("H1_y.xlsx", 0, "a", data)
    b = G.cells_to_bronze(cells(spark, rows)).collect()
    assert sorted((r.sheet_key, r.meter_id) for r in b) == [("A", "h1_a"), ("a", "h1_a")]
