"""Worksheet cells -> bronze records.

Input is the long ``cells`` table (one row per non-empty cell, see
``schema.CELLS``). A worksheet is the key ``S = (src_file, sheet_idx)``.
Every step is a grouping or join over that table, so all sheets of all
workbooks are handled by one plan instead of a loop per sheet:

* ``column_profile`` ONE hash aggregate over the cells per (sheet, column): texts
                     of rows 2-4 and the 80 %-rule counts of the data cells
* ``sheet_table``    ONE aggregate over the profile per sheet: the sheet's
                     columns as a sorted array, from which array functions
                     derive meter name/desc, interval, header patch, header
                     names (patched, ``col_<j>`` fallback, repeats
                     disambiguated), types, time/value roles and emptiness
* ``last_writer``    per (hall, sheet key) only the last non-empty sheet in
                     (file name, sheet order) survives
* ``records``        data cells of surviving sheets, grouped per (sheet,
                     row) into a name -> text map plus the typed role values
* ``cells_to_bronze`` the whole chain.

Scale: the cells are scanned twice (profile, records); everything between
works on the profile (sheets x columns rows). Group sizes are bounded by the
sheet format itself: a row has at most 16,384 cells, so a sheet's column
array and a record's cell list are bounded; a column of a huge sheet is
reduced partially per task before any shuffle. Cells of sheets that lose the
last-writer rule are dropped by the join before the records shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import (hall_id_of, hall_label_of, is_number_text, meter_id_of,
                              missing_to_null, safe_key, strip, to_number)
from ..schema import (DEFAULT_INTERVAL_MINUTES, HEADER_ROW, INTERVAL_PATTERN,
                      LABEL_ROW, NAME_ROW, NUMERIC_SHARE, TIME_HEADER,
                      TIME_HEADER_HINTS, VALUE_HEADER)
from .sizing import checked_broadcast

S = ["src_file", "sheet_idx"]


# One pass over the cells ------------------------------------------------------
def column_profile(cells: DataFrame, *, decimal_comma: bool = False) -> DataFrame:
    """Everything the metadata steps need, in ONE pass over the cells: per
    (sheet, column) the text of rows 2 and 3 (non-blank text cells only), the
    row-4 header cell, and the 80 %-rule counts over the data cells.

    The cells are counted by (sheet, column, header row, header text); the last
    two are null for data cells. Counts have a fixed width and texts are
    grouping keys, so the aggregate hashes however many keys a task holds (a
    ``max`` or list of texts would sort the cells). It leaves at most four rows
    a column, which a second, small aggregate folds into one. A column holds
    at most one cell per row; the sheet title is constant per sheet and rides
    along as a grouping key.
    """
    v = F.col("value")
    row = F.col("row_no")
    text = (F.col("kind") == "s") & (strip(v) != "")
    data = row > HEADER_ROW
    dv = F.when(data, missing_to_null(v))
    head = F.when((row.isin(NAME_ROW, LABEL_ROW) & text) | (row == HEADER_ROW), row)
    keyed = cells.select(*S, "sheet_name", "col_no", head.alias("_row"), F.when(head.isNotNull(), v).alias("_text"),
                         dv.alias("_dv"), data.alias("_data"))
    counted = keyed.groupBy(*S, "sheet_name", "col_no", "_row", "_text").agg(
        F.count("_dv").alias("n_present"),
        F.count(F.when(is_number_text(F.col("_dv"), decimal_comma), 1)).alias("n_numeric"),
        F.count(F.when(F.col("_data"), 1)).alias("_n_data"))
    of_row = lambda k: F.max(F.when(F.col("_row") == k, F.col("_text")))
    return counted.groupBy(*S, "sheet_name", "col_no").agg(
        of_row(NAME_ROW).alias("r2"), of_row(LABEL_ROW).alias("r3"), of_row(HEADER_ROW).alias("r4"),
        F.sum("n_present").alias("n_present"), F.sum("n_numeric").alias("n_numeric"),
        (F.sum("_n_data") > 0).alias("has_data")).select(
        *S, "col_no", "sheet_name", "r2", "r3", "r4", "n_present", "n_numeric", "has_data")


def _is_numeric(n_present: Column, n_numeric: Column) -> Column:
    """n_present > 0 and n_numeric >= max(1, int(0.8 * n_present)) — the
    truncating rule, so 1 numeric cell of 2 passes."""
    need = F.greatest(F.lit(1), F.floor(F.lit(NUMERIC_SHARE) * n_present).cast("bigint"))
    return (n_present > 0) & (n_numeric >= need)


def interval_minutes(label) -> Column:
    """BR-3: minutes from ``[15m]``-style labels, default 15."""
    m = F.regexp_extract(label, INTERVAL_PATTERN, 1)
    return F.coalesce(F.when(m != "", m).try_cast("int"), F.lit(DEFAULT_INTERVAL_MINUTES))


def _first(arr: Column, pred) -> Column:
    """First element of ``arr`` (sorted by column) matching ``pred``, or NULL."""
    return F.get(F.filter(arr, pred), 0)


def _time_hint(name: Column) -> Column:
    lname = F.lower(strip(name))
    hit = None
    for h in TIME_HEADER_HINTS:
        c = lname.contains(h)
        hit = c if hit is None else (hit | c)
    return hit


# BR-1 .. BR-5, BR-10, BR-12, SV-2, SV-3 ---------------------------------------
def sheet_table(profile: DataFrame) -> DataFrame:
    """One row per sheet with everything the grid steps need.

    Columns: S, sheet_name, meter_name / meter_desc (1st and 2nd non-blank
    text of row 2, numbers ignored), interval_label (first row-3 text with
    ``[n m]``, else the last row-3 text, else ''), interval_minutes,
    header_patch (a row-3 text equal to the time header, trimmed, any case),
    has_meta (any row-2/3 text), nonempty (any data cell), ``columns`` (array
    of structs col_no, name, n_present, n_numeric, numeric, has_data for
    every column with a header or data), time_col / time_name (column named
    ``Zeitbereich``, else the first whose name contains zeit/time/date/
    timestamp), value_col / value_name / value_numeric (column named
    ``Wert``).

    Header names: the row-4 cell stripped; ``col_<j>`` when there is none;
    A4 becomes ``Zeitbereich`` on a header patch; a repeated name keeps its
    first column and becomes ``<name>_<j>`` after that.
    """
    col = F.struct("col_no", "r2", "r3", "r4", "n_present", "n_numeric", "has_data")
    g = profile.groupBy(*S).agg(F.max("sheet_name").alias("sheet_name"),
                                F.sort_array(F.collect_list(col)).alias("_cols"))

    cols = F.col("_cols")
    names = F.filter(cols, lambda c: c["r2"].isNotNull())
    r3s = F.filter(cols, lambda c: c["r3"].isNotNull())
    hit = _first(r3s, lambda c: c["r3"].rlike(INTERVAL_PATTERN))["r3"]
    last = F.get(r3s, F.size(r3s) - 1)["r3"]
    label = F.coalesce(hit, last, F.lit(""))
    patch = F.exists(r3s, lambda c: F.lower(strip(c["r3"])) == TIME_HEADER)
    g = g.select(
        *S, "sheet_name", "_cols",
        F.get(names, 0)["r2"].alias("meter_name"),
        F.get(names, 1)["r2"].alias("meter_desc"),
        label.alias("interval_label"),
        interval_minutes(label).alias("interval_minutes"),
        patch.alias("header_patch"),
        ((F.size(names) > 0) | (F.size(r3s) > 0)).alias("has_meta"),
        F.exists(cols, lambda c: F.coalesce(c["has_data"], F.lit(False))).alias("nonempty"),
    )

    vis = F.filter(F.col("_cols"), lambda c: c["r4"].isNotNull()
                   | F.coalesce(c["has_data"], F.lit(False)))

    def name0(c):
        return (F.when((c["col_no"] == 0) & F.col("header_patch"), F.lit("Zeitbereich"))
                .when(c["r4"].isNotNull(), strip(c["r4"]))
                .otherwise(F.concat(F.lit("col_"), c["col_no"].cast("string"))))

    g = g.withColumn("_vis", F.transform(vis, lambda c: F.struct(
        c["col_no"].alias("col_no"), name0(c).alias("name0"),
        F.coalesce(c["n_present"], F.lit(0)).alias("n_present"),
        F.coalesce(c["n_numeric"], F.lit(0)).alias("n_numeric"),
        F.coalesce(c["has_data"], F.lit(False)).alias("has_data"))))
    # first occurrence keeps its name (array_position is 1-based); a later one
    # gets its column number, and where another header already reads so, a
    # tail that makes it longer than every header of the sheet
    first_pos = F.transform(F.col("_vis"), lambda c: c["name0"])
    longest = F.array_max(F.transform(first_pos, lambda n: F.length(n)))

    def own_name(c, i):
        numbered = F.concat(c["name0"], F.lit("_"), c["col_no"].cast("string"))
        return (F.when(F.array_position(first_pos, c["name0"]) == i + 1, c["name0"])
                .when(~F.array_contains(first_pos, numbered), numbered)
                .otherwise(F.concat(F.rpad(numbered, longest, "_"), F.lit("_"), c["col_no"].cast("string"))))

    g = g.withColumn("columns", F.transform(F.col("_vis"), lambda c, i: F.struct(
        c["col_no"].alias("col_no"), own_name(c, i).alias("name"),
        c["n_present"].alias("n_present"), c["n_numeric"].alias("n_numeric"),
        _is_numeric(c["n_present"], c["n_numeric"]).alias("numeric"),
        c["has_data"].alias("has_data"))))

    cl = F.col("columns")
    t = F.coalesce(_first(cl, lambda c: F.lower(strip(c["name"])) == TIME_HEADER),
                   _first(cl, lambda c: _time_hint(c["name"])))
    v = _first(cl, lambda c: F.lower(strip(c["name"])) == VALUE_HEADER)
    return g.select(
        *S, "sheet_name", "meter_name", "meter_desc", "interval_label", "interval_minutes",
        "header_patch", "has_meta", "nonempty", "columns",
        t["col_no"].alias("time_col"), t["name"].alias("time_name"),
        v["col_no"].alias("value_col"), v["name"].alias("value_name"),
        v["numeric"].alias("value_numeric"))


# Views of the sheet table (the registered operator outputs) ---------------------
def sheet_meta(cells: DataFrame | None = None, *, profile: DataFrame | None = None,
               sheets: DataFrame | None = None) -> DataFrame:
    """BR-1..4 per sheet; sheets without any row-2/3 text have no row."""
    st = _sheets(cells, profile, sheets)
    return st.where("has_meta").select(*S, "meter_name", "meter_desc", "interval_label",
                                       "interval_minutes", "header_patch")


def column_stats(cells: DataFrame | None = None, *, profile: DataFrame | None = None) -> DataFrame:
    """BR-9/10 per (sheet, column) with data cells: present / numeric counts
    and the 80 % verdict."""
    p = column_profile(cells) if profile is None else profile
    return (p.where(F.col("has_data"))
            .select(*S, "col_no", "sheet_name", "n_present", "n_numeric",
                    _is_numeric(F.col("n_present"), F.col("n_numeric")).alias("numeric")))


def column_info(cells: DataFrame | None = None, *, profile: DataFrame | None = None,
                sheets: DataFrame | None = None) -> DataFrame:
    """BR-4/5 per column with a header or data: name, counts, type."""
    st = _sheets(cells, profile, sheets)
    return (st.select(*S, "sheet_name", F.explode("columns").alias("c"))
            .select(*S, F.col("c.col_no").alias("col_no"), "sheet_name",
                    F.col("c.n_present").alias("n_present"),
                    F.col("c.n_numeric").alias("n_numeric"),
                    F.col("c.numeric").alias("numeric"),
                    F.col("c.has_data").alias("has_data"),
                    F.col("c.name").alias("name")))


def sheet_roles(sheets: DataFrame) -> DataFrame:
    """SV-2/3: time and value column of every sheet (NULL when absent)."""
    return sheets.select(*S, "value_col", "time_col", "time_name", "value_name",
                         "value_numeric")


def nonempty_sheets(sheets: DataFrame) -> DataFrame:
    """BR-12: sheets with at least one data cell (empty sheets are skipped)."""
    return sheets.where("nonempty").select(*S, "sheet_name")


def _sheets(cells, profile, sheets) -> DataFrame:
    if sheets is not None:
        return sheets
    return sheet_table(column_profile(cells) if profile is None else profile)


# BR-13 .. BR-16 --------------------------------------------------------------
def sheet_ids(sheets: DataFrame) -> DataFrame:
    """hall_id / hall_label from the file name, sheet_key and meter_id from
    the sheet title. Input: (src_file, sheet_idx, sheet_name)."""
    key = safe_key(F.col("sheet_name"))
    hall = hall_id_of(F.col("src_file"))
    return sheets.select(
        *S, "sheet_name",
        hall.alias("hall_id"), hall_label_of(hall).alias("hall_label"),
        key.alias("sheet_key"), meter_id_of(hall, key).alias("meter_id"))


# BR-11 -----------------------------------------------------------------------
def last_writer(sheets: DataFrame) -> DataFrame:
    """Per (hall_id, sheet_key) the non-empty sheet written last: greatest
    (src_file, sheet_idx). Input rows are non-empty sheets with ids."""
    w = F.max(F.struct("src_file", "sheet_idx"))
    win = sheets.groupBy("hall_id", "sheet_key").agg(w.alias("_w"))
    return win.select("hall_id", "sheet_key", F.col("_w.src_file").alias("src_file"),
                      F.col("_w.sheet_idx").alias("sheet_idx"))


def kept_sheets(sheets: DataFrame) -> DataFrame:
    """Sheet-table rows of the surviving sheets, with ids and provenance
    (meter name falls back to the sheet title, desc to '', interval to 15).

    Same rule as ``last_writer``, written as one ``row_number`` window over
    the (small) sheet table: no aggregate and no join back."""
    key = safe_key(F.col("sheet_name"))
    hall = hall_id_of(F.col("src_file"))
    ids = sheets.where("nonempty").select(
        "*", hall.alias("hall_id"), hall_label_of(hall).alias("hall_label"),
        key.alias("sheet_key"), meter_id_of(hall, key).alias("meter_id"))
    w = Window.partitionBy("hall_id", "sheet_key").orderBy(F.desc("src_file"), F.desc("sheet_idx"))
    return (ids.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
            .withColumn("meter_name", F.coalesce(F.when(F.col("meter_name") != "",
                                                        F.col("meter_name")),
                                                 F.col("sheet_name")))
            .withColumn("meter_desc", F.coalesce(F.col("meter_desc"), F.lit("")))
            .withColumn("interval_minutes", F.coalesce(F.col("interval_minutes"),
                                                       F.lit(DEFAULT_INTERVAL_MINUTES))))


# BR-6 .. BR-8 ----------------------------------------------------------------
def data_cells(cells: DataFrame) -> DataFrame:
    """Cells below the header with missing tokens nulled (BR-6, BR-9)."""
    return (cells.where(F.col("row_no") > HEADER_ROW)
            .withColumn("value", missing_to_null(F.col("value"))))


def records(cells: DataFrame, kept: DataFrame, *, decimal_comma: bool = False,
            profile: DataFrame | None = None) -> DataFrame:
    """One row per (sheet, data row) of the kept sheets: ``cells`` map
    (header -> cleaned text), the time text/kind and the typed value of the
    sheet's role columns. Rows without any cell do not exist (blank rows are
    skipped, later rows kept).

    The per-column side table (kept sheets x columns) is joined to the data
    cells before the shuffle; it is broadcast behind a size check against the
    column profile (``profile``), otherwise AQE decides (sort-merge with skew
    splitting of a hot sheet).
    """
    side = (kept.select(*S, "time_col", "value_col", F.explode("columns").alias("c"))
            .select(*S, F.col("c.col_no").alias("col_no"), F.col("c.name").alias("name"),
                    (F.col("c.col_no") == F.col("time_col")).alias("_is_t"),
                    ((F.col("c.col_no") == F.col("value_col")) & F.col("c.numeric"))
                    .alias("_is_v")))
    # Shuffle by (sheet, row) *before* grouping: a row has only a few cells,
    # so a map-side partial collect_list would not shrink anything and would
    # run (sort-based, spilling) inside whatever task read the cells - all of
    # them when the input is one unsplittable file. After this exchange the
    # grouping needs no other one; a hot sheet spreads over its rows. The
    # grouping sorts by its keys in their order, and beyond the few rows of a
    # table in memory it always sorts: the row number first, which tells most
    # rows apart by a number, where file names mostly begin alike.
    if profile is not None:
        # the side has at most one row per profile row: broadcast it behind
        # that bound, so the cells are shuffled once (below), not twice
        side = checked_broadcast(side, bound=profile, row_factor=2)
    d = data_cells(cells).join(side, [*S, "col_no"]).repartition(*S, "row_no")
    is_t = F.coalesce(F.col("_is_t"), F.lit(False))
    is_v = F.coalesce(F.col("_is_v"), F.lit(False))
    return d.groupBy("row_no", *S).agg(
        F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("cells"),
        F.max(F.when(is_t, F.col("value"))).alias("timestamp_raw"),
        F.max(F.when(is_t, F.col("kind"))).alias("timestamp_kind"),
        F.max(F.when(is_v, to_number(F.col("value"), decimal_comma))).alias("value"),
    ).select(*S, "row_no", "cells", "timestamp_raw", "timestamp_kind", "value")


# Whole chain ------------------------------------------------------------------
def cells_to_bronze(cells: DataFrame, *, decimal_comma: bool = False) -> DataFrame:
    """cells -> bronze rows of the surviving sheets (schema.BRONZE)."""
    return bronze_from(cells, column_profile(cells, decimal_comma=decimal_comma),
                       decimal_comma=decimal_comma)


def bronze_from(cells: DataFrame, profile: DataFrame, *, decimal_comma: bool = False) -> DataFrame:
    """Bronze rows from the cells and their column profile (the pipeline
    passes a written profile table; build it with the same
    ``decimal_comma``)."""
    kept = kept_sheets(sheet_table(profile))
    recs = records(cells, kept, decimal_comma=decimal_comma, profile=profile)
    prov = kept.select(*S, "hall_id", "sheet_key", "hall_label", "meter_id", "meter_name",
                       "meter_desc", "interval_minutes")
    # at most one row per profile row: below the limit the records are not shuffled again
    prov = checked_broadcast(prov, bound=profile, row_factor=4)
    return recs.join(prov, S).select(
        "hall_id", "sheet_key", "hall_label", "meter_id", "meter_name", "meter_desc",
        "interval_minutes", "src_file", "sheet_idx", "row_no", "timestamp_raw",
        "timestamp_kind", "value", "cells")


def cells_text(cells_map: Column) -> Column:
    """A record's cell map as ``name=text`` pairs sorted and joined by ``;``
    (a stable text form for comparing and printing; NULL text -> empty)."""
    pairs = F.transform(F.map_entries(cells_map),
                        lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit(""))))
    return F.array_join(F.sort_array(pairs), ";")
