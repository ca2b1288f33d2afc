"""Readings and worksheet cells derived from the driver's test tables.

F1 ``readings``: events as 15-minute meter readings (5 halls x 8 meters).
F2 ``readings_large``: line items as daily readings per supplier, hall = region.
F3 ``cells``: events laid out as workbook cells, one worksheet per meter.

All three are plain DataFrame plans over the Parquet tables, so their size
grows with the scale factor of the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.gold import Gold, build_gold


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str, copies: int = 1) -> DataFrame:
    """The events table, or ``copies`` shifted copies of it (scaling runs).

    Copy ``c`` of an event gets id ``event_id * copies + c`` and its time
    moved by ``30 * c`` days (the data spans 30 days), so copies land on new
    days instead of piling onto the same meter-days. Built with a generator,
    not a join; ``copies=1`` is the table itself."""
    ev = table(spark, sf_dir, "events")
    if copies <= 1:
        return ev
    c = F.explode(F.sequence(F.lit(0), F.lit(int(copies) - 1))).alias("_copy")
    # the driver writes each table as one file (one scan task); spread the
    # base rows first so the copies are generated by many tasks (this moves
    # the small base table, not the multiplied rows)
    x = ev.repartition(min(int(copies), 64)).select("*", c)
    return x.select(
        (F.col("event_id") * int(copies) + F.col("_copy")).alias("event_id"),
        F.timestamp_add("DAY", F.col("_copy") * 30, F.col("ts")).alias("ts"),
        *[n for n in ev.columns if n not in ("event_id", "ts")])


def _slot(user_id) -> F.Column:
    return (user_id % 8)


# --------------------------------------------------------------------- F1
def readings(spark: SparkSession, sf_dir: str, copies: int = 1) -> DataFrame:
    """Events as silver readings.

    meter_name is NULL for slot 7 (a meter the dim cannot name); every 20th
    event reads 0 and the next one is missing, so the positive-value filter
    has work to do.
    """
    ev = events(spark, sf_dir, copies)
    slot = _slot(F.col("user_id"))
    hall = F.upper("event_type")
    rid = F.col("event_id") % 20
    return ev.select(
        hall.alias("hall_id"),
        F.concat(F.lit("Hall "), hall).alias("hall_label"),
        F.concat(F.lower("event_type"), F.lit("_m"), slot.cast("string")).alias("meter_id"),
        F.when(slot != 7, F.concat(F.lit("Meter "), slot.cast("string"))).alias("meter_name"),
        F.lit("").alias("meter_desc"),
        F.window("ts", "15 minutes").start.alias("timestamp"),
        F.when(rid == 0, F.lit(0.0)).when(rid == 1, F.lit(None).cast("double"))
         .otherwise(F.col("value")).alias("value"),
        F.lit(15).alias("interval_minutes"),
        F.lit("events.parquet").alias("src_file"),
    )


def readings_gold(spark: SparkSession, sf_dir: str, copies: int = 1) -> Gold:
    return build_gold(readings(spark, sf_dir, copies))


def fanout_dim(gold: Gold) -> DataFrame:
    """dim_meter plus a second name for meter ``click_m1`` (fan-out case)."""
    spark = gold.dim_meter.sparkSession
    extra = spark.createDataFrame(
        [("CLICK", "click_m1", "Meter 1 (alt)", "")],
        "hall_id string, meter_id string, meter_name string, meter_desc string")
    return gold.dim_meter.unionByName(extra)


# --------------------------------------------------------------------- F2
def readings_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as readings: hall = region name, meter = region + supplier,
    timestamp = ship date (midnight), value = quantity (integral)."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_quantity")
    # nation (25 rows) and region (5 rows) have a fixed size at every scale
    # factor, a proven bound, so they are broadcast explicitly. supplier grows
    # with the scale factor: its joins are left to AQE, which broadcasts only
    # after measuring it and otherwise keeps a sort-merge join.
    geo = (table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
           .join(F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")),
                 F.col("s_nationkey") == F.col("n_nationkey"))
           .join(F.broadcast(table(spark, sf_dir, "region").select("r_regionkey", "r_name")),
                 F.col("n_regionkey") == F.col("r_regionkey"))
           .select("s_suppkey", "s_name", "r_name"))
    j = li.join(geo, F.col("l_suppkey") == F.col("s_suppkey"))
    return j.select(
        F.col("r_name").alias("hall_id"),
        F.concat(F.lit("Hall "), F.col("r_name")).alias("hall_label"),
        F.concat(F.lower("r_name"), F.lit("_s"), F.col("l_suppkey").cast("string")).alias("meter_id"),
        F.col("s_name").alias("meter_name"),
        F.lit("").alias("meter_desc"),
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_quantity").alias("value"),
        F.lit(1440).alias("interval_minutes"),
        F.lit("lineitem.parquet").alias("src_file"),
    )


def readings_large_gold(spark: SparkSession, sf_dir: str) -> Gold:
    """Halls are regions: the stored region table (fixed size) bounds every
    per-hall table of the drill-down."""
    g = build_gold(readings_large(spark, sf_dir))
    return Gold(g.fact, g.dim_hall, g.dim_meter,
                hall_bound=table(spark, sf_dir, "region").select("r_name"))


# --------------------------------------------------------------------- F3
# Fixed values of the cells fixture: the workbook number of each event type,
# the second workbook that re-exports sheet 0 of hall H1 (last writer wins),
# and the title of its empty sheet.
F3_HALL_NO = {"click": 1, "error": 2, "purchase": 3, "signup": 7, "view": 8}
F3_REWRITE_FILE = "Export_H1_zz.xlsx"
F3_REWRITE_FROM = "view"
F3_EMPTY_SHEET = "Leer"


def _two(c) -> F.Column:
    return F.lpad(c.cast("string"), 2, "0")


def dayfirst_text(ts) -> F.Column:
    """``dd.MM.yyyy HH:mm:ss`` from date parts (no session-zone round trip)."""
    return F.concat(_two(F.dayofmonth(ts)), F.lit("."), _two(F.month(ts)), F.lit("."),
                    F.lpad(F.year(ts).cast("string"), 4, "0"), F.lit(" "),
                    _two(F.hour(ts)), F.lit(":"), _two(F.minute(ts)), F.lit(":"),
                    _two(F.floor(F.second(ts))))


def _cell(row, col, value, kind, when=None) -> F.Column:
    s = F.struct(F.lit(row).cast("long").alias("row_no") if not isinstance(row, F.Column)
                 else row.cast("long").alias("row_no"),
                 F.lit(col).alias("col_no"), value.alias("value"), F.lit(kind).alias("kind"))
    return s if when is None else F.when(when, s)


def _header_cells(layout) -> F.Column:
    """Rows 2-4 of a sheet with the given layout number (0-7)."""
    k = layout
    odd = (k % 2) == 1
    label = (F.when(k == 4, F.lit("Leistung"))
             .when(odd, F.lit("Wirkleistung [30 m]"))
             .otherwise(F.lit("Wirkleistung [15 m]")))
    return F.array(
        _cell(2, 0, F.lit("570"), "n"),
        _cell(2, 1, F.concat(F.lit("Z "), (k + 100).cast("string")), "s"),
        _cell(2, 2, F.concat(F.lit("Lade "), k.cast("string")), "s", when=k != 3),
        _cell(3, 0, F.lit(" Zeitbereich"), "s", when=odd),
        _cell(3, 1, label, "s"),
        _cell(4, 0, F.when(k == 2, F.lit("Datum/Zeit")).otherwise(F.lit("Zeitbereich")), "s",
              when=~odd),
        _cell(4, 1, F.lit(" Wert "), "s"),
    )


def _data_cells(event_id, ts, value, layout) -> F.Column:
    row = F.lit(5) + event_id
    t = F.when(event_id % 50 == 2, F.lit("Summe")).otherwise(dayfirst_text(ts))
    missing = event_id % 20 == 1
    junk = (layout == 6) & (event_id % 3 == 0)
    v = (F.when(missing, F.lit("#N/A")).when(junk, F.lit("x"))
         .otherwise(F.format_string("%.2f", value)))
    kind = F.when(missing | junk, F.lit("s")).otherwise(F.lit("n"))
    return F.array(
        F.struct(row.cast("long").alias("row_no"), F.lit(0).alias("col_no"),
                 t.alias("value"), F.lit("s").alias("kind")),
        F.struct(row.cast("long").alias("row_no"), F.lit(1).alias("col_no"),
                 v.alias("value"), kind.alias("kind")),
    )


def cells(spark: SparkSession, sf_dir: str, copies: int = 1) -> DataFrame:
    """Events laid out as workbook cells (schema.CELLS), see FIXTURES.md F3.

    One workbook per event type, one sheet per ``user_id % 8``, one data row
    per event (row ``5 + event_id``: unique per sheet without a window).
    A second workbook ``Export_H1_zz.xlsx`` re-exports sheet ``Z 100 (m)`` of
    hall H1 with the view events of slot 0 and holds one empty sheet.

    One scan of the events: each event names the sheets it lands on
    (``targets``); header cells come from the distinct sheets (partial +
    final aggregate, output bounded by files x sheets), data cells from the
    events themselves.
    """
    ev = events(spark, sf_dir, copies).select("event_id", "ts", "value", "event_type", "user_id")
    hall_no = F.create_map(*[x for k, v in F3_HALL_NO.items() for x in (F.lit(k), F.lit(v))])
    slot = (F.col("user_id") % 8).cast("int")
    src = F.concat(F.lit("Export_H"), hall_no[F.col("event_type")].cast("string"),
                   F.lit("_"), F.col("event_type"), F.lit(".xlsx"))

    def sheet_name(k):
        return F.concat(F.lit("Z "), (k + 100).cast("string"), F.lit(" (m)"))

    def target(file, idx, layout, name, body):
        return F.struct(file.alias("src_file"), idx.alias("sheet_idx"), layout.alias("layout"),
                        name.alias("sheet_name"), F.lit(body).alias("body"))

    main = target(src, slot, slot, sheet_name(slot), True)
    again = target(F.lit(F3_REWRITE_FILE), F.lit(0), F.lit(0), sheet_name(F.lit(0)), True)
    empty = target(F.lit(F3_REWRITE_FILE), F.lit(1), F.lit(0), F.lit(F3_EMPTY_SHEET), False)
    rewrite = (F.col("event_type") == F3_REWRITE_FROM) & (slot == 0)
    targets = F.when(rewrite, F.array(main, again, empty)).otherwise(F.array(main))
    t = (ev.select("event_id", "ts", "value", F.explode(targets).alias("t"))
         .select("event_id", "ts", "value", "t.*"))

    head = (t.select("src_file", "sheet_idx", "sheet_name", "layout").distinct()
            .select("src_file", "sheet_idx", "sheet_name",
                    F.explode(_header_cells(F.col("layout"))).alias("c"))
            .where(F.col("c").isNotNull()))
    body = (t.where("body")
            .select("src_file", "sheet_idx", "sheet_name",
                    F.explode(_data_cells(F.col("event_id"), F.col("ts"), F.col("value"),
                                          F.col("layout"))).alias("c")))
    out = head.unionByName(body)
    return out.select("src_file", "sheet_idx", "sheet_name",
                      F.col("c.row_no").alias("row_no"), F.col("c.col_no").alias("col_no"),
                      F.col("c.value").alias("value"), F.col("c.kind").alias("kind"))


# --------------------------------------------------------------------- F5
# Fixed value of the exports fixture: the hour of the day's first export.
F5_FIRST_EXPORT = 18


def day_exports(spark: SparkSession, sf_dir: str, first: bool) -> DataFrame:
    """Events as files in the columns of ``binaryFile``, one per event type and
    day, one line per event. The first export holds what came before its hour;
    days with later events are exported again, whole, at midnight."""
    late = F.hour("ts") >= F5_FIRST_EXPORT
    ev = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    line = F.concat_ws(";", "event_id", "user_id", "event_type")
    files = (ev.where(~late) if first else ev).groupBy("event_type", "day").agg(
        F.array_sort(F.collect_list(F.struct("event_id", line.alias("line")))).alias("lines"), F.max(late).alias("late"))
    hall_no = F.create_map(*[x for k, v in F3_HALL_NO.items() for x in (F.lit(k), F.lit(v))])
    name = F.concat(F.lit("in/Export_H"), hall_no[F.col("event_type")].cast("string"), F.lit("_"),
                    F.col("day").cast("string"), F.lit(".xlsx"))
    at = F.timestamp_add("HOUR", F.lit(F5_FIRST_EXPORT if first else 24), F.col("day").cast("timestamp_ntz"))
    content = F.encode(F.array_join(F.col("lines.line"), "\n"), "UTF-8")
    files = files.where(F.lit(True) if first else F.col("late"))
    return files.select(name.alias("path"), at.cast("timestamp").alias("modificationTime"),
                        F.octet_length(content).cast("long").alias("length"), content.alias("content"))
