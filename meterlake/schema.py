"""Table schemas of every layer and the fixed values the pipeline relies on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must stay exactly as written for results to agree with
# the behaviour we reproduce; they are listed together, in natural order.
# ---------------------------------------------------------------------------

# Cell texts that mean "no value" (exact, case-sensitive match).
MISSING_TOKENS = ["#N/A", "#N/A.NA", "N/A", "NA", "NaN", "None", ""]

# Header names that resolve the two column roles (compared trimmed, lower-case).
TIME_HEADER = "zeitbereich"
VALUE_HEADER = "wert"

# Substrings that make a header a fallback time column (first in column order).
TIME_HEADER_HINTS = ["zeit", "time", "date", "timestamp"]

# Layout of a worksheet: row 2 meter name/desc, row 3 quantity label, row 4
# header, data below. Rows are 1-based, columns 0-based.
NAME_ROW = 2
LABEL_ROW = 3
HEADER_ROW = 4

# Interval label pattern "[15m]", "[30 m]"; default minutes when absent.
INTERVAL_PATTERN = r"\[(\d+)\s*m\]"
DEFAULT_INTERVAL_MINUTES = 15

# Hall id inside a workbook file name; the file stem is used when absent.
HALL_PATTERN = r"(H\d+|NVP)"
HALL_LABEL_PREFIX = "Hall "

# Characters outside this class collapse to "_" in sheet keys.
SHEET_KEY_BAD_CHARS = r"[^A-Za-z0-9_]+"

# A text column becomes numeric when at least this share of its non-missing
# cells parse as numbers (truncated to an integer count, never below 1).
NUMERIC_SHARE = 0.8

# Top-N meters shown for a day, and the default date range of the dashboard.
DEFAULT_TOP_N = 5

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

# One row per non-empty worksheet cell. kind: 's' text, 'n' number,
# 'd' date/time (value rendered as 'yyyy-MM-dd HH:mm:ss'), 'b' boolean,
# 'e' error text.
CELLS = T.StructType([
    T.StructField("src_file", T.StringType(), False),
    T.StructField("sheet_idx", T.IntegerType(), False),
    T.StructField("sheet_name", T.StringType(), True),
    T.StructField("row_no", T.LongType(), False),
    T.StructField("col_no", T.IntegerType(), False),
    T.StructField("value", T.StringType(), True),
    T.StructField("kind", T.StringType(), True),
])

# Bronze: one row per data row of a worksheet. The per-sheet columns live in
# ``cells`` (header name -> cell text, typed later), so sheets with different
# layouts share one table.
BRONZE = T.StructType([
    T.StructField("hall_id", T.StringType(), True),
    T.StructField("sheet_key", T.StringType(), True),
    T.StructField("hall_label", T.StringType(), True),
    T.StructField("meter_id", T.StringType(), True),
    T.StructField("meter_name", T.StringType(), True),
    T.StructField("meter_desc", T.StringType(), True),
    T.StructField("interval_minutes", T.IntegerType(), True),
    T.StructField("src_file", T.StringType(), True),
    T.StructField("sheet_idx", T.IntegerType(), True),
    T.StructField("row_no", T.LongType(), True),
    T.StructField("timestamp_raw", T.StringType(), True),
    T.StructField("timestamp_kind", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("cells", T.MapType(T.StringType(), T.StringType()), True),
])

SILVER = T.StructType([
    T.StructField("hall_id", T.StringType(), True),
    T.StructField("hall_label", T.StringType(), True),
    T.StructField("meter_id", T.StringType(), True),
    T.StructField("meter_name", T.StringType(), True),
    T.StructField("meter_desc", T.StringType(), True),
    T.StructField("timestamp", T.TimestampNTZType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("interval_minutes", T.IntegerType(), True),
    T.StructField("src_file", T.StringType(), True),
])
SILVER_COLUMNS = [f.name for f in SILVER.fields]

FACT = T.StructType([
    T.StructField("hall_id", T.StringType(), True),
    T.StructField("meter_id", T.StringType(), True),
    T.StructField("timestamp", T.TimestampNTZType(), True),
    T.StructField("value", T.DoubleType(), True),
])

# The fact as it is stored: with the reading's date, because a Parquet scan
# skips row groups and pages by predicates on dates, but not on TIMESTAMP_NTZ.
READING_DATE = "reading_date"
FACT_STORED = T.StructType([*FACT.fields, T.StructField(READING_DATE, T.DateType(), True)])

# Sums of the fact per hall, day and meter; *_positive and *_midnight cover the
# readings with value > 0, the latter those at 00:00.
METER_DAY = T.StructType([
    T.StructField("hall_id", T.StringType(), True),
    T.StructField("day", T.DateType(), True),
    T.StructField("meter_id", T.StringType(), True),
    T.StructField("n_readings", T.LongType(), True),
    T.StructField("n_positive", T.LongType(), True),
    T.StructField("sum_all", T.DoubleType(), True),
    T.StructField("sum_positive", T.DoubleType(), True),
    T.StructField("n_midnight", T.LongType(), True),
    T.StructField("sum_midnight", T.DoubleType(), True),
])

DIM_HALL = T.StructType([
    T.StructField("hall_id", T.StringType(), True),
    T.StructField("hall_label", T.StringType(), True),
])

DIM_METER = T.StructType([
    T.StructField("hall_id", T.StringType(), True),
    T.StructField("meter_id", T.StringType(), True),
    T.StructField("meter_name", T.StringType(), True),
    T.StructField("meter_desc", T.StringType(), True),
])

RUN_LOG = T.StructType([
    T.StructField("run_at", T.TimestampNTZType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("failed_task", T.StringType(), True),
    T.StructField("error", T.StringType(), True),
    T.StructField("metrics", T.MapType(T.StringType(), T.LongType()), True),
])
