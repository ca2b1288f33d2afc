"""meterlake: meter-readings analytics on Spark.

Spreadsheet exports (one workbook per hall, one worksheet per meter) become a
long ``cells`` table, then bronze records, a typed silver table and a gold star
schema; the drill-down questions (peak day -> top meter -> peak interval) are
DataFrame plans over the gold tables. Every module takes DataFrames in and
returns DataFrames out; no module holds a global session.
"""

__version__ = "0.1.0"
