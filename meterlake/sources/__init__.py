"""Sources: workbook files, lake layers, and fixture tables derived from the
driver's Parquet test data."""
