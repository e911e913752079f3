"""Sources: parquet tables, page-recognition formats and JSON manifests as DataFrames."""
