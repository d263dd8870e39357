"""Sources: raw CSV/Parquet scans, lookups and the test-table mapping."""
