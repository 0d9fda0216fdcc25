"""Readers: parquet/catalog tables (S1, S2), the driver test tables in star
shape, JSON-lines logs with a log sequence number (S5-S7) and message
streams (S3, S4)."""
