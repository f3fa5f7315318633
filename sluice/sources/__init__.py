"""Change logs as DataFrames: text lines or a Parquet archive, batch or stream."""
