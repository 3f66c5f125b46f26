"""Writers: Parquet exports and the versioned store."""
