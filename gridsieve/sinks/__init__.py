"""Writers: Parquet, CSV, cell tables, metadata, raw copies."""
