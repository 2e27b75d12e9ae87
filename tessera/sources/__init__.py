"""Sources and sinks: given tables, derived fixtures, CSV/text/Parquet I/O."""
