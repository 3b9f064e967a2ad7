"""Sources and sinks: typed CSV, Parquet staging, history tables, literal
configuration tables and the driver tables."""
