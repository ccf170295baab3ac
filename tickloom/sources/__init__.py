"""Sources and sinks: delimited quotes, Parquet, sidecar files."""
