"""Sources and sinks: bronze JSON landing and scans, Parquet tables, partition overwrite."""
