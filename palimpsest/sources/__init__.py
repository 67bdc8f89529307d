"""Sources and sinks: dump XML, the revision archive, the recent-changes feed and Parquet tables."""
