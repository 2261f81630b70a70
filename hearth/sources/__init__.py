"""Sources and sinks: the driver-table feed, JSON/CSV readers, versioned parquet tables."""
