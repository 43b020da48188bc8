"""Sources and sinks: registry, JSON/Parquet scans, landing, request plans, shapers."""
