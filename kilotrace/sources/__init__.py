"""Sources and sinks: declared schemas, lake layout, file scans, and the mapping of the given tables."""
