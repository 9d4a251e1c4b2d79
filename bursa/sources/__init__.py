"""Sources and sinks: declared schemas, table scans, adapter views, feed parsing, writers."""
