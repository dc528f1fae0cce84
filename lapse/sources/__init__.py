"""Sources and sinks: role views over the driver tables, typed ingest, writers."""
