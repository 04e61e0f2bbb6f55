"""Sources and sinks: driver tables, the source-system adapter, the store."""
