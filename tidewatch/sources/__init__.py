"""Sources and sinks: raw CSV, the test-table adapter, catalog tables, CSV extracts."""
