"""Sources and sinks: test-table views, delimited message files, writers."""
