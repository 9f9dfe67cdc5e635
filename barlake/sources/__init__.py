"""Sources and sinks: table scans/writes, landed price files, test fixtures."""
