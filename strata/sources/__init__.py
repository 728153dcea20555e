"""Landing scans, Bronze audit columns, table sinks and read-back checks."""
