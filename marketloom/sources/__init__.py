"""Landing files, table reads and table writes."""
