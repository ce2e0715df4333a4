"""Landing scans, the default rule set and fixtures derived from the driver tables."""
