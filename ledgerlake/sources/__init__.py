"""Sources: change events, lake files, RAW landing, and fixtures from the driver tables."""
