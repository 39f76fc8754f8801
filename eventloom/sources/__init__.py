"""eventloom.sources."""
