"""eventloom.streaming."""
