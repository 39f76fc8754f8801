"""eventloom.functions."""
