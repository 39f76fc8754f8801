"""eventloom.operators."""
