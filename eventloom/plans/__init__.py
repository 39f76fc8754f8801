"""eventloom.plans."""
