"""Reading and writing tables, metrics and fitted state."""
