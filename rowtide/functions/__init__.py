"""Column functions for change records."""
