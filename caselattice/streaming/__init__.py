"""streaming of the case-table engine."""
