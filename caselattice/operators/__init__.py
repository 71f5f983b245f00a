"""operators of the case-table engine."""
