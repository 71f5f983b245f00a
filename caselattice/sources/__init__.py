"""sources of the case-table engine."""
