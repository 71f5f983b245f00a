"""functions of the case-table engine."""
