"""plans of the case-table engine."""
