"""Bindings to tables, consolidation jobs, reports and the query catalog."""
