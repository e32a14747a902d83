"""Mainframe accounting records as typed Spark tables, marts and reports."""
