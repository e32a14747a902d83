"""Test support: turns rows of the given tables into binary logs. Not part of the ingest."""
