"""Operators chained into whole refreshes and table changes."""
