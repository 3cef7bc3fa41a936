"""Registered queries over the given tables, their inputs, and independent SQL for each."""
