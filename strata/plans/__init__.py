"""Pipelines built from the operators: silver load, gold load, and the test-data recipes."""
