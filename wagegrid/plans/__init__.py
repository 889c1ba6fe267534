"""Composite jobs and the query registry with its SQL oracle."""
