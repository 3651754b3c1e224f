"""Registered queries, their reference SQL and the test-table adapters."""
