"""Whole jobs, dashboard tables and the registered queries."""
