"""Whole jobs, the derived input views and the registered queries."""
