"""Whole flows and the registered queries."""
