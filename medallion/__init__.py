"""Layered lakehouse tables (bronze, silver, gold) on plain open-source Spark."""
