"""Queries over the driver's tables, with their SQL equivalents."""
