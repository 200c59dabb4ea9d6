"""Queries over the driver's tables, each with the SQL it is checked against."""
