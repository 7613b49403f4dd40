"""Queries over the driver's tables, each with the SQL it must equal where SQL can say it."""
