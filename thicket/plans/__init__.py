"""Queries over the driver tables, jobs, and their chain."""
