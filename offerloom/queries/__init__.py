"""Queries by name, each with its SQL where there is one."""
