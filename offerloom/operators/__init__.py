"""Relational operators: intervals, units, duplicates, matching, market analytics."""
