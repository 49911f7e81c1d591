"""Operators for preparing training text, their registered queries and the SQL that gives the same rows."""
