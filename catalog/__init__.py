"""Registered queries: each operator on the given tables, with its SQL where SQL can say it."""
