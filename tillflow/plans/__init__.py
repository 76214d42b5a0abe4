"""Registered queries: a Spark callable and, beside it, its SQL oracle."""
