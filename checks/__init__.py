"""Registered queries and, next to each, the SQL it must agree with."""
