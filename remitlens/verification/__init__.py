"""Registered queries and the SQL that computes the same results independently."""
