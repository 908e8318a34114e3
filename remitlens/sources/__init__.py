"""Readers, column standardisation, writers and the order-table adapter."""
