"""Compositions of operators: the full model and the compact model."""
