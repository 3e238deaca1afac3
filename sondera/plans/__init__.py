"""Compositions of operators: the staged pipeline and the registered queries."""
