"""Whole jobs built from the operators, their comparison, and the registered queries."""
