"""Operators for preparing training data: one module for each operator, ``queries`` for the named queries."""
