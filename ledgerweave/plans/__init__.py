"""Whole jobs: the multi-table build and the registered queries."""
