"""Declared tables, their generators, and reading and writing them."""
