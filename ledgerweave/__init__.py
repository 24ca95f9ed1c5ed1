"""Spark jobs that synthesise, lay out, aggregate and check a financial star schema."""
