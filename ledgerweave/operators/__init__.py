"""Foreign keys, checks, and the aggregate over DataFrames."""
