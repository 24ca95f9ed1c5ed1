"""Column expressions: seeded draws, value picks, codes and the fiscal calendar."""
