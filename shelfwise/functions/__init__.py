"""Column expressions: filters, ratios, changes, formats."""
