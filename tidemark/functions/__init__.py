"""Column expressions that Spark has not: month boundaries, falsy defaults, exact rounding, formats."""
