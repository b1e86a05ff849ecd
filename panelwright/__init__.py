"""Entity-by-year panels and composite scores as plain Spark DataFrame plans."""
