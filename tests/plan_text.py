"""Physical plans as text."""


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    """Number of shuffles the initial plan asks for."""
    return executed(df).count("Exchange hashpartitioning")
