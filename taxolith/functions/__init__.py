"""Column functions: scalars, ranks and adjustments over windows, distributions."""
