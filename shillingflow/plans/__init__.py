"""Physical-plan helpers: skew handling, ranks, exact quantiles."""
