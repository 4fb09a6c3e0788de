"""DataFrame-in, DataFrame-out operators (no actions inside)."""
