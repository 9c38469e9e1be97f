"""Column-level building blocks (no jobs, no shuffles)."""
