"""Running stages as streaming queries, and the stateful forms."""
