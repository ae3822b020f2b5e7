"""Column-level building blocks used inside table jobs."""
