"""Column expressions: no job, no shuffle, no Python worker."""
