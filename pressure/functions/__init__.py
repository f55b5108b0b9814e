"""Column expressions and helpers at the edge of a job."""
