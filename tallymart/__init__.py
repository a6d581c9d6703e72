"""tallymart: retail sales marts and seller incentives as plain Spark jobs."""
