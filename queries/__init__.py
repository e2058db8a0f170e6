"""Driver queries: one Spark function and one SQL text per operator."""
