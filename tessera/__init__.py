"""Documents to a typed property graph, hybrid retrieval over it and its audits, as Spark DataFrame jobs."""
