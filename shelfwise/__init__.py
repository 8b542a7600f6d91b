"""shelfwise: product recommendation analytics as Spark jobs."""
