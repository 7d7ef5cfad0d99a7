"""apexlake: motorsport results analytics as Spark jobs."""
