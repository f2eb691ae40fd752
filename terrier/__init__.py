"""Land-registry exchange data as Spark jobs."""
