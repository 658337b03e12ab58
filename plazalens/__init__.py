"""Social-media abuse analytics on Spark."""
