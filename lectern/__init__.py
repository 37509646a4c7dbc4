"""Learning-platform event analytics, written as Spark DataFrame programs."""
