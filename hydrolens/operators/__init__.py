"""DataFrame-to-DataFrame operators Spark has no single method for."""
