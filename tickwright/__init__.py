"""Daily features from trade ticks, as Spark DataFrame operators."""
