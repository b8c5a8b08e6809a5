"""Market-bar analytics as Spark DataFrame plans."""
