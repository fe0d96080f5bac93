"""Learning-analytics marts as Spark DataFrame operators."""
