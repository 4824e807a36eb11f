"""Flight-delay and airspace analytics as Spark DataFrame operators."""
