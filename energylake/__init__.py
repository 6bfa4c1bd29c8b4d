"""Building-energy certificate analytics as Spark DataFrame jobs."""
