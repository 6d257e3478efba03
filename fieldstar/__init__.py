"""Field observations conformed into one star schema, as Spark DataFrame work."""
