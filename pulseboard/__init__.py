"""Product analytics for a social application, as plain Spark DataFrame operators."""
