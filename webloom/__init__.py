"""webloom: a Spark-first engine that turns web pages into training records."""
