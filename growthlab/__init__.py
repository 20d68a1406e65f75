"""Customer-growth, marketing and payment analytics as Spark DataFrame operators."""
