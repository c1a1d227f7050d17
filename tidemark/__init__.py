"""Data-quality gates, point-in-time features and model monitoring as Spark DataFrame operators."""
