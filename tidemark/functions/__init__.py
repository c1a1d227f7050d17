"""Column-level building blocks: every function here returns built-in Spark expressions."""
