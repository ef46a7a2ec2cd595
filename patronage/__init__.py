"""Customer analytics over multi-channel retail tables, written as Spark DataFrame code."""
