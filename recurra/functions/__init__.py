"""Column expressions: dates, text and exact money arithmetic. All stay inside Spark's generated code."""
