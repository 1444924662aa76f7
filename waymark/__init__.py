"""waymark: user-level trip and city analytics on PySpark DataFrames and streams."""
