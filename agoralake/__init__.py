"""Social-discourse analytics on Spark: sources, functions, operators, plans and streaming jobs."""

__version__ = "0.1.0"
