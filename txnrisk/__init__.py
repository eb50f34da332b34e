"""Transaction-risk analytics as plain ``DataFrame -> DataFrame`` operators on Spark."""

__version__ = "0.1.0"
