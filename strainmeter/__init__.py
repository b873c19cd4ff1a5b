"""strainmeter: failure prediction from system-metric tables and streams,
built from Spark DataFrame, MLlib and Structured Streaming operators."""

__version__ = "0.3.0"
