"""meterlake: DataFrame operators for meter and event data on Apache Spark."""

__version__ = "0.1.0"
