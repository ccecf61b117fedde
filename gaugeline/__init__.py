"""Gaugeline: DataFrame operators for industrial sensor telemetry on Apache Spark."""

__version__ = "0.1.0"
